"""Each operator against a brute-force version, and on awkward rows."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import compare
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry_module
from wearline.llm import (
    decontamination,
    line_dedup,
    near_dedup,
    packing,
    pii,
    quality,
    suffix_dedup,
    text,
    token_counts,
    tokens,
    vptree,
    warc,
)

# Awkward documents: nulls, empties, repeated rows, ties, clashing extra columns.
LONG = "word " * 30_000 + "end"
PROSE = "The quick brown fox jumps over the lazy dog while seven wizards quietly mix strange potions near an old stone bridge"
AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (4, PROSE), (4, PROSE), (5, PROSE), (None, PROSE), (None, None),
    (6, LONG), (7, "a\nb\nc\nd\na\nb\nc"), (8, "a\nb\nc"), (9, "\n\n\n\n\n"), (10, "üñí☃ \U0001f600 é\x1c<|endoftext|>"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(i, t, "x", 5.0, "y", 1) for i, t in AWKWARD]
    schema = "doc_id long, text string, kept string, score double, spans string, n_lines int"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="module")
def empty(awkward):
    return awkward.where("doc_id > 1000")


@pytest.fixture(scope="module")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


@pytest.fixture(scope="module")
def plain(documents):
    return {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}


def query(spark, folder, name):
    return entry_module.queries()[name](spark, folder)


# --- 1 ---------------------------------------------------------------------------------------


def classes_by_brute_force(texts, threshold=0.8):
    """Components of all pairs with weighted Jaccard at the threshold, from word tuples."""
    bags = {}
    for i, t in texts.items():
        words = (t or "").lower().split()
        n = min(5, len(words))
        bags[i] = Counter(tuple(words[k : k + n]) for k in range(len(words) - n + 1)) if n else Counter()
    filled = [i for i in bags if bags[i]]
    df = Counter(s for i in filled for s in bags[i])
    floor = near_dedup.COMMON_SHARE
    weight = {i: {s: c * (1 - np.log(max(df[s] / len(filled), floor))) for s, c in bags[i].items()} for i in filled}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    order = sorted(filled)
    for n, a in enumerate(order):
        for b in order[n + 1 :]:
            if bags[a].keys() & bags[b].keys():
                shared = sum(min(w, weight[b].get(s, 0)) for s, w in weight[a].items())
                if shared / (sum(weight[a].values()) + sum(weight[b].values()) - shared) >= threshold:
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: find(i) for i in texts}


def test_near_duplicates_agree_with_all_pairs(spark, small, plain):
    got = {r["doc_id"]: r["class_id"] for r in query(spark, small, "op1_minhash_near_dedup").collect()}
    assert got == classes_by_brute_force(plain)


def test_near_duplicate_classes_of_awkward_rows(awkward, empty):
    rows = near_dedup.near_duplicates(awkward).collect()
    assert len(rows) == len(AWKWARD)
    prose = [r for r in rows if r["doc_id"] in (4, 5)]
    assert len({r["class_id"] for r in prose}) == 1 and sum(r["keeper"] for r in rows if r["doc_id"] == 5) == 0
    assert near_dedup.near_duplicates(empty).count() == 0


def test_a_crowded_bucket_keeps_every_link(spark):
    """Texts that share a passage but not 0.8 of it, with pairs of close copies among them."""
    random.seed(4)
    word = lambda: "".join(random.choices("abcdefghij", k=6))
    passage = [word() for _ in range(60)]
    texts = {}
    for n in range(60):
        own = [word() for _ in range(45)]
        texts[2 * n] = " ".join(passage + own)
        texts[2 * n + 1] = " ".join(passage + own[:-1] + [word()])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(docs).collect()}
    assert got == {i: i - i % 2 for i in texts}


def test_every_shingle_has_the_idf_of_its_own_documents(spark, monkeypatch):
    """Rare shingles too, over many blocks and ranges of hashes; copies and repeated rows count as documents."""
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 300)
    monkeypatch.setattr(near_dedup, "RANGE_BYTES", 700)
    random.seed(8)
    texts = [" ".join(random.choices("abc", k=random.choice([3, 9, 30]))) for _ in range(60)] + ["a b c a b c a"] * 5 + [None, "", " \x1c\n"]
    rows = [*enumerate(texts), (60, texts[60]), (60, texts[60]), (None, texts[0])]
    bags = [Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) for w in ((t or "").split() for _, t in rows) if w]
    df = Counter(s for b in bags for s in b)
    expected = Counter(round(sum(c * (1 + np.log(len(bags) / df[s])) for s, c in b.items()), 6) for b in bags)
    docs = spark.createDataFrame(rows, "__id long, __text string").withColumn("__hash", F.xxhash64("__text")).repartition(3)
    signed, documents = near_dedup.signatures(docs)
    got = Counter()
    for r in signed.where("size(bands) > 0").collect():
        got[round(r["weight"], 6)] += r["copies"]
    assert documents == len(bags) and got == expected
    assert len(near_dedup.near_duplicates(docs, "__text", "__id").collect()) == len(rows)


def test_near_copies_of_a_large_group_stay_one_class(spark):
    """Whatever the size of the group and of the corpus; texts that share half of their words are no copies."""
    random.seed(6)
    word = lambda: "".join(random.choices("abcdefghij", k=6))
    base, half = ([word() for _ in range(120)] for _ in range(2))
    texts = {0: " ".join(base)}
    for n in range(1, 60):
        edited = base.copy()
        for at in random.sample(range(5, 115, 10), 2):
            edited[at] = word()
        texts[n] = " ".join(edited)
    texts |= {100 + n: " ".join(half[:60] + [word() for _ in range(60)]) for n in range(60)}
    texts |= {1000 + n: " ".join(word() for _ in range(8)) for n in range(4000)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(docs).collect()}
    assert got == {i: 0 if i < 60 else i for i in texts}


def test_copies_of_a_text_are_told_from_common_passages():
    frequency = np.array([1, 2, 1, 1, 5])
    assert near_dedup.own_copies(frequency, np.array([9, 1, 9, 9, 9]), 0.8) == 9
    assert near_dedup.own_copies(frequency, np.array([9, 1, 1, 9, 9]), 0.8) == 1
    assert near_dedup.own_copies(frequency, np.array([4, 1, 7, 9, 8]), 0.8) == 4
    none = np.zeros(0, np.int64)
    assert near_dedup.own_copies(none, none, 0.8) == 1
    # A text's copies do not lower the weight of its shingles; a passage that more documents have still weighs less.
    assert near_dedup.weights(np.ones(4), np.array([6, 6, 6, 60]), 600, 0.8).round(6).tolist() == [round(1 + np.log(600), 6)] * 3 + [round(1 + np.log(60), 6)]
    assert near_dedup.weights(np.ones(2), np.array([6, 60]), 600).round(6).tolist() == [round(1 + np.log(100), 6), round(1 + np.log(10), 6)]


def test_texts_are_shuffled_in_small_form(spark):
    long = " ".join(f"word {n} of a text" for n in range(500))
    rows = [(1, 5, None), (2, 5, ""), (3, 5, "é" * 3 + " \u3000x"), (None, 5, long)]
    packed = near_dedup.small_texts(spark.createDataFrame(rows, "__id long, __hash long, __text string")).toArrow()
    assert [near_dedup.text_of(x) for x in packed["__text"]] == [x for _, _, x in rows]
    assert packed["__id"].to_pylist() == [1, 2, 3, None] and len(packed["__text"][3].as_py()) < len(long) / 3


def test_samples_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    a = np.sort(rng.integers(0, 1 << 63, 300).astype(np.uint64))
    wa, wb = rng.random(300) * 4 + 0.1, rng.random(300) * 4 + 0.1
    true = near_dedup.weighted_jaccard(a, wa, a, wb)
    equal = np.mean(near_dedup.samples(a, wa, 3000) == near_dedup.samples(a, wb, 3000))
    assert abs(equal - true) < 0.04


# --- 2 ---------------------------------------------------------------------------------------


def test_edited_counts_equal_counts_from_scratch(spark, small, documents):
    counter = token_counts.shared_counter(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    encode = counter.encoding.encode_ordinary
    docs = documents.select("doc_id", "text").withColumn("edits", token_counts.derived_edits())
    edited = token_counts.apply_edits(token_counts.build(docs)).collect()
    got = {r["doc_id"]: r for r in query(spark, small, "op2_token_counts").collect()}
    originals = {r["doc_id"]: r for r in docs.collect()}
    for r in edited:
        t = originals[r["doc_id"]]["text"]
        assert got[r["doc_id"]]["tokens_before"] == len(encode(t))
        for s in originals[r["doc_id"]]["edits"]:
            t = t[: s["start"]] + s["insert"] + t[s["start"] + s["remove"] :]
        assert r["text"] == t and r["tokens"] == len(encode(t)) == got[r["doc_id"]]["tokens_after"]
    assert sum(r["encoded_again"] for r in edited) < 0.1 * sum(len(r["text"]) for r in edited)


def test_random_edits_keep_the_tree_right():
    counter = token_counts.shared_counter(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    random.seed(7)
    parts = ["a", "b", " ", "  ", "\n", "'", "'ll", "1", "é", "!", "\t", " the"]
    some = lambda n: "".join(random.choices(parts, k=n))
    for trial in range(300):
        value = some(random.choice([0, 3, 12, 400]))
        pieces = counter.pieces(value)
        tree = token_counts.Tree(np.array([len(p) for p in pieces], np.int64), np.array(counter.count(pieces), np.int64))
        for _ in range(5):
            value, _ = token_counts.edit(tree, value, random.randint(-1, len(value) + 1), random.randint(0, 6), some(random.choice([0, 1, 5, 300])), counter)
            assert [n for x, _ in tree.leaves for n in x] == [len(p) for p in counter.pieces(value)]
            assert tree.count == len(counter.encoding.encode_ordinary(value))


def test_counts_of_awkward_rows(awkward, empty):
    edits = F.array(F.struct(F.lit(-5).cast("long").alias("start"), F.lit(99).cast("long").alias("remove"), F.lit(None).cast("string").alias("insert")))
    rows = token_counts.apply_edits(token_counts.build(awkward.withColumn("edits", edits).withColumn("tokens", F.lit(0)))).collect()
    assert len(rows) == len(AWKWARD) and all(r["tokens"] == 0 for r in rows if r["doc_id"] in (1, 2, 3, 7))
    none = token_counts.apply_edits(token_counts.build(empty.withColumn("edits", edits)))
    assert none.count() == 0


# --- 3 ---------------------------------------------------------------------------------------


def archive_rows(pages):
    first = {}
    for i, h in sorted(pages):
        first.setdefault(h or "", i)
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    return sorted(
        (i, len((h or "").encode()), digest(h), "response" if first[h or ""] == i else "revisit", -1 if first[h or ""] == i else first[h or ""]) for i, h in pages
    )


def collected(df):
    return sorted((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], -1 if r["refers_to"] is None else r["refers_to"]) for r in df.collect())


def test_pages_come_back_from_archives(spark, small, tmp_path):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    # Copies, a null and empty payloads, under new ids; a folder in which the query finds them.
    more = pages.selectExpr("page_id + 1000 AS page_id", "url", "CASE page_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE html END AS html")
    pages.unionByName(more).write.parquet(f"{tmp_path}/pages.parquet")
    want = archive_rows([(r["page_id"], r["html"]) for r in pages.unionByName(more).collect()])
    assert collected(query(spark, str(tmp_path), "op3_warc_round_trip")) == want


def test_archive_filters_are_pushed_and_skip_payloads(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/x", "one"), (2, "http://b/\r\ny", "two"), (3, None, "one"), (None, "http://c", None)], "page_id long, url string, html string")
    warc.write_pages(pages, f"{tmp_path}/w")
    got = warc.read_archives(spark, f"{tmp_path}/w", verify="true")
    plan = got.where("record_type = 'response' and target_uri like 'http://a%'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.split("BatchScan")[0]
    assert [bytes(r["payload"]) for r in got.where("target_uri like 'http://a%'").collect()] == [b"one"]
    assert got.where("record_type = 'revisit'").collect()[0]["refers_to"] == "<urn:page:1>"
    assert got.where("target_uri is null and record_type = 'revisit'").count() == 1
    assert {r["target_uri"] for r in got.where("record_type in ('response', 'revisit')").collect()} == {"http://a/x", "http://b/%0D%0Ay", None, "http://c"}
    assert all(r["payload"] is None for r in warc.read_archives(spark, f"{tmp_path}/w", payload="false").collect())
    warc.write_pages(pages.where("page_id > 99"), f"{tmp_path}/none")
    assert warc.read_archives(spark, f"{tmp_path}/none").where("record_type <> 'warcinfo'").count() == 0


def test_foreign_archives_are_read(spark, tmp_path):
    """Uncompressed records, and gzip members without a skip length."""
    import gzip

    block = b"HTTP/1.1 200 OK\r\nContent-Length: 5\r\n\r\nhello"
    record = warc.record({"WARC-Type": "response", "WARC-Record-ID": "<urn:x>", "Content-Type": "application/http"}, block)
    other = warc.record({"WARC-Type": "metadata", "WARC-Record-ID": "<urn:y>"}, b"z" * 200_000)
    (tmp_path / "a.warc").write_bytes(record + other + record)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(other) + gzip.compress(record))
    got = warc.read_archives(spark, str(tmp_path))
    assert [bytes(r["payload"]) for r in got.where("record_type = 'response'").collect()] == [b"hello"] * 3
    assert got.where("record_type = 'metadata'").agg(F.sum(F.length("payload"))).first()[0] == 400_000


# --- 4 ---------------------------------------------------------------------------------------


def packed_rightly(rows, texts):
    """Every id in one piece, pieces gapless in sequences, no padding."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t in texts.items()}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert by_doc.keys() == ids.keys()
    for i, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids[i])
            assert p["ids_crc32"] == zlib.crc32(ids[i][at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids[i])
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048 and at & (at - 1) == 0


def test_packing_loses_nothing(spark, small, plain):
    packed_rightly(query(spark, small, "op4_bm25_packing").collect(), plain)


def test_packing_of_awkward_rows(spark, awkward, empty):
    rows = [(n, t) for n, (_, t) in enumerate(AWKWARD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    packed_rightly(packing.pack(docs).withColumn("ids_crc32", F.crc32("ids")).collect(), dict(rows))
    assert packing.pack(awkward).agg(F.count_distinct("sequence_id")).first()[0] > 0
    assert packing.pack(empty).count() == 0


def test_neighbours_come_by_falling_score():
    documents = [np.array(x, np.uint16) for x in ([5, 6, 7], [8, 9], [5, 6, 10], [11], [5, 12])]
    counts = np.bincount(np.concatenate([np.unique(d) for d in documents]), minlength=20)
    idf = np.log((100 - counts + 0.5) / (counts + 0.5))
    first = packing.fill_windows(documents, idf, 3.0, window=10)[0]
    assert [p[0] for p in first] == [0, 2, 4, 1]


def test_related_documents_meet_wherever_they_stand(spark):
    # 40 themes of 15 documents of about 150 tokens; documents of a theme stand 40 places apart.
    ids = tokens.shared_ids(public_tokenizers.path("word_bpe_49k.json"))
    vocabulary = sorted(w[:-4] for w in ids.tokenizer.get_vocab() if w.endswith("</w>") and w[:-4].isascii() and w[:-4].isalpha() and len(w) > 9)
    rng = random.Random(5)
    rng.shuffle(vocabulary)
    common, own = vocabulary[:400], vocabulary[400:]
    rows = [(n, " ".join(rng.choices(common, k=110) + own[n % 40 * 8 : n % 40 * 8 + 8] * 5)) for n in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def windows(frame, **options):
        found = {}
        for r in packing.pack(frame, **options).collect():
            found.setdefault(r["sequence_id"], []).append((r["offset"], r["doc_id"], r["start"], r["length"]))
        return {k: sorted(v) for k, v in found.items()}

    for options in ({}, {"shard_tokens": 10_000}):
        got = windows(docs.repartition(3, "doc_id"), **options)
        assert got == windows(docs.orderBy(F.desc("doc_id")).coalesce(1), **options)
        full = [[i % 40 for _, i, _, _ in w] for w in got.values() if sum(p[3] for p in w) == 2048]
        assert np.mean([t.count(t[0]) / len(t) for t in full]) > 0.6
        assert len({i for w in got.values() for _, i, _, _ in w}) == 600


def test_routes_bound_every_shard():
    sizes = np.array([5, 400, 30, 70, 0, 90])
    routes = packing.Routes(sizes, {(1, 3): 250}, 100)
    # The large pair has three shards, what is left of its first term two, the others are gathered.
    assert {routes.shard(1, 3, row) for row in range(-9, 9)} == {0, 1, 2}
    assert {routes.shard(1, b, 0) for b in range(20, 60)} == {4, 5} and routes.shard(0, 9, 7) == 3
    assert routes.shard(2, 0, 1) == routes.shard(3, 1, 2) != routes.shard(5, 0, 1) and routes.count == 8


def test_remembered_pieces_encode_as_the_tokenizer(plain):
    ids = tokens.Ids(public_tokenizers.path("word_bpe_49k.json"), memory=500)
    texts = list(plain.values())[:60] + [t for _, t in AWKWARD] + ["ΑΣ Σ ΟΔΟΣ.", "İx ǅ", "a b　c"]
    for at in range(0, len(texts), 7):
        for t, got in zip(texts[at : at + 7], ids.encode(texts[at : at + 7])):
            assert got.tolist() == ids.tokenizer.encode(t or "", add_special_tokens=False).ids


def test_letters_are_encoded_once_and_frequent_pieces_stay():
    ids = tokens.Ids(public_tokenizers.path("word_bpe_49k.json"), memory=40)
    words, learn = [], ids._word_ids
    ids._word_ids = lambda found: words.extend(found) or learn(found)
    ids.encode(["Zanzibarov zanzibarov, (odd) Zanzibarov. ZANZIBAROV!", None, " zanzibarov "])
    assert words == ["zanzibarov"]
    for n in range(20):
        ids.encode([f"zanzibarov {' '.join(f'w{n}x{k}' for k in range(30))}"])
    assert words.count("zanzibarov") == 1 and "zanzibarov" in ids.place and len(ids.place) < 120


def test_case_and_marks_take_no_place_in_the_memory():
    ids = tokens.Ids(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["Erou erou, EROU. ÉROU!! it's", "é K İx İx, µm ½. \u1e9ea ERou,", None, "  ", "Straße, STRASSE; x\x1cErou."]
    for t, got in zip(texts, ids.encode(text.pa.chunked_array([texts]).cast("large_string").combine_chunks())):
        assert got.tolist() == ids.tokenizer.encode(t or "", add_special_tokens=False).ids
    assert {"erou", "érou", ","} <= set(ids.place) and not {"Erou", "erou,", "EROU.", "ÉROU!!"} & set(ids.place)


def test_portions_hold_whole_rows():
    batch = text.pa.RecordBatch.from_pydict({"t": ["aaaa", None, "bb", "c" * 20, "", "dd", "d"]})
    got = [b["t"].to_pylist() for b in text.portions(iter([batch, batch.slice(0, 0)]), "t", 5)]
    assert sum(got, []) == batch["t"].to_pylist() and [len(g) for g in got] == [2, 1, 4]


def test_a_task_gives_unused_memory_back(monkeypatch):
    calls = []
    monkeypatch.setattr(text.pa, "default_memory_pool", lambda: type("Pool", (), {"release_unused": lambda self: calls.append(1)})())
    batch = text.pa.RecordBatch.from_pydict({"a": [1, 2, 3]})
    assert [b.num_rows for b in text.slices(iter([batch, batch]), 2)] == [2, 1, 2, 1] and calls == [1]
    assert tokens.MEMORY <= 400_000  # pieces that each worker keeps between tasks


def test_index_drops_used_documents():
    rng = np.random.default_rng(2)
    documents = [rng.integers(0, 50, 40) for _ in range(30)]
    index = packing.Shard(documents, np.ones(50, np.float32), 40.0)
    unused = np.arange(5, 30, 3)
    before, size = index.scores(3), len(index.documents)
    index.keep(unused)
    assert np.array_equal(index.scores(3)[unused], before[unused]) and len(index.documents) < size / 2


# --- 5 ---------------------------------------------------------------------------------------


def test_quality_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = query(spark, folder, "op5_quality_crf").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(held) > 50 and np.mean([p == y for p, y in held]) > 0.93


def test_marginals_agree_with_enumeration():
    rng = np.random.default_rng(2)
    lines = np.array([1, 4, 3])
    unary, transition = rng.normal(size=(8, 2)), rng.normal(size=(2, 2))
    good, pairs, log_z = quality.marginals(unary, transition, lines)
    at, want_pairs = 0, np.zeros((2, 2))
    for d, n in enumerate(lines):
        weight, mass = 0.0, np.zeros(n)
        for code in range(1 << n):
            y = [code >> k & 1 for k in range(n)]
            w = np.exp(sum(unary[at + k, y[k]] for k in range(n)) + sum(transition[a, b] for a, b in zip(y, y[1:])))
            weight += w
            mass += w * np.array(y)
        for code in range(1 << n):
            y = [code >> k & 1 for k in range(n)]
            w = np.exp(sum(unary[at + k, y[k]] for k in range(n)) + sum(transition[a, b] for a, b in zip(y, y[1:]))) / weight
            for a, b in zip(y, y[1:]):
                want_pairs[a, b] += w
        assert np.allclose(good[at : at + n], mass / weight) and np.isclose(log_z[d], np.log(weight))
        at += n
    assert np.allclose(pairs, want_pairs)


def test_quality_of_awkward_rows(spark, awkward, empty):
    labels = spark.createDataFrame([(4, 1), (7, 0), (7, 1), (9, 0), (None, 1), (10, None), (6, 1)], "doc_id long, quality int")
    model = quality.train(awkward, labels)
    rows = quality.score(awkward, model).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.train(awkward, labels.where("doc_id > 99")) == {"constant": 0.5}
    assert quality.score(empty, model).count() == 0


# --- 6 ---------------------------------------------------------------------------------------


def cut_by_brute_force(rows, size=50):
    first, out = {}, []
    for i, t in sorted(rows):
        b = (t or "").encode()
        removed = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if first.setdefault(b[k : k + size], i) < i:
                removed[k : k + size] = b"\1" * size
        kept = bytes(c for c, r in zip(b, removed) if not r)
        spans = sum(1 for k in range(len(b)) if removed[k] and (not k or not removed[k - 1]))
        out.append((i, len(b), sum(removed), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_byte_passages_agree_with_brute_force(spark, small, plain):
    got = sorted(map(tuple, query(spark, small, "op6_suffix_dedup").collect()))
    assert got == cut_by_brute_force(plain.items())


def test_byte_passages_of_awkward_rows(spark, awkward, empty):
    rows = [(4, PROSE), (4, PROSE), (5, PROSE), (1, None), (2, ""), (8, "ab" * 400), (9, "x" + "ab" * 300), (11, LONG), (12, PROSE[:49]), (13, "é" * 60 + PROSE)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(tuple(r)[:5] for r in suffix_dedup.remove_repeats(docs).collect()) == sorted(cut_by_brute_force(rows))
    assert suffix_dedup.remove_repeats(awkward).count() == len(AWKWARD)
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_collection_transform_agrees_with_sorted_suffixes():
    random.seed(3)
    for _ in range(60):
        strings = [bytes(random.choices(b"abc", k=random.randint(1, 12))) for _ in range(random.randint(1, 8))]
        lengths = np.array([len(s) for s in strings])
        rows = np.zeros((len(strings), lengths.max()), np.uint8)
        for n, s in enumerate(strings):
            rows[n, lengths.max() - len(s) :] = np.frombuffer(s, np.uint8)
        transform, common = suffix_dedup.build(rows, lengths)
        string, length = suffix_dedup.suffix_rows(transform, lengths)
        got = [strings[a][len(strings[a]) - b :] for a, b in zip(string, length)]
        assert got == sorted(got)
        shared = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert [0] + [shared(a, b) for a, b in zip(got, got[1:])] == common.tolist()


def test_collections_hold_strings_of_like_length(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "LOT_STRINGS", 4)
    anchor = np.arange(16, dtype=np.uint64) % 8
    size = np.where(anchor % 2, 50, 81)
    size[4] = 60  # beside a longer string of its anchor
    lots = list(suffix_dedup._lots(anchor, size))
    assert sorted(np.concatenate(lots).tolist()) == list(range(16))
    assert [size[x].max() for x in lots] == [50, 50, 81, 81] and 60 in size[lots[2]].tolist() + size[lots[3]].tolist()
    for lot in lots:
        assert not np.isin(np.delete(anchor, lot), anchor[lot]).any()


def test_strings_are_aligned_to_the_right():
    data = np.arange(1, 201, dtype=np.uint8)
    got = suffix_dedup.right_aligned(data, np.array([50, 81, 200]), np.array([50, 60, 81]))
    assert [x[x > 0].tolist() for x in got] == [list(range(1, 51)), list(range(22, 82)), list(range(120, 201))]
    assert got.shape == (3, suffix_dedup.WIDTH) and (got[0][:31] == 0).all()


def test_short_texts_are_cut_into_pieces_together(monkeypatch):
    rng = np.random.default_rng(4)
    texts = [rng.integers(97, 100, n).astype(np.uint8) for n in (0, 49, 50, 51, 700, 90, 3000, 0, 400)] + [np.zeros(500, np.uint8)]
    calls, one = [], suffix_dedup._pieces
    monkeypatch.setattr(suffix_dedup, "_pieces", lambda *x: calls.append(1) or one(*x))
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", 2000)
    got = list(suffix_dedup.with_pieces(iter(enumerate(texts))))
    assert len(calls) == 3 and [k for k, _, _ in got] == list(range(10))
    for key, data, found in got:
        assert data is texts[key] and all(np.array_equal(a, b) for a, b in zip(found, suffix_dedup.pieces(data), strict=True))


def test_anchors_are_dealt_evenly():
    rng = np.random.default_rng(4)
    anchors = np.unique(suffix_dedup.pieces(rng.integers(97, 123, 200_000).astype(np.uint8))[2])
    sizes = [len(row.column("a0")[0].as_py()) // 8 for row in suffix_dedup._dealt(anchors, 18, [], [anchors])]
    assert sum(sizes) == len(anchors) and len(sizes) == 18 and max(sizes) < 1.2 * len(anchors) / 18


# --- 7 ---------------------------------------------------------------------------------------


def test_line_windows_agree_with_sql(spark, small):
    assert compare.difference(spark, compare.database(small), "op7_line_dedup", small) is None


def test_line_windows_of_awkward_rows(awkward, empty):
    rows = line_dedup.remove_repeated_windows(awkward).collect()
    by_id = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(AWKWARD) and by_id[1]["kept"] is None and by_id[2]["kept"] == "" and by_id[9]["n_removed"] == 0
    assert by_id[7]["kept"] == "a\nb\nc\nd" and by_id[8]["kept"] == "" and by_id[8]["n_removed"] == 3
    assert line_dedup.remove_repeated_windows(empty).count() == 0


def test_line_windows_of_a_long_text(spark):
    """Half of 200,000 lines repeat, in runs of five; the time is that of a sort."""
    lines = [f"line {n}" for n in range(200_000)]
    other = [line if n % 10 < 5 else f"{line} too" for n, line in enumerate(lines)]
    docs = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(other))], "doc_id long, text string")
    first, second = line_dedup.remove_repeated_windows(docs).orderBy("doc_id").collect()
    assert first["n_removed"] == 0 and first["kept"] == "\n".join(lines)
    assert second["n_removed"] == 100_000 and second["kept"] == "\n".join(line for line in other if line.endswith("too"))


# --- 8 ---------------------------------------------------------------------------------------


def neighbours_by_brute_force(rows, k=10):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    found = set()
    for own, (q, v) in enumerate(good):
        if q % 100 == 0:
            near = sorted((float(np.sqrt(np.square(w - v).sum())), i) for at, (i, w) in enumerate(good) if at != own and len(w) == len(v))
            found |= {(q, n + 1, i, d) for n, (d, i) in enumerate(near[:k])}
    return found


def test_nearest_by_factor(spark, small):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    want = {(q, i) for q, _, i, _ in neighbours_by_brute_force(rows)}
    exact = vptree.nearest(vectors, vectors.where("vec_id % 100 = 0"), factor=1.0, shard=100).collect()
    assert {(r["query_id"], r["vec_id"]) for r in exact} == want
    relaxed = query(spark, "/root/testdata/sf0.01", "op8_vantage_point_search").collect()
    assert len(want & {(r["query_id"], r["vec_id"]) for r in relaxed}) >= 0.9 * len(want)


def test_nearest_of_awkward_rows(spark):
    rows = [(0, [1.0, 2.0]), (100, [1.0, 2.0]), (3, None), (200, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, [1.0]), (None, [1.0, 1.0])]
    rows += [(n, [1.0, 2.5]) for n in range(8, 70)] + [(70, [float("inf"), 1.0])]
    # Equal rows, equal ids of unlike vectors, and more equal vectors of smaller ids than are asked for.
    rows += [(300, [9.0, 2.0]), (300, [9.0, 2.0]), (400, [5.0, 5.0]), (400, [5.0, 5.5]), (100, [1.0, 2.1]), (500, [1.0, 2.5])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    got = vptree.nearest(vectors, vectors.where("vec_id % 100 = 0"), factor=1.0).collect()
    assert {tuple(r) for r in got} == neighbours_by_brute_force(rows)
    assert vptree.nearest(vectors.where("vec_id < 0"), vectors.where("vec_id < 0")).count() == 0


# --- 9 ---------------------------------------------------------------------------------------


def overlaps_by_brute_force(texts, items):
    """(document, item) pairs with an aligned window that agrees enough, from token tuples."""
    split = lambda t: re.sub(r"[!-/:-@\[-`{-~]", " ", (t or "").lower()).split()
    found = set()
    words = {i: split(t) for i, t in items.items()}
    for d, t in texts.items():
        own = split(t)
        for i, w in words.items():
            size = min(13, len(w))
            if size < 5 or not set(own) & set(w):
                continue
            need = size - int(0.2 * size + 1e-9)
            for diagonal in range(-len(w) + size, len(own) - size + 1):
                lo, hi = max(diagonal, 0), min(diagonal + len(w), len(own))
                equal = [own[k] == w[k - diagonal] for k in range(lo, hi)]
                if any(sum(equal[k : k + size]) >= need for k in range(len(equal) - size + 1)):
                    found.add((d, i))
                    break
    return found


def test_overlaps_agree_with_all_alignments(spark, small, documents):
    benchmark = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()}
    texts = {r["doc_id"]: r["text"] for r in documents.where("length(text) < 4000").collect()}
    got = {(r["doc_id"], r["item_id"]) for r in query(spark, small, "op9_benchmark_decontamination").collect()}
    assert got and {g for g in got if g[0] in texts} == overlaps_by_brute_force(texts, benchmark)


def test_substituted_tokens_are_found(spark, empty):
    random.seed(9)
    words = [f"w{n}" for n in range(40)]
    texts, items = {}, {0: " ".join(words), 1: " ".join(words[:7]), 2: "a b c", 3: None, 4: ""}
    for n in range(60):
        own = words[10:23]
        for k in random.sample(range(13), n % 4):
            own[k] = "other"
        texts[n] = " ".join(["x", "y", *own, "z"])
    texts |= {100: "W1, w2; (w3) nope w5 w6?", 101: None, 102: "", 103: "a b c"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    benchmark = spark.createDataFrame([*items.items(), (0, items[0])], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.benchmark_overlaps(docs, benchmark).collect()}
    assert got == overlaps_by_brute_force(texts, items)
    assert decontamination.benchmark_overlaps(docs, benchmark.where("item_id > 9")).count() == 0
    assert decontamination.benchmark_overlaps(empty, benchmark).count() == 0


def test_blocks_of_the_benchmark_find_the_same(spark, small, documents, monkeypatch):
    benchmark = spark.read.parquet(f"{small}/benchmark.parquet")
    whole = sorted(map(tuple, decontamination.benchmark_overlaps(documents, benchmark).collect()))
    monkeypatch.setattr(decontamination, "BLOCK_CHARS", 1500)
    assert sorted(map(tuple, decontamination.benchmark_overlaps(documents, benchmark).collect())) == whole


# --- 10 --------------------------------------------------------------------------------------

PLAIN_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def spans_by_brute_force(value):
    def luhn(d):
        return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0

    found = []
    for kind, pattern in PLAIN_PATTERNS.items():
        for m in re.finditer(pattern, value or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fine:
                found.append((m.start(), list(PLAIN_PATTERNS).index(kind), f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x for _, _, x in sorted(found))


def test_base_spans_agree_with_plain_patterns(spark, documents):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = pii.sanitise(docs).collect()
    assert any(r["base"] for r in rows)
    assert all(r["base"] == spans_by_brute_force(r["text"]) for r in rows)
    digest = {r["doc_id"]: r["base_sha256"] for r in query(spark, "/root/testdata/sf0.01", "op10_pii_sanitisation").collect()}
    assert all(digest[r["doc_id"]] == hashlib.sha256(r["base"].encode()).hexdigest() for r in rows)


def test_base_spans_of_odd_texts(spark, awkward, empty):
    values = [
        "a@b.c+x@d.e a@b..c x.y@z a@b.c@d.e", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.255 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1111 41111111111111112",
        "++1 (555) 123-4567 +1 +12345678901234567 +4911122233", "é\U0001f600 a@b.c ☃ +49 30 1234567", "7" * 5000 + "@", "a@" * 3000, "1." * 3000, "1 2 3 4 5 6 7 8 9 0 1 2",
    ]
    docs = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "doc_id long, text string")
    for r in pii.sanitise(docs).collect():
        assert r["base"] == spans_by_brute_force(r["text"]), r["text"][:60]
    assert pii.sanitise(awkward).count() == len(AWKWARD) and pii.sanitise(empty).count() == 0


def test_disclosing_terms_are_generalised(spark):
    rows = [(n, f"Report {n} by Zanzibarov and colleague, mail z.b@corp.example today\nUnrelated line {n}") for n in range(6)]
    rows += [(100 + n, f"Report number {n} by somebody and colleague today") for n in range(200)]
    rows += [(500 + n, "Copied Onceonly mail o.o@corp.example") for n in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.sanitise(docs).collect()}
    assert "[Name]" in got[0]["sanitised"] and "[EMAIL]" in got[0]["sanitised"] and "Zanzibarov" not in got[0]["sanitised"]
    assert "colleague" in got[0]["sanitised"] and got[0]["n_terms"] >= 1 and "term:12:22" in got[0]["spans"]
    # Copies of one line prove nothing.
    assert got[500]["n_terms"] == 0 and got[100]["sanitised"] == got[100]["text"]


def test_one_or_two_texts_can_disclose(spark):
    rows = [(n, f"Filler text number {n} of somebody") for n in range(4000)]
    rows += [(5000 + n, f"Somebody {w} asked Quillfeather, mail q.f@corp.example") for n, w in enumerate(["gladly", "sadly"])]
    rows += [(6000, "Somebody Ottermole has mail o.m@corp.example"), (6001, "Ottermole has"), (6002, "Ottermole has"), (6003, "Ottermole has")]
    # Copies of a text are one piece of evidence: 2/3, where three would be 4/5.
    rows += [(7000 + n, "Somebody Wimpleton, mail w.t@corp.example") for n in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["sanitised"] for r in pii.sanitise(docs).where("doc_id >= 5000").collect()}
    assert all("Quillfeather" not in got[n] and "Somebody" in got[n] and "mail" in got[n] for n in (5000, 5001))
    assert "Ottermole" in got[6000] and "Somebody" in got[6000]
    assert all("Wimpleton" in got[n] for n in (7000, 7001, 7002))


def test_terms_near_entities_go_everywhere(spark):
    rows = [(n, f"Filler text number {n} of somebody") for n in range(400)]
    signed = "Regards to you,\n{}\nAccount K7714\nli.x@corp.example\nFar\nbelow\nnothing"
    rows += [(1000 + n, f"Letter {n}: Li wrote K7714\n\n\n\n" + signed.format("Li")) for n in range(9)]
    rows += [(1100 + n, f"Note {n} for 王明 at +49 30 1234569") for n in range(12)]
    rows += [(2000, "Somebody met Li and 王明 of K7714, kin of K77140, li.x@corp.example"), (2001, "Li and K7714 came by")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.sanitise(docs).where("doc_id >= 1000").collect()}
    assert not any(re.search(r"\bLi\b|\bK7714\b", got[n]["sanitised"]) for n in (*range(1000, 1009), 2000, 2001))
    assert not any("王明" in got[n]["sanitised"] for n in (*range(1100, 1112), 2000))
    assert "K77140" in got[2000]["sanitised"] and "[EMAIL]" in got[2000]["sanitised"] and "[EMAIL]" in got[1000]["sanitised"]
    assert "nothing" in got[1000]["sanitised"]


def test_only_texts_with_terms_are_shuffled(spark, monkeypatch):
    rows = [(1, "Zanzibarov said zanzibarov"), (2, "Nothing"), (2, "Nothing"), (None, "So ZANZIBAROV and Other"), (4, None), (5, "a.b@c.de Zanzibarov")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = docs.selectExpr("coalesce(string(doc_id), 'null') __id", "xxhash64(coalesce(text, '')) __hash", "coalesce(text, '') __text")
    spans = pii.base_spans(pii.documents_with_matches(keyed, ["__id", "__hash"], "__text"), ["__id", "__hash"], "__text")
    terms = spark.createDataFrame([("x", "zanzibarov"), ("x", "other"), ("y", "zanzibarov")], "entity string, word string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = {}
        for limit in (0, 1 << 20):
            monkeypatch.setattr(pii, "BROADCAST_TERMS", limit)
            frame = pii.term_spans(keyed, spans, terms, ["__id", "__hash"])
            found[limit] = sorted((r["__id"], r["start"], r["end"], r["value"]) for r in frame.collect())
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert found[0] == found[1 << 20] == [("1", 0, 10, "Zanzibarov"), ("1", 16, 26, "zanzibarov"), ("5", 9, 19, "Zanzibarov"), ("null", 3, 13, "ZANZIBAROV"), ("null", 18, 23, "Other")]
    # No join on the documents' keys, which would move every text.
    assert not [line for line in plan.splitlines() if "Join" in line and "__hash" in line]


def test_chance_neighbours_stay_at_any_size(spark):
    """A word beside an entity goes if two different texts show it and it is seldom elsewhere."""
    for size in (60, 3000):
        rows = [(n, f"Plain words {n} of people with letters") for n in range(size)]
        rows += [(10_000, "Zorbina wrote\nwith quillon a.b@corp.example")]
        rows += [(10_020 + n, f"Letter {n * 7} of Zorbina, with people\na.b@corp.example") for n in range(3)]
        # Copies of a text count once, and words of the corpus stay.
        rows += [(10_002 + n, "Mertal of c.d@corp.example") for n in range(3)]
        rows += [(10_010, "Seen: Zorbina and Mertal and quillon")]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = {r["doc_id"]: r for r in pii.sanitise(docs).where("doc_id >= 10000").collect()}
        assert "Zorbina" not in got[10_000]["sanitised"] + got[10_021]["sanitised"]
        assert got[10_010]["sanitised"] == "Seen: [Name] and Mertal and quillon"
        assert "Mertal" in got[10_002]["sanitised"] and "quillon" in got[10_000]["sanitised"] and "people" in got[10_021]["sanitised"]


# --- helpers ---------------------------------------------------------------------------------


def test_word_hashes_do_not_depend_on_chunks(monkeypatch):
    value = " ".join(f"w{n}" for n in range(500)) + " " + "x" * 900
    whole = text.word_hashes(value)
    monkeypatch.setattr(text, "CHUNK_BYTES", 64)
    assert (text.word_hashes(value) == whole).all() and len(whole) == 501
