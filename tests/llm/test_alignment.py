"""Cross-tokenizer alignment against plain tokenisation and counting of whole texts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wearline.llm import alignment
from wearline.llm.byte_ids import byte_letters
from wearline.llm.queries import op13_cross_tokenizer_alignment

PATHS = [public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
BITS = ["a", "foo", " ", "  ", "\n", "\t", "\r", "\r\n", "é", "é", "'s", "...", "<|endoftext|>", "<s>", "<0x41>", "12", "½", "　", "\x85", "\x1c", "\0", ",",
        "你好", "​", "𝒜", "\xa0", "'ll", "I", "▁"]


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(PATHS[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
        self.back = {c: b for b, c in byte_letters().items()}

    def piece(self, i):
        name = self.b.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace("▁", " ").encode()

    def align(self, text):
        """(n_a, n_b, groups as text, linked (b, a)), or None without tokens."""
        if not text:
            return None
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        a_bytes, b_bytes = [bytes(self.back[c] for c in self.a.id_to_token(i)) for i in a], [self.piece(i) for i in b]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            return None
        ends = [{int(e): k for k, e in enumerate(np.cumsum([len(t) for t in side]))} for side in (a_bytes, b_bytes)]
        groups, links, at = [], [], (0, 0)
        for end in sorted(ends[0].keys() & ends[1].keys()):
            i, j = ends[0][end], ends[1][end]
            groups.append(f"{','.join(map(str, a[at[0] : i + 1]))}|{','.join(map(str, b[at[1] : j + 1]))}")
            links.append((b[j], a[i]))
            at = i + 1, j + 1
        return len(a), len(b), groups, links

    def table(self, rows):
        aligned = [(doc_id, self.align(text)) for doc_id, text in rows]
        counts = Counter(link for _, found in aligned if found for link in found[3])
        best = {}
        for (b, _), n in counts.items():
            best[b] = max(best.get(b, 0), n)
        out = []
        for doc_id, found in aligned:
            if not found:
                out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
                continue
            n_a, n_b, groups, links = found
            out.append((doc_id, n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links),
                        hashlib.sha256(";".join(groups).encode()).hexdigest()))
        return sorted(out, key=str)


@pytest.fixture(scope="module")
def plain():
    return Plain()


def test_pieces_give_the_alignment_of_whole_texts(plain):
    draw = random.Random(8)
    texts = ["".join(draw.choice(BITS) for _ in range(draw.randint(0, 14))) for _ in range(3_000)]
    aligner = alignment.Aligner(*PATHS, memory=400)  # forgets many times
    for at in range(0, len(texts), 100):
        for text, got in zip(texts[at : at + 100], aligner.align(texts[at : at + 100])):
            want = plain.align(text)
            assert (got is None) == (want is None), text
            if got:
                assert got[:3] == (want[0], want[1], len(want[2])), text
                assert got[3] == hashlib.sha256(";".join(want[2]).encode()).hexdigest(), text
                assert got[4].tolist() == [b * aligner.width + a for b, a in want[3]], text


@settings(max_examples=50, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 2**32 - 1), st.integers(1, 9), min_size=1, max_size=60), min_size=1, max_size=7), st.integers(1, 20))
def test_heap_merge_adds_up_runs(runs, frame):
    whole = alignment.FRAME_PAIRS
    alignment.FRAME_PAIRS = frame
    try:
        packed = [alignment.frames_of(np.array(sorted(r)), np.array([r[k] for k in sorted(r)])) for r in runs]
        parts = list(alignment.merge_runs(packed))
    finally:
        alignment.FRAME_PAIRS = whole
    keys = [int(k) for part, _ in parts for k in part]
    total = sum((Counter(r) for r in runs), Counter())
    assert keys == sorted(total)
    assert [int(c) for _, part in parts for c in part] == [total[k] for k in keys]


def test_query_against_brute_force(spark, small, plain):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = op13_cross_tokenizer_alignment(spark, small).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == plain.table(rows)


def test_many_runs_levels_and_awkward_texts(spark, plain, monkeypatch):
    for name, value in {"RUN_LINKS": 40, "RUN_DOCS": 3, "FAN": 2, "FRAME_PAIRS": 5}.items():
        monkeypatch.setattr(alignment, name, value)
    draw = random.Random(9)
    words = ["the", "of", "word", "sequel", "ñandú", "123", "x,"]
    rows = [(k, " ".join(draw.choice(words) for _ in range(draw.randint(1, 30)))) for k in range(40)]
    rows += [(100, None), (101, ""), (102, " "), (103, "a▁b"), (104, "three   spaces\n\n\nend  "), (105, "the " * 4_000), (7, "the of"), (7, "the of"), (None, "of the")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("run", F.lit("x")).withColumn("bucket", F.lit(2.0)).withColumn("n_a", F.lit(1)).repartition(3)
    got = alignment.align(docs).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == plain.table(rows)


def test_tables_without_links(spark):
    schema = "doc_id long, text string"
    assert alignment.align(spark.createDataFrame([], schema)).collect() == []
    got = alignment.align(spark.createDataFrame([(1, None), (2, "")], schema)).select(*COLUMNS).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
