"""The id coder and token files: exact round trips, whole results, damaged data."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wearline.llm import id_coder, token_files
from wearline.llm.byte_ids import ByteIds
from wearline.llm.queries import op11_token_ids
from wearline.session import fresh_path

VOCABULARY = "byte_bpe_50k.json"
BITS = ["a", "foo", " ", "  ", "\n", "\t", "\r\n", "é", "é", "'s", "...", "<|endoftext|>", "12", "½", "　", "\x85", "\x1c", "\0", ",", "你好", "​", "𝒜", "\xa0", "'ll", "I"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(VOCABULARY))


def brute_force(tokenizer, rows):
    start, found = 0, []
    for doc_id, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        found.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return found


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 12), st.integers(1, 900), st.integers(1, 12), st.sampled_from([1, 3, 300, 50_257]), st.integers(0, 2**32))
def test_coder_round_trip(lanes, length, full, values, seed):
    rng = np.random.default_rng(seed)
    full = lanes if length == 1 else min(full, lanes)
    blocks = [rng.integers(0, values, length - (k >= full)).astype(np.uint32) for k in range(lanes)]
    coded = id_coder.encode(blocks, 16)
    for got, want in zip(id_coder.decode(coded, [len(b) for b in blocks], 16), blocks, strict=True):
        assert np.array_equal(got, want)


def test_blocks_are_independent_and_predictions_pay():
    block = np.tile(np.arange(40_000, 40_050), 80).astype(np.uint32)
    other = np.random.default_rng(1).integers(0, 50_000, 4_000).astype(np.uint32)
    together, alone = id_coder.encode([block, other], 16), id_coder.encode([block], 16)
    assert together[0] == alone[0]
    assert len(alone[0]) < 600  # 50 ids once and then what follows them
    assert np.array_equal(id_coder.decode(alone, [4_000], 16)[0], block)


def test_wide_ids():
    block = np.array([0, (1 << 21) - 1, 5, 0, (1 << 21) - 1, 5] * 50, np.uint32)
    assert np.array_equal(id_coder.decode(id_coder.encode([block], 21), [300], 21)[0], block)


def test_pieces_give_the_tokenizers_ids(tokenizer):
    draw = random.Random(5)
    texts = ["".join(draw.choice(BITS) for _ in range(draw.randint(0, 14))) for _ in range(4_000)]
    memory = ByteIds(public_tokenizers.path(VOCABULARY), memory=500)  # forgets many times
    found = [ids for at in range(0, len(texts), 100) for ids in memory.encode(texts[at : at + 100])]
    for text, ids, want in zip(texts, found, tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert ids.tolist() == want.ids, text


def test_marks_take_no_place_in_the_memory(tokenizer):
    memory = ByteIds(public_tokenizers.path(VOCABULARY))
    texts = ["Erou, Erou. Erou!! 12, don't", "\nErou,\n\nПривет, é K ", None, "", "a  \n b", "x \n", "<|endoftext|> Erou,"]
    for text, ids in zip(texts, memory.encode(texts)):
        assert ids.tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids, text
    assert {"Erou", " Erou", ",", "!!", "Привет"} <= set(memory.units.unit)
    assert not hasattr(memory, "memory")  # units are remembered, pieces are not


def test_coded_bytes_stay():
    # Files written before are read, and order 0, whose shares are packed, codes ids up to the largest.
    rng = np.random.default_rng(9)
    blocks = [np.minimum(rng.geometric(0.01, n), 300).astype(np.uint32) * 7 for n in (700, 700, 699)]
    coded = id_coder.encode(blocks, 16)
    assert zlib.crc32(b"".join(coded)) == 2010026112  # of the coder as it was before
    wide = [b * ((1 << 21) // 2101) for b in blocks]
    for got, want in zip(id_coder.decode(id_coder.encode(wide, 21), [700, 700, 699], 21), wide, strict=True):
        assert np.array_equal(got, want)


def test_one_operation_serves_both_orders():
    model = id_coder._Model(3)
    model.predict()
    assert model.e.shape == (6,) and model.table.dtype == np.uint32


def test_query_against_brute_force(spark, small, tokenizer):
    rows = sorted(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect())
    got = sorted(tuple(r) for r in op11_token_ids(spark, small).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == brute_force(tokenizer, rows)


def test_awkward_documents(spark, tokenizer):
    long = " ".join(f"word{k}" for k in range(60_000))
    rows = [(7, "seven"), (2, None), (3, ""), (-4, long), (9, "<|endoftext|> plain !"), (5, "three   spaces \n\n\n end  "), (1, "!")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1)).withColumn("start", F.lit("x")).repartition(5)
    path = fresh_path(spark, "ids")
    token_files.write_documents(docs, path, VOCABULARY, groupids=50_000, filebytes=1_000)
    got = token_files.read_documents(spark, path, splitbytes=1).select("doc_id", "start", "n_tokens", F.crc32("ids"))
    assert sorted(map(tuple, got.collect())) == brute_force(tokenizer, sorted(rows, key=lambda r: r[0]))
    some = token_files.read_documents(spark, path).where("doc_id >= 2 AND doc_id < 6").select("doc_id", "start", "n_tokens", F.crc32("ids"))
    assert sorted(map(tuple, some.collect())) == [r for r in brute_force(tokenizer, sorted(rows, key=lambda r: r[0])) if 2 <= r[0] < 6]
    plain = token_files.read_documents(spark, path, ids="false")
    assert plain.where("ids IS NOT NULL").count() == 0 and plain.count() == len(rows)


def test_repeated_and_null_keys(spark, tokenizer):
    rows = [(4, "b"), (None, "none"), (4, "a a"), (4, "b"), (None, None)]
    path = fresh_path(spark, "ids")
    token_files.write_documents(spark.createDataFrame(rows, "doc_id long, text string"), path, VOCABULARY)
    got = sorted(map(tuple, token_files.read_documents(spark, path).select("start", "doc_id", "n_tokens").collect()))
    assert [r[1] for r in got] == [None, None, 4, 4, 4]
    assert [r[0] for r in got] == [sum(r[2] for r in got[:n]) for n in range(5)]
    assert sorted(r[2] for r in got) == [1, 2, 2, 2, 3]


def test_empty_table(spark):
    path = fresh_path(spark, "ids")
    token_files.write_documents(spark.createDataFrame([], "doc_id long, text string"), path, VOCABULARY)
    assert token_files.read_documents(spark, path).collect() == []


def test_damage_is_found():
    import io

    ids = [np.arange(300, dtype=np.uint32), np.arange(50, dtype=np.uint32)]
    data = token_files.pack_group([1, 2], ids, 16)
    *_, stream = token_files.unpack_group(io.BytesIO(data), 16)
    assert np.array_equal(stream, np.concatenate(ids))
    for at in (30, len(data) - 40):  # in the table, in a block
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises((ValueError, zlib.error)):
            token_files.unpack_group(io.BytesIO(bytes(broken)), 16)
