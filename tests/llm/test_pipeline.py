"""The pipeline's stages against brute force, each on what the stage before it kept."""

from __future__ import annotations

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_operators import AWKWARD, classes_by_brute_force, overlaps_by_brute_force, packed_rightly

import __spark_entry__ as entry_module
from wearline.llm import quality


@pytest.fixture(scope="module")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, folder, tmp_path_factory):
    """The documents before the first stage and after each."""
    path = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    # Columns with names that operators use, and a repeated row.
    docs = docs.withColumn("score", F.lit("own")).withColumn("kept", F.lit(7)).withColumn("n_removed", F.col("doc_id"))
    frames = [docs.unionByName(docs.where("doc_id = 3"))]
    for n, (_, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, frames[-1], folder).write.parquet(f"{path}/{n}")
        frames.append(spark.read.parquet(f"{path}/{n}"))
    return frames


def texts(frame):
    return {r["doc_id"]: r["text"] for r in frame.collect()}


def test_stages_keep_the_columns(kept):
    assert all(set(f.columns) == set(kept[0].columns) for f in kept[1:-1])
    assert all(f.where("score <> 'own' OR kept <> 7 OR n_removed <> doc_id").count() == 0 for f in kept[1:-1])


def test_rejected_documents_go(spark, folder, kept):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.train(kept[0], labels)
    rows = kept[0].collect()
    good = sorted(r["doc_id"] for r, s in zip(rows, quality.score_texts(model, [r["text"] for r in rows])) if s >= 0.7)
    assert good == sorted(r["doc_id"] for r in kept[1].collect()) and len(good) < len(rows)


def test_later_windows_are_cut(kept):
    first, want = {}, {}
    before = texts(kept[1])
    for i in sorted(before):
        lines = before[i].split("\n")
        gone = set()
        for k in range(len(lines) - 2):
            window = tuple(lines[k : k + 3])
            if "".join(window).strip(" ") and first.setdefault(window, (i, k)) != (i, k):
                gone |= {k, k + 1, k + 2}
        left = "\n".join(x for k, x in enumerate(lines) if k not in gone)
        if not gone or left.strip(" "):
            want[i] = left
    assert texts(kept[2]) == want
    assert kept[2].where("n_chars <> length(text)").count() == 0


def test_one_of_each_class_stays(kept):
    before = texts(kept[2])
    classes = classes_by_brute_force(before)
    assert sorted(r["doc_id"] for r in kept[3].collect()) == sorted(i for i, c in classes.items() if i == c)


def test_leaks_go(spark, folder, kept):
    benchmark = texts(spark.read.parquet(f"{folder}/benchmark.parquet").withColumnRenamed("item_id", "doc_id"))
    short = {i: t for i, t in texts(kept[3]).items() if len(t) < 4000}
    leaks = {d for d, _ in overlaps_by_brute_force(short, benchmark)}
    assert {i for i in texts(kept[4]) if i in short} == short.keys() - leaks


def test_the_rest_is_packed(kept):
    packed_rightly(kept[5].collect(), texts(kept[4]))


def test_run_gives_the_last_stage(spark, folder):
    rows = entry_module.queries()["pipeline"](spark, folder).collect()
    documents = {r["doc_id"] for r in rows}
    assert 0 < len(documents) < 200 and len(corpus_pipeline.STAGES) == 5


def test_awkward_documents_pass_all_stages(spark, folder):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1.0) for i, t in AWKWARD], "doc_id long, text string, lang string, source string, n_chars long, score double")
    for start in (docs, docs.where("doc_id > 99")):
        frame = start
        for _, step in corpus_pipeline.STAGES:
            frame = spark.createDataFrame(step(spark, frame, folder).collect(), step(spark, frame, folder).schema)
        assert frame.columns[0] == "doc_id"
