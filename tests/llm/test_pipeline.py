"""The pipeline's stages in order, each against plain loops on its own input."""

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewright.llm import quality


@pytest.fixture(scope="module")
def stages(spark, small, tmp_path_factory):
    docs, made = spark.read.parquet(f"{small}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"file://{tmp_path_factory.mktemp('stages')}/{k}"
        stage(spark, docs, small).write.parquet(path)
        out = spark.read.parquet(path)
        made.append((name, docs, out))
        docs = out
    return made


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_all_but_the_last_return_documents(stages, spark, small):
    want = spark.read.parquet(f"{small}/documents.parquet").schema
    for _, _, out in stages[:-1]:
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in want]
        assert out.where(F.col("n_chars") != F.length("text")).count() == 0


def test_quality_rules(stages):
    _, docs, out = stages[0]
    before, after = texts(docs), texts(out)
    kept = {r.doc_id for r in quality.judge(docs).select("doc_id", "kept").collect() if r.kept}
    assert set(after) == kept and len(kept) > 0.6 * len(before)
    assert all(not brute.quality(before[d])[5] for d in kept)
    for d, t in after.items():
        lines = iter(before[d].split("\n"))
        assert all(any(line == x for x in lines) for line in t.split("\n"))


def test_language(stages):
    _, docs, out = stages[1]
    before, after = texts(docs), texts(out)
    assert len(after) >= 0.98 * len(before) and all(before[d] == t for d, t in after.items())


def test_near_duplicates(stages):
    _, docs, out = stages[2]
    want = brute.near(texts(docs).items())
    assert set(texts(out)) == {d for d, (_, c) in want.items() if c == d}


def test_repeats(stages):
    """Both thresholds of the stage: strings of 400 bytes, and passages of 51 words."""
    _, docs, out = stages[3]
    before, after = texts(docs), texts(out)
    assert set(before) == set(after)
    order = sorted(before)
    gone = brute.removed_bytes([before[d] for d in order], corpus_pipeline.PASSAGE_WORDS)
    for d, lost in zip(order, gone, strict=True):
        if not lost:
            assert after[d] == before[d]
        elif before[d].isascii():
            assert after[d] == "".join(c for k, c in enumerate(before[d]) if k not in lost)
    assert any(gone)


def test_packing(stages):
    _, docs, out = stages[4]
    got = sorted(tuple(r) for r in out.select("doc_id", "piece", "start", "length", "ids_crc32").collect())
    assert got == sorted(brute.pieces(texts(docs).items()))
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
