"""Texts without company are not dealt out, and a sieve loses no row."""

import random

import pytest
from pyspark.sql import functions as F

from tidewright.llm import near_dedup, repeats
from tidewright.llm.sieve import Sieve
from tidewright.llm.workspace import Workspace

DOCS, WORDS = 240, 3000


@pytest.fixture(scope="module")
def docs(spark):
    """Long texts of which only the first two are near copies."""
    draw = random.Random(5)
    made = [" ".join("".join(draw.choices("abcdefghijklmnop", k=6)) for _ in range(WORDS)) for _ in range(DOCS - 1)]
    rows = list(enumerate([made[0] + " end", *made]))
    return Workspace(spark, "t").save(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), "docs")


@pytest.fixture
def unbroadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def shuffled(spark):
    context = spark.sparkContext._jsc.sc()
    context.listenerBus().waitUntilEmpty(30_000)
    found = context.statusStore().executorList(False)
    return sum(found.apply(k).totalShuffleWrite() for k in range(found.size()))


def test_near_dedup_deals_out_few_texts(spark, docs, unbroadcast):
    before = shuffled(spark)
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs, Workspace(spark, "t")).collect()}
    assert found == {i: 0 if i == 1 else i for i in range(DOCS)}
    assert shuffled(spark) - before < DOCS * WORDS * 7 / 3


def test_repeats_deal_out_few_texts(spark, docs, unbroadcast):
    before = shuffled(spark)
    left = {r["doc_id"]: len(r["text"]) for r in repeats.without_repeats(docs, Workspace(spark, "t")).collect()}
    assert sorted(i for i, n in left.items() if n < 5000) == [0, 1]
    assert len(left) == DOCS
    assert shuffled(spark) - before < DOCS * WORDS * 7


def test_sieve(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 100 != 0, F.col("id")).alias("k"))
    sieve = Sieve(spark.range(0, 20_000, 7).select(F.col("id").alias("k")), ["k"], Workspace(spark, "t"), "bits")
    hits, misses = sieve.hits(rows), sieve.misses(rows)
    assert hits.count() + misses.count() == 20_000
    wanted = {k for k in range(0, 20_000, 7) if k % 100}
    assert wanted <= {r[0] for r in hits.collect()}
    assert misses.count() > 15_000
    empty = Sieve(spark.range(0).select(F.col("id").alias("k")), ["k"], Workspace(spark, "t"), "bits")
    assert empty.hits(rows).count() == 0 and empty.misses(rows).count() == 20_000
