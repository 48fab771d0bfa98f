"""Vector codes, copied passages and ranked search: whole small tables and edges against plain loops."""

import math
import random

import brute
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidewright.llm import lexical_search, queries, relative_lz, vector_codes
from tidewright.llm.workspace import Workspace



def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def pages(small, name, *columns):
    t = pq.read_table(f"{small}/{name}.parquet")
    return list(zip(*[t[c].to_pylist() for c in columns], strict=True))


# Vector codes


def test_op11(spark, small):
    want, books = brute.vector_codes(pages(small, "embeddings", "vec_id", "embedding", "label"))
    got = queries.op11_vector_codes(spark, small).collect()
    assert order((r.vec_id, r.code, r.error, r.label_error) for r in got) == order(want)
    assert {r.codebooks_sha256 for r in got} == {brute.sha(",".join(str(x) for b in books for e in b for x in e).encode())}


@pytest.mark.parametrize("n,d,reach,bits", [(256, 16, 300, 4), (256, 3, 2, 4), (5, 8, 1000, 2), (1, 4, 9, 4), (40, 1, 10, 1), (256, 16, 1 << 25, 4)])
def test_filtering_finds_the_nearest(n, d, reach, bits):
    rng = np.random.default_rng(n + d)
    entries, points = rng.integers(-reach, reach, (n, d)), rng.integers(-2 * reach, 2 * reach, (1500, d))
    points[::7] = entries[rng.integers(0, n, len(points[::7]))]
    index, least = vector_codes.Approximation(entries, bits).nearest(points)
    apart = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (index == apart.argmin(axis=1)).all() and (least == apart.min(axis=1)).all()


def test_filtering_rules_entries_out():
    rng = np.random.default_rng(1)
    near = vector_codes.Approximation(rng.integers(-300, 300, (256, 4)))
    looked = []
    real, np.einsum = np.einsum, lambda *a: looked.append(len(a[1])) or real(*a)
    try:
        near.nearest(rng.integers(-300, 300, (1000, 4)))
    finally:
        np.einsum = real
    assert sum(looked) < 1000 * 256 / 8


VECTORS = [
    (3, [0.5, -0.5, 0.25, 1.0], "a"), (1, [0.1, 0.2, 0.3, 0.4], None), (1, [0.1, 0.2, 0.3, 0.4], None), (None, [9.0, 9.0, 9.0, 9.0], "b"),
    (2, None, "a"), (4, [1.0, None, 2.0, 3.0], "a"), (5, [math.nan, 1.0, 1.0, 1.0], "a"), (6, [math.inf, 1.0, 1.0, 1.0], None), (7, [], "b"), (8, [1.0, 2.0, 3.0, 4.0, 5.0], "c"),
]


def coded(spark, rows, entries=256, **more):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").withColumns({c: F.lit("x") for c in ("id", "codes", "vector", "error", "slot")})
    return vector_codes.compress(frame, Workspace(spark, "test"), entries=entries, **more)


@pytest.mark.parametrize("entries", [256, 2])
def test_vector_edges(spark, entries):
    got, books = coded(spark, VECTORS, entries)
    want, told = brute.vector_codes(VECTORS, entries=entries)
    assert order((r.id, "".join(f"{c:02x}" for c in r.codes), r.error) for r in got.collect()) == order(w[:3] for w in want)
    assert books.entries.tolist() == told


def test_no_vectors_and_too_large_ones(spark):
    assert coded(spark, [])[0].count() == 0 and coded(spark, [(1, None, "a")])[0].count() == 0
    assert [r.codes for r in coded(spark, [(1, [], "a")])[0].collect()] == [[0, 0, 0, 0]]
    with pytest.raises(Exception, match="would not fit"):
        coded(spark, [(1, [1e9] * 4, "a"), (2, [0.0] * 4, "a")])


def test_codes_can_be_restored(spark):
    frame, books = coded(spark, [(k, [k / 8, 0.5, -k / 4, 1.0], "a") for k in range(20)])
    back = {r.id: r.vector for r in vector_codes.restored(frame, books).collect()}
    assert back == {k: [k / 8, 0.5, -k / 4, 1.0] for k in range(20)}


# Copied passages


def removed(spark, docs, length):
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("doc", "row", "key", "h1", "n", "left")})
    return order(tuple(r) for r in relative_lz.find_copied(frame, Workspace(spark, "test"), length=length).select("doc", "n_words", "n_removed", "kept_sha256").collect())


def test_op12(spark, small):
    docs = pages(small, "documents", "doc_id", "text")
    got = order(tuple(r) for r in queries.op12_relative_lz(spark, small).select("doc_id", "n_words", "n_removed", "kept_sha256").collect())
    assert got == order(brute.copied(docs))


def passage(rng, n, letters="abcdefghijklmnopqrstuvwxyz"):
    return " ".join("".join(rng.choice(letters) for _ in range(3)) for _ in range(n))


def test_copied_edges(spark):
    rng = random.Random(3)
    one, two = passage(rng, 60), passage(rng, 9)
    docs = [
        (5, one), (2, f"{two} {one.replace(' ', chr(9) + chr(10))}  é"), (7, f"x {one[:150]} y {one}"), (7, one), (None, one), (None, None),
        (1, None), (3, ""), (4, " \n "), (9, two), (9, two), (10, "a b c"), (11, f"{one} {one}"), (12, "a"), (6, f"{two} {two}"),
    ]
    for length in (10, 50, 2, 1):
        assert removed(spark, docs, length) == order(brute.copied(docs, length))


@pytest.mark.parametrize("length,letters", [(8, "ab"), (20, "abcdefgh"), (4, "a")])
def test_many_variants_of_passages(spark, length, letters):
    """Passages that many documents share with changed words, so that factors of several rounds and their boundaries matter."""
    rng = random.Random(length)
    common = [passage(rng, 40, letters).split() for _ in range(3)]
    docs = []
    for d in range(150):
        words = []
        for _ in range(rng.randrange(4)):
            own = list(rng.choice(common)[rng.randrange(20) :])
            for _ in range(rng.randrange(3)):
                own[rng.randrange(len(own))] = rng.choice("xyz")
            words += own + passage(rng, rng.randrange(6), letters).split()
        docs.append((rng.randrange(120), " ".join(words)))
    assert removed(spark, docs, length) == order(brute.copied(docs, length))


def test_very_long_text(spark):
    rng = random.Random(5)
    long = passage(rng, 700_000)
    inside = " ".join(long.split()[520_000:524_400])
    got = {r[0]: r[2] for r in removed(spark, [(1, long), (2, f"new {inside} end"), (3, long)], 50)}
    assert got == {1: 0, 2: 4400, 3: 700_000}


def test_no_documents_and_what_is_left(spark):
    assert removed(spark, [], 50) == []
    frame = spark.createDataFrame([(1, "a b c d", "k"), (2, "x a  b c y", "k"), (3, "q  r", "k"), (4, None, "k")], "doc_id long, text string, __left string")
    left = relative_lz.without_copied(frame, Workspace(spark, "test"), length=3)
    assert left.columns == frame.columns and order(tuple(r) for r in left.collect()) == order([(1, "a b c d", "k"), (2, "x y", "k"), (3, "q  r", "k"), (4, None, "k")])


# Ranked search


def found(spark, docs, items, top=10):
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("doc", "n", "leaf", "shard", "terms")})
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit(1))
    work = Workspace(spark, "test")
    return order(tuple(r) for r in lexical_search.search(lexical_search.build_index(frame, work), asked, work, top=top).collect())


def test_op13(spark, small):
    got = order(tuple(r) for r in queries.op13_lexical_search(spark, small).select("item_id", "rank", "doc_id", "score").collect())
    assert got == order(brute.ranked(pages(small, "documents", "doc_id", "text"), pages(small, "benchmark", "item_id", "text")))


def test_search_edges(spark):
    docs = [(3, "Fish-and chips É"), (1, "fish AND chips é"), (None, "fish"), (2, None), (4, ""), (5, "--- !!"), (6, "fish " * 5000 + "42"), (6, "42"), (6, "42"), (7, "x" * 5000)]
    items = [(1, "FISH"), (2, None), (2, "42 42 fish"), (2, "42 42 fish"), (None, "é"), (3, "nothing"), (4, "x" * 5000), (5, "É")]
    got = found(spark, docs, items)
    assert got == order(brute.ranked(docs, items))
    assert found(spark, [], items) == [] and found(spark, docs, []) == [] and found(spark, [(1, None)], items) == []


def test_exact_stopping_over_many_shards(spark, monkeypatch):
    """Small shards, few of which are visited at a time, and groups of copies larger than the result."""
    monkeypatch.setattr(lexical_search, "SHARD", 4)
    monkeypatch.setattr(lexical_search, "VISITS", 1)
    monkeypatch.setattr(lexical_search, "WIDER", 2)
    monkeypatch.setattr(lexical_search, "CELLS", 60)
    rng = random.Random(7)
    words = [passage(rng, 1) for _ in range(40)]
    docs = [(d, " ".join(rng.choices(words[d % 3 * 10 : d % 3 * 10 + 20], k=rng.randrange(1, 30)))) for d in rng.sample(range(1000), 200)] + [(1000 - d, "same old text") for d in range(60)]
    items = [(k, " ".join(rng.choices(words, k=4))) for k in range(9)] + [(20, "old same")]
    visited = []
    real = lexical_search._scored
    monkeypatch.setattr(lexical_search, "_scored", lambda visits, *a: visited.append(visits.select(F.sum(F.size("items"))).first()[0]) or real(visits, *a))
    assert found(spark, docs, items) == order(brute.ranked(docs, items))
    assert 0 < sum(v or 0 for v in visited) < 0.8 * len(items) * len(docs) / 4


def test_bisection_puts_like_documents_together():
    rng = random.Random(1)
    documents = [[100 * (d % 4) + rng.randrange(60) for _ in range(20)] for d in range(200)]
    tree = lexical_search.fit_bisection(documents, levels=2)
    row = np.repeat(np.arange(200), 20)
    leaf, _ = tree.place(row, np.array(documents).ravel(), 200)
    most = [max(np.bincount(leaf[k::4])) for k in range(4)]
    assert min(most) >= 40
