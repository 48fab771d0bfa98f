"""The pipeline's stages on rows that its tables do not have."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tidewright.llm import repeats

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], SCHEMA).repartition(3)


def kept(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def prose(draw, n):
    return " ".join("".join(draw.choices("abcdefghij", k=6)) for _ in range(n))


def test_one_row_of_each_group_stays(spark, small):
    """Repeated rows, null ids, and rows that share an id with a copy of something else."""
    draw = random.Random(5)
    twice, unnamed, mixed, clean, near = (prose(draw, 120) for _ in range(5))
    rows = [(1, twice), (1, twice), (None, unnamed), (None, unnamed), (None, mixed), (3, mixed), (9, mixed), (9, clean), (7, near), (5, near + " tail")]
    left = corpus_pipeline.near_duplicates(spark, table(spark, rows), small)
    want = [(1, twice), (None, unnamed), (3, mixed), (9, clean), (5, near + " tail")]
    assert kept(left) == sorted(want, key=str)
    after = corpus_pipeline.repeated_passages(spark, left, small)
    assert kept(after) == kept(left) and after.where(F.col("n_chars") != F.length("text")).count() == 0


def test_passages_of_few_bytes(spark, small):
    """Shared passages of 50 to 63 short words, under 400 bytes, against a table of all windows of 51 words."""
    draw = random.Random(9)
    words = lambda n: ["".join(draw.choices("abcdefghij", k=draw.randint(3, 5))) for _ in range(n)]
    passages = [words(n) for n in (50, 51, 52, 57, 63)]
    rows = {}
    for k, own in enumerate([*passages, passages[0], *passages[1:], passages[2]]):
        assert len(" ".join(own)) < 400
        rows[k] = [*words(draw.randint(0, 70)), *own, *words(draw.randint(0, 70))]
    rows[20], twice = words(300), words(55)
    rows[21] = [*twice, *words(20), *twice]
    seen = Counter(tuple(own[i : i + 51]) for own in rows.values() for i in range(len(own) - 50))
    want = {}
    for d, own in rows.items():
        gone = {i + k for i in range(len(own) - 50) if seen[tuple(own[i : i + 51])] > 1 for k in range(51)}
        want[d] = [w for i, w in enumerate(own) if i not in gone]
    lay = lambda d, own: ("\n" if d % 2 else " ").join(own)
    out = corpus_pipeline.repeated_passages(spark, table(spark, [(d, lay(d, own)) for d, own in rows.items()]), small)
    assert {r.doc_id: r.text.split() for r in out.collect()} == want
    assert sum(len(rows[d]) - len(want[d]) for d in rows) == 2 * (51 + 52 + 57 + 63 + 55) + 52
    assert out.where(F.col("n_chars") != F.length("text")).count() == 0


def test_symbols_are_equal_where_words_are():
    text = b"  one two\tone\n\x0cthree one " * 3
    starts, ends = repeats.word_places(np.frombuffer(text, np.uint8))
    found = [text[a:b] for a, b in zip(starts, ends, strict=True)]
    assert found == text.split()
    texts = [b"", text, b" \n", b"one two", b""]
    codes, ends = repeats.symbols(texts, True)
    assert ends.tolist() == [0, 15, 15, 17, 17] and codes[15:].tolist() == codes[:2].tolist()
    codes = codes[:15].tolist()
    assert len(codes) == len(found) and len(set(zip(codes, found, strict=True))) == len(set(codes)) == len(set(found))
    assert [len(x) for x in repeats.symbols([], True)] == [0, 0] == [len(x) for x in repeats.symbols([], False)]
