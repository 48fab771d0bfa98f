"""Each operator's query over a whole small table against plain loops."""

import math
import re
from collections import defaultdict

import brute
import pyarrow.parquet as pq
import pytest

from tidewright.llm import licenses, packing, queries


@pytest.fixture(scope="module")
def documents(small):
    t = pq.read_table(f"{small}/documents.parquet")
    return list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist(), strict=True))


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_op1(spark, small):
    t = pq.read_table(f"{small}/conversations.parquet").to_pydict()
    own = "</s>[INST] ok [/INST]"
    want = brute.chat([*zip(t["conv_id"], t["turn"], t["role"], t["text"], strict=True), (-7, 0, "user", own), (-7, 1, "assistant", own)])
    got = rows(queries.op1_chat_format(spark, small), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    assert got == sorted((k, *v) for k, v in want.items())


def test_op2(spark, small, documents):
    df = queries.op2_media(spark, small)
    assert rows(df, "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32") == sorted((d, *brute.payload(t)) for d, t in documents)
    by_text = defaultdict(set)
    texts = dict(documents)
    for r in df.collect():
        by_text[texts[r.doc_id]].add((r.media_bytes, r.media_sha256, r.feature))
        assert (r.width, r.height) == (576, r.payload_bytes // 576)
    assert all(len(x) == 1 for x in by_text.values())


def test_op3(spark, small, documents):
    df = queries.op3_packing(spark, small)
    assert rows(df, "doc_id", "piece", "start", "length", "ids_crc32") == sorted(brute.pieces(documents))
    by = defaultdict(list)
    for r in df.collect():
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    least = sum(n for x in by.values() for _, n in x) / 2048
    assert len(by) <= math.ceil(least * 1.03) + 1


def test_op4(spark, small, documents):
    assert rows(queries.op4_token_counts(spark, small), "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(brute.token_counts(documents))


def test_op5(spark, small):
    langs = pq.read_table(f"{small}/documents.parquet", columns=["doc_id", "lang"]).to_pydict()
    lang = dict(zip(langs["doc_id"], langs["lang"], strict=True))
    got = queries.op5_language_id(spark, small).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(lang) and 0 < len(held) < len(got)
    assert all(r.held_out == (brute.zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def test_op6(spark, small, documents):
    assert rows(queries.op6_byte_bpe(spark, small), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(brute.byte_bpe(documents))


def test_op7(spark, small, documents):
    got = rows(queries.op7_quality(spark, small), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == sorted((d, *brute.quality(t)) for d, t in documents)


def test_op8(spark, small, documents):
    tests = licenses.templates()

    def best(unit):
        own = set(brute.component_words(re.findall(r"[^\W_]+", unit.lower())))
        found = [(round(2 * len(own & set(t.bigrams)) / (len(own) + len(t.bigrams)), 6), -t.place, t.name) for t in tests]
        return max(x for x in found) if max(found)[0] >= licenses.LEAST_DICE else None

    want = []
    for d, t in documents:
        lines = [b for b in map(best, t.split("\n")) if b]
        whole = best(t)
        want.append((d, whole and whole[2], len(lines), max(lines)[2] if lines else None, max(lines)[0] if lines else None))
    got = [tuple(r) for r in queries.op8_licenses(spark, small).select("doc_id", "whole_license", "n_license_lines", "license", "dice").collect()]
    assert sorted(got, key=lambda r: r[0]) == sorted(want, key=lambda r: r[0])
    assert any(r[2] for r in got)


def test_op9(spark, small, documents):
    want = brute.near(documents)
    assert rows(queries.op9_near_dedup(spark, small), "doc_id", "n_shingles", "component_id", "kept") == sorted((d, *v, d == v[1]) for d, v in want.items())


def test_op10(spark, small, documents):
    want = brute.repeats([t for _, t in documents])
    assert rows(queries.op10_repeats(spark, small), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted((d, *w) for (d, _), w in zip(documents, want, strict=True))


def test_best_fit_places_everything_once():
    lengths = [2048, 1, 1000, 1048, 700, 700, 648, 5]
    bins = packing.best_fit(lengths, 2048)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= 2048 for b in bins) and len(bins) == 4
