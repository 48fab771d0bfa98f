"""Token counts by a two-tier lookup on the map side.

The driver broadcasts the lengths (in tokens) of frequent pre-tokens, at most ``FREQUENT`` of them, found in a
sample of at most ``SAMPLE_ROWS`` documents drawn from all files. A worker looks each pre-token up there, then in its own bounded cache, and has
the tokenizers library encode the rest in bulk. Nothing is shuffled. The sample only decides what is found fast; every
count is the library's. A text that holds the string of an added token is encoded whole, as the library cuts there first.

Null text counts as empty (0 bytes, 0 tokens); ids, nulls among them, pass through; repeated rows are counted each; very long texts are counted whole; an
empty table gives an empty result. Only the id and text columns are read, so extra columns may have any name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewright.llm.arrow_batches import BoundedCache, split_batch, without_collector
from tidewright.llm.chunks import chunks_of, encode_joined, plain_words

FREQUENT = 32_768
SAMPLE_ROWS = 1_000
SAMPLE_CHARS = 10_000
CACHE_ENTRIES = 1_000_000
_COUNTERS: dict[tuple[str, int], ChunkCounter] = {}


class ChunkCounter:
    """Counts the tokens of texts with the lengths of pieces seen before: pre-tokens of plain texts, chunks of others."""

    def __init__(self, vocabulary: str, frequent: dict[str, int]):
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = BoundedCache(self.word_lengths, CACHE_ENTRIES, frequent)
        self.chunks = BoundedCache(self.chunk_lengths, CACHE_ENTRIES)

    def encode(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def word_lengths(self, words: list[str]) -> list[int]:
        """Between newlines, letters are one pre-token; what else there is takes few distinct forms."""
        visible = [w for w in words if w[-1].isalpha()]
        known = dict(zip(visible, map(len, encode_joined(self.tokenizer, visible, "\n", 2)), strict=True))
        other = [w for w in words if w not in known]
        known.update(zip(other, self.encode(other), strict=True))
        return [known[w] for w in words]

    def chunk_lengths(self, chunks: list[str]) -> list[int]:
        """A chunk is a run of whole pre-tokens. Those of plain chunks are looked up like others."""
        plain = [plain_words(c) for c in chunks]
        self.words.learn(set(chain.from_iterable(w for w in plain if w)))
        other = iter(self.encode([c for c, w in zip(chunks, plain, strict=True) if w is None]))
        return [next(other) if w is None else sum(map(self.words.__getitem__, w)) for w in plain]

    def count(self, texts: list[str]) -> list[int]:
        special = [any(a in t for a in self.added) for t in texts]
        plain = [None if s else plain_words(t) for s, t in zip(special, texts, strict=True)]
        chunks = [chunks_of(t) if w is None and not s else () for w, s, t in zip(plain, special, texts, strict=True)]
        self.chunks.learn(set(chain.from_iterable(chunks)))
        self.words.learn(set(chain.from_iterable(w for w in plain if w)))
        words, runs = self.words.__getitem__, self.chunks.__getitem__
        return [self.encode([t])[0] if s else sum(map(runs, c)) if w is None else sum(map(words, w)) for t, s, w, c in zip(texts, special, plain, chunks, strict=True)]


def counter(vocabulary: str, frequent: Broadcast) -> ChunkCounter:
    """This worker's counter; tasks that follow find its cache filled."""
    key = (vocabulary, frequent.value[0])
    if key not in _COUNTERS:
        _COUNTERS.clear()
        without_collector()
        _COUNTERS[key] = ChunkCounter(vocabulary, frequent.value[1])
    return _COUNTERS[key]


def frequent_lengths(docs: DataFrame, text: str, vocabulary: str) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens in a bounded sample: rows drawn from all of them, and of texts that are not plain
    throughout the plain runs."""
    seen: Counter = Counter()
    few = docs.select(text).sample(min(1.0, SAMPLE_ROWS / max(1, docs.count())), seed=4).where(F.col(text).isNotNull()).limit(SAMPLE_ROWS)
    for row in few.select(F.substring(text, 1, SAMPLE_CHARS).alias("t")).collect():
        words = plain_words(row.t)
        seen.update(chain.from_iterable(plain_words(c) or () for c in chunks_of(row.t)) if words is None else words)
    words = [w for w, n in seen.most_common(FREQUENT) if n > 1]
    return dict(zip(words, ChunkCounter(vocabulary, {}).word_lengths(words), strict=True)) if words else {}


def count_tokens(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text: str = "text", limit: int = 512) -> DataFrame:
    """``id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row."""
    frequent = frequent_lengths(docs, text, vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast((hash(frozenset(frequent)), frequent))
    id_type = docs.schema[id_column].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(vocabulary, shared)
        for whole in batches:
            for batch in split_batch(whole, 8 << 20):
                n = own.count(batch.column(2).to_pylist())
                over = pa.array([x > limit for x in n], pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), over], [id_column, "n_bytes", "n_tokens", "over_limit"])

    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id_column), F.octet_length(whole).cast("long").alias("n_bytes"), whole.alias("t"))
    return rows.mapInArrow(count, f"{id_column} {id_type}, n_bytes long, n_tokens long, over_limit boolean")
