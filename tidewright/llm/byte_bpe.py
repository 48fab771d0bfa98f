"""Byte-level BPE from a rank file: encoding with offsets, and decoding.

A rank file is turned into a model of the tokenizers library: every byte becomes a printable character, and a rank gives
the priority of all pairs that make up its token. Each match of the pattern is encoded separately; matches seen before come
from a worker's bounded cache. Decoding maps each token's characters back to bytes; a token may hold a part of a
character, so bytes are joined over the whole text before they are read as UTF-8.

Null text counts as empty: no ids, no bytes. Repeated rows are coded each, very long texts whole; an empty table gives an empty result. Only the id and
text columns are read, so extra columns may have any name. Ids that are not in the vocabulary raise an error on decoding.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import accumulate, chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.models import BPE
from tokenizers.pre_tokenizers import Split

from tidewright.llm.arrow_batches import BoundedCache, split_batch, without_collector
from tidewright.llm.chunks import encode_joined, plain_words

CACHE_ENTRIES = 700_000
#: Fixed value: the usual pattern of byte-level BPE, for which plain texts are cut by a faster one.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_CODERS: dict[tuple[str, str], ByteBpe] = {}


def byte_characters() -> list[str]:
    """For each byte a printable character: itself where it is one, else the next free one from 256 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b if b in plain else next(free)) for b in range(256)]


class ByteBpe:
    def __init__(self, rank_file: str, pattern: str):
        with open(rank_file, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.characters = byte_characters()
        self.table = dict(enumerate(self.characters))
        self.byte_of = {c: b for b, c in enumerate(self.characters)}
        pairs = sorted((rank, ranks[t[:k]], ranks[t[k:]], t, k) for t, rank in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks)
        merges = [(self.printed(t[:k]), self.printed(t[k:])) for *_, t, k in pairs]
        self.model = Tokenizer(BPE({self.printed(t): rank for t, rank in ranks.items()}, merges, ignore_merges=True))
        self.model.pre_tokenizer = Split("\n", "removed")  # between matches; a printed byte is never a newline
        names = {rank: self.printed(t) for t, rank in ranks.items()}
        self.token_bytes = {i: bytes(map(self.byte_of.__getitem__, name)) for i, name in names.items()}
        self.pattern, self.matches_of = pattern, regex.compile(pattern).findall
        self.words = BoundedCache(self.encode_words, CACHE_ENTRIES)

    def printed(self, data: bytes) -> str:
        return data.decode("latin-1").translate(self.table)

    def encode_words(self, words: list[str]) -> list[tuple[tuple[int, ...], str]]:
        found = encode_joined(self.model, [self.printed(w.encode()) for w in words], "\n", 1)
        return [(tuple(x), ",".join(map(str, x))) for x in found]

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], str]]:
        """For each text the ids, and the same in decimal, joined by commas."""
        split = [plain_words(t) if self.pattern == PATTERN else None for t in texts]
        split = [self.matches_of(t) if w is None else w for w, t in zip(split, texts, strict=True)]
        self.words.learn(set(chain.from_iterable(split)))
        for words in split:
            found = [self.words[w] for w in words]
            yield list(chain.from_iterable([x[0] for x in found])), ",".join([x[1] for x in found])

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))


def coder(rank_file: str, pattern: str) -> ByteBpe:
    if (rank_file, pattern) not in _CODERS:
        without_collector()
        _CODERS[rank_file, pattern] = ByteBpe(rank_file, pattern)
    return _CODERS[rank_file, pattern]


def _map_texts(docs: DataFrame, id_column: str, value, kind: str, make, columns: list[tuple[str, str, pa.DataType]]) -> DataFrame:
    id_type = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in split_batch(whole, 8 << 20):
                made = list(zip(*make(batch.column(1).to_pylist()), strict=True)) or [[] for _ in columns]
                arrays = [pa.array(v, t) for v, (_, _, t) in zip(made, columns, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], [id_column, *[c[0] for c in columns]])

    schema = ", ".join([f"{id_column} {id_type}", *[f"{c} {t}" for c, t, _ in columns]])
    return docs.select(F.col(id_column), value.cast(kind).alias("v")).mapInArrow(run, schema)


def encode(docs: DataFrame, rank_file: str, pattern: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``ids``, and for each the ``offsets`` in bytes at which it starts."""

    def make(texts: list[str]):
        own = coder(rank_file, pattern)
        for ids, _ in own.encode(texts):
            yield ids, list(accumulate((len(own.token_bytes[i]) for i in ids[:-1]), initial=0))[: len(ids)]

    return _map_texts(docs, id_column, F.coalesce(F.col(text), F.lit("")), "string", make, [("ids", "array<int>", pa.list_(pa.int32())), ("offsets", "array<int>", pa.list_(pa.int32()))])


def decode(encoded: DataFrame, rank_file: str, pattern: str, id_column: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``bytes`` of the ids, and ``text`` with U+FFFD for what is not whole UTF-8."""

    def make(rows: list[list[int]]):
        for data in map(coder(rank_file, pattern).decode, rows):
            yield data, data.decode(errors="replace")

    return _map_texts(encoded, id_column, F.coalesce(F.col(ids), F.array().cast("array<int>")), "array<int>", make, [("bytes", "binary", pa.binary()), ("text", "string", pa.string())])


def round_trip_digests(docs: DataFrame, rank_file: str, pattern: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``n_tokens`` and digests of the ids and of the bytes decoded from them, without sending ids back to Spark."""

    def make(texts: list[str]):
        own = coder(rank_file, pattern)
        for ids, decimal in own.encode(texts):
            yield len(ids), hashlib.sha256(decimal.encode()).hexdigest(), hashlib.sha256(own.decode(ids)).hexdigest()

    return _map_texts(docs, id_column, F.coalesce(F.col(text), F.lit("")), "string", make, [("n_tokens", "long", pa.int64()), ("ids_sha256", "string", pa.string()), ("decoded_sha256", "string", pa.string())])
