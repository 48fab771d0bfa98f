"""Best-fit packing of token sequences by hierarchical residual packing.

``token_pieces`` turns documents into pieces of at most ``size`` tokens. ``pack`` fits them locally, block by block,
largest first, each into the fullest bin it fits in. Bins that are full but for ``SLACK`` tokens are done. The underfull
ones are items of the next round, dealt out anew to fewer blocks, until one block holds them all or a round merges
none. After best fit at most one bin of a block is half empty, so few bins are left to merge and rounds are few. A block holds at most ``BLOCK`` items and a bin at most ``size`` members, so no task grows with the input.

Null text counts as empty: one piece with the end id alone. Equal rows are packed as often as they occur. Ids pass through. Pieces that
tie in length are taken in any order. Very long texts make many pieces. An empty table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from tokenizers import Tokenizer

from tidewright.llm.arrow_batches import BoundedCache, split_batch, without_collector
from tidewright.llm.chunks import CONTRACTIONS, LETTERS, MARKS, encode_joined
from tidewright.llm.workspace import Workspace

SIZE = 2048
SLACK = 20
BLOCK = 65_536
CACHE_ENTRIES = 1_000_000
_ENCODERS: dict[str, WordEncoder] = {}


class WordEncoder:
    """Ids of texts as little-endian bytes, from those of pieces seen before: pre-tokens of plain texts, and what stands between
    white space in others, over which no token of this kind of vocabulary reaches."""

    def __init__(self, vocabulary: str):
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.plain = re.compile(f"{CONTRACTIONS}|[{LETTERS}]+|[0-9]|[{MARKS}]+").findall
        self.runs_of = re.compile("[^ \t\n\r]+").findall
        self.words = BoundedCache(self.encode_words, CACHE_ENTRIES)
        self.runs = BoundedCache(self.encode_all, CACHE_ENTRIES)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint32).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_words(self, words: list[str]) -> list[bytes]:
        return [array("I", ids).tobytes() for ids in encode_joined(self.tokenizer, words, " ", 1)]

    def plain_words(self, text: str) -> list[str] | None:
        if "<|" in text and any(a in text for a in self.added):
            return None
        words = self.plain(text.lower())
        return words if sum(map(len, words)) + sum(map(text.count, " \t\n\r")) == len(text) else None

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = list(map(self.plain_words, texts))
        runs = [self.runs_of(t) if w is None else () for w, t in zip(plain, texts, strict=True)]
        self.words.learn(set(chain.from_iterable(w for w in plain if w)))
        self.runs.learn(set(chain.from_iterable(runs)))
        return [b"".join(map(self.runs.__getitem__, r) if w is None else map(self.words.__getitem__, w)) for w, r in zip(plain, runs, strict=True)]


def encoder(vocabulary: str) -> WordEncoder:
    if vocabulary not in _ENCODERS:
        without_collector()
        _ENCODERS[vocabulary] = WordEncoder(vocabulary)
    return _ENCODERS[vocabulary]


def token_pieces(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text: str = "text", size: int = SIZE, with_ids: bool = False) -> DataFrame:
    """Each document's ids and a closing 0, cut where longer than ``size``: ``piece``, ``start``, ``length``, ``ids_crc32``,
    and with ``with_ids`` the ``ids`` themselves."""
    id_type = docs.schema[id_column].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, step = encoder(vocabulary), 4 * size
        for whole in batches:
            for batch in split_batch(whole, 8 << 20):
                rows, pieces, starts, lengths, sums, ids = [], [], [], [], [], []
                for row, encoded in enumerate(own.encode(batch.column(1).to_pylist())):
                    data = encoded + bytes(4)
                    for k, at in enumerate(range(0, len(data), step)):
                        part = data[at : at + step]
                        rows.append(row)
                        pieces.append(k)
                        starts.append(at // 4)
                        lengths.append(len(part) // 4)
                        sums.append(zlib.crc32(part))
                        if with_ids:
                            ids.append(memoryview(part).cast("I").tolist())
                made = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())]
                names = [id_column, "piece", "start", "length", "ids_crc32"]
                yield pa.RecordBatch.from_arrays(made + [pa.array(ids, pa.list_(pa.int64()))] * with_ids, names + ["ids"] * with_ids)

    schema = f"{id_column} {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    return docs.select(F.col(id_column), F.coalesce(F.col(text), F.lit("")).alias("t")).mapInArrow(cut, schema)


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Positions of the items of each bin, largest first into the fullest bin that has room."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r: a bin has r tokens left
    for i in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        n = lengths[i]
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            k = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[k].append(i)
        else:
            room, k = size, len(bins)
            bins.append([i])
        if left := room - n:
            by_room.setdefault(left, []).append(k)
            rooms |= 1 << left
    return bins


def _fit_blocks(items: DataFrame, size: int) -> DataFrame:
    """items: ``fill``, and the ``members`` that make it up. Returns bins of the same form, with ``done``."""
    members_type = items.schema["members"].dataType.simpleString()

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def packed() -> Iterator[pa.RecordBatch]:
            block = pa.Table.from_batches(held).combine_chunks()
            fills, members = block.column("fill").to_pylist(), block.column("members").combine_chunks()
            bins = best_fit(fills, size)
            order = members.take(pa.array([i for b in bins for i in b], pa.int64()))
            sizes, ends = order.value_lengths().to_pylist(), [0]
            at = 0
            for b in bins:
                ends.append(ends[-1] + sum(sizes[at : at + len(b)]))
                at += len(b)
            filled = [sum(fills[i] for i in b) for b in bins]
            joined = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), order.flatten())
            out = pa.RecordBatch.from_arrays([pa.array(filled, pa.int64()), joined, pa.array([f >= size - SLACK for f in filled], pa.bool_())], ["fill", "members", "done"])
            for k in range(0, out.num_rows, 4096):
                yield out.slice(k, 4096)

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= BLOCK:
                yield from packed()
                held.clear()
        if held:
            yield from packed()

    return items.select("fill", "members").mapInArrow(fit, f"fill long, members {members_type}, done boolean")


def pack(pieces: DataFrame, work: Workspace, size: int = SIZE, length: str = "length") -> DataFrame:
    """pieces, with ``sequence_id`` and ``offset``. Their columns travel with them, so keep them few and narrow."""
    columns = pieces.columns
    taken = {c.lower() for c in columns} & {"sequence_id", "offset"}
    if taken:
        raise ValueError(f"columns {sorted(taken)} would clash with the result's")
    items = pieces.select(F.col(length).cast("long").alias("fill"), F.array(F.struct(*[F.col(c) for c in columns])).alias("members"))
    rounds = [work.save(_fit_blocks(items, size), "bins-0")]
    waiting = rounds[0].where(~F.col("done")).count()
    while waiting > 1:
        blocks = max(1, math.ceil(waiting / BLOCK))
        merged = work.save(_fit_blocks(rounds[-1].where(~F.col("done")).repartition(blocks), size), f"bins-{len(rounds)}")
        before, waiting = waiting, merged.where(~F.col("done")).count()
        rounds[-1] = rounds[-1].where("done")
        rounds.append(merged)
        if blocks == 1 or waiting == before:
            break
    bins = rounds[0]
    for more in rounds[1:]:
        bins = bins.unionByName(more)
    numbered = bins.select(F.monotonically_increasing_id().alias("sequence_id"), "members")
    fields = pieces.schema

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = batch.column("members")
            flat, sizes = members.flatten(), np.asarray(members.value_lengths())
            before = np.concatenate([[0], np.cumsum(np.asarray(flat.field(length)), dtype=np.int64)])
            first = np.concatenate([[0], np.cumsum(sizes)])[:-1]
            offsets = before[:-1] - np.repeat(before[first], sizes)
            ids = np.repeat(np.asarray(batch.column("sequence_id")), sizes)
            yield pa.RecordBatch.from_arrays([*flat.flatten(), pa.array(ids, pa.int64()), pa.array(offsets, pa.int64())], [*fields.names, "sequence_id", "offset"])

    return numbered.mapInArrow(place, StructType([*fields.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())]))
