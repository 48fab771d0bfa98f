"""Compression of vectors to codes: product quantization whose nearest entries are found by VA-file filtering.

A vector's components become integers, floor(``scale`` * x); it is cut into ``parts`` equal stretches, and each part position has a
codebook of ``entries`` integer vectors. Lloyd's rounds assign every part of every vector to its nearest entry. The
codebook is held as a vector approximation: the range of each coordinate is cut into 2 ** ``bits`` cells with about as many
entries each, and an entry is known by its cells. For each query part a table gives, for each coordinate and cell, the least and
the largest squared difference that an entry there can have. Their sums bound each entry's distance; only entries whose lower
bound does not exceed the least upper bound get an integer distance. All is integer arithmetic, so nothing is lost and
ties go to the lower index.

A round is one pass over the table in which each task sums its own parts per entry, so what is shuffled grows with tasks and
codebook, not with vectors; the codebook (entries x width integers) is all that reaches the driver and the tasks.

Rows whose vector is null or holds null or non-finite components are dropped. Vectors shorter than the longest, rounded up to a
multiple of ``parts``, count as ended by zeros; an empty vector has zeros only. A component of ``MOST`` or more after scaling raises
OverflowError, as distances would not fit 64 bits. With fewer kept rows than entries the codebooks have as many entries as rows. Null
ids come after all others when the first codebook is drawn; rows with one id are drawn in the order of their components. An
empty table gives an empty result. Repeated rows get equal codes. Only the id, vector and label columns are read, so extra
columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.workspace import Workspace

SCALE, PARTS, ENTRIES, ROUNDS, BITS = 1024, 4, 256, 4, 4
MOST = 1 << 26
AT_ONCE = 1024
"""Query parts that are bounded together."""


class Approximation:
    """Entries (n, d) of one part position, with their cells."""

    def __init__(self, entries: np.ndarray, bits: int = BITS):
        self.entries = entries
        n, d = entries.shape
        self.cells = np.zeros((d, n), np.int64)
        self.low, self.high = [], []
        for j in range(d):
            # Equal coordinates share a cell, so that cells are ranges.
            values, place = np.unique(entries[:, j], return_inverse=True)
            cell = np.arange(len(values)) * min(1 << bits, len(values)) // len(values)
            starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            self.low.append(values[starts])
            self.high.append(values[np.concatenate([starts[1:] - 1, [len(values) - 1]])])
            self.cells[j] = cell[place]
        self.reach = int(np.abs(entries).max(initial=0))

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry to each of (n, d) integer points, the lower index if several are."""
        index, least = np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
        for at in range(0, len(points), AT_ONCE):
            index[at : at + AT_ONCE], least[at : at + AT_ONCE] = self._nearest(points[at : at + AT_ONCE])
        return index, least

    def _nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, d = points.shape
        far = self.reach + int(np.abs(points).max(initial=0))
        kind = np.int32 if far * far * max(d, 1) < 1 << 31 else np.int64
        lower, upper = np.zeros((len(self.entries), n), kind), np.zeros((len(self.entries), n), kind)
        for j in range(d):
            x = points[:, j].astype(kind)
            under, over = self.low[j].astype(kind)[:, None] - x, x - self.high[j].astype(kind)[:, None]
            gap, span = np.maximum(np.maximum(under, over), 0), np.maximum(np.abs(under), np.abs(over))
            lower += (gap * gap)[self.cells[j]]
            upper += (span * span)[self.cells[j]]
        point, entry = np.nonzero((lower <= upper.min(axis=0)).T)
        apart = points[point] - self.entries[entry]
        exact = np.einsum("ij,ij->i", apart, apart)
        first = np.searchsorted(point, np.arange(n))
        least = np.minimum.reduceat(exact, first)
        found = np.flatnonzero(exact == least[point])
        return entry[found[np.searchsorted(point[found], np.arange(n))]], least


@dataclass(frozen=True)
class Codebooks:
    """Entries by part, entry and position: (parts, entries, width of a part)."""

    entries: np.ndarray
    bits: int = BITS

    def approximations(self) -> list[Approximation]:
        return [Approximation(e, self.bits) for e in self.entries]

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _integers(vectors: pa.Array, width: int, scale: int) -> np.ndarray:
    """The scaled components of vectors as (n, width) integers."""
    sizes = np.diff(np.asarray(vectors.offsets))
    flat = np.floor(np.asarray(vectors.flatten(), np.float64) * scale)
    if np.abs(flat).max(initial=0) >= MOST:
        raise OverflowError(f"a component is {MOST} or more after scaling; distances would not fit 64 bits")
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat.astype(np.int64)
    return out


def usable(table: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there and has finite components only."""
    component = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return table.where(F.col(vector).isNotNull() & F.coalesce(F.forall(vector, component), F.lit(False)))


def first_codebooks(kept: DataFrame, width: int, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, bits: int = BITS) -> Codebooks:
    """The parts of the vectors (id, vector) with the least ids."""
    drawn = kept.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
    rows = np.zeros((len(drawn), width), np.int64)
    for k, r in enumerate(drawn):
        rows[k] = _integers(pa.array([r.vector], pa.list_(pa.float64())), width, scale)[0]
    return Codebooks(rows.reshape(len(drawn), parts, width // parts).transpose(1, 0, 2).copy(), bits)


def _moved(kept: DataFrame, books: Codebooks, width: int, scale: int) -> Codebooks:
    """The codebooks after one round over (vector)."""
    parts, entries, size = books.entries.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, total = books.approximations(), np.zeros((parts, entries, size + 1), np.int64)
        for batch in batches:
            rows = _integers(batch.column("vector"), width, scale)
            for p in range(parts):
                own = rows[:, p * size : (p + 1) * size]
                index, _ = near[p].nearest(own)
                order = np.argsort(index, kind="stable")
                used, start = np.unique(index[order], return_index=True)
                if len(used):
                    total[p, used, :size] += np.add.reduceat(own[order], start, axis=0)
                    total[p, used, size] += np.diff(np.append(start, len(order)))
        flat = total.ravel()
        slots = np.flatnonzero(np.repeat(total[:, :, size].ravel() > 0, size + 1))
        yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int64()), pa.array(flat[slots])], ["slot", "s"])

    total = np.zeros(parts * entries * (size + 1), np.int64)
    for r in kept.select("vector").mapInArrow(sums, "slot long, s long").groupBy("slot").agg(F.sum("s").alias("s")).collect():  # as large as the codebooks
        total[r.slot] = r.s
    total = total.reshape(parts, entries, size + 1)
    counts = total[:, :, size:]
    return Codebooks(np.where(counts > 0, total[:, :, :size] // np.maximum(counts, 1), books.entries), books.bits)


def compress(table: DataFrame, work: Workspace, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, bits: int = BITS) -> tuple[DataFrame, Codebooks]:
    """(id, label, ``codes``, ``error``) of each kept row, codes being entries' indexes in the order of parts and error the squared distance
    from the vector to its entries; and the codebooks."""
    kept = usable(table, vector).select(F.col(id_column).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    longest = kept.agg(F.max(F.size("vector"))).first()[0] or 0
    width = -(-longest // parts) * parts
    books = first_codebooks(kept, width, scale, parts, entries, bits)
    for _ in range(rounds if len(books.entries[0]) else 0):
        books = _moved(kept, books, width, scale)
    size = width // parts

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = books.approximations()
        for batch in batches:
            rows = _integers(batch.column("vector"), width, scale)
            found = [near[p].nearest(rows[:, p * size : (p + 1) * size]) for p in range(parts)]
            codes = np.stack([index for index, _ in found], 1).astype(np.int32)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(codes.ravel()), parts).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), lists, pa.array(sum(d for _, d in found))], ["id", "label", "codes", "error"])

    kinds = {n: kept.schema[n].dataType.simpleString() for n in ("id", "label")}
    return work.save(kept.mapInArrow(code, f"id {kinds['id']}, label {kinds['label']}, codes array<int>, error long"), "codes"), books


def restored(coded: DataFrame, books: Codebooks, scale: int = SCALE) -> DataFrame:
    """(id, vector) of (id, codes): the vectors that codes stand for, with the zeros that they were ended by."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = np.arange(len(books.entries))
        for batch in batches:
            codes = np.asarray(batch.column("codes").flatten()).reshape(batch.num_rows, len(parts))
            rows = books.entries[parts, codes].reshape(batch.num_rows, -1) / scale
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * rows.shape[1]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()))], ["id", "vector"])

    return coded.select("id", "codes").mapInArrow(read, f"id {coded.schema['id'].dataType.simpleString()}, vector array<double>")
