"""State tables in buckets, of which a save writes only those that changed.

Rows are placed by a hash of their source row, and a bucket is a range of places. A wave takes units in the order of places, so what it changes lies
in few buckets. ``write_whole`` makes a usual artifact, in a folder for each bucket; ``merge`` writes new versions of the buckets that have new rows as a
``..._part`` artifact, and then a small ``..._buckets`` file that says which artifact has each bucket. Nothing is written over, so a run
that stops anywhere leaves the last state that such a file or a whole artifact names.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.operators.state import merged
from tidewright.sources import tables

PLACE, BUCKET = "place__", "bucket__"
PLACE_BITS = 20
MOST_BITS = 12


def place(row_id: Column) -> Column:
    """A number below 2^20, from a hash of the row's id."""
    return F.shiftrightunsigned(F.xxhash64(row_id), 64 - PLACE_BITS).cast("int")


def bits_for(units: int, a_bucket: int) -> int:
    """Buckets, as a power of two, so that one has about so many units."""
    return min(MOST_BITS, max(0, (units // max(1, a_bucket)).bit_length()))


def within(buckets: Sequence[int], bits: int) -> Column:
    """Whether a place is in one of the buckets: few ranges, as the buckets of a wave are neighbours."""
    width, ranges = 1 << (PLACE_BITS - bits), []
    for k in sorted(buckets):
        if ranges and ranges[-1][1] == k * width:
            ranges[-1][1] += width
        else:
            ranges.append([k * width, (k + 1) * width])
    return reduce(Column.__or__, [(F.col(PLACE) >= a) & (F.col(PLACE) < b) for a, b in ranges], F.lit(False))


class Snapshot:
    """One table of a run. Its rows have ``PLACE``."""

    def __init__(self, log, folder: tables.Folder, family: str, keys: Sequence[str], bits: int):
        self.log, self.folder, self.family, self.keys, self.bits = log, folder, family, list(keys), bits
        self.where: dict[int, str] | None = None
        self.schema = None
        self.counts: dict[int, dict[str, int]] = {}
        self.written: list[tuple[int, str]] = []
        self.parts = 0

    def bucket(self) -> Column:
        return F.shiftright(PLACE, PLACE_BITS - self.bits)

    def _write(self, rows: DataFrame, family: str) -> dict[int, str]:
        cut = rows.withColumn(BUCKET, self.bucket()).repartition(BUCKET)
        self.log.write(self.folder, cut, family, (BUCKET,))
        name = self.log.newest[family]
        buckets = tables.Folder(self.folder.spark, f"{self.folder.path}/{name}").list_objects()
        made = {int(n.removeprefix(f"{BUCKET}=")): name for n in buckets if n.startswith(f"{BUCKET}=")}
        if not made:  # a table without rows has its columns in a file all the same
            rows.limit(0).coalesce(1).write.mode("append").parquet(f"{self.folder.path}/{name}")
        if "status" in rows.columns and made:
            told = self._read(made).groupBy(self.bucket().alias("k"), "status").agg(F.count("*").alias("n")).collect()  # a few rows a bucket
            self.counts |= {k: {} for k in made}
            for r in told:
                self.counts[r.k][r.status] = r.n
        return made

    def _read(self, where: dict[int, str]) -> DataFrame:
        spark, paths = self.folder.spark, [f"{self.folder.path}/{name}/{BUCKET}={k}" for k, name in sorted(where.items())]
        return spark.read.schema(self.schema).parquet(*paths) if paths else spark.createDataFrame([], self.schema)

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The rows of all buckets, or of some."""
        return self._read(self.where if buckets is None else {k: self.where[k] for k in buckets if k in self.where})

    def write_whole(self, rows: DataFrame) -> None:
        self.schema = rows.schema
        self.counts = {}
        self.where, self.parts = self._write(rows, self.family), 0
        self.drop_parts()

    def hit(self, rows: DataFrame) -> list[int]:
        """The buckets of some rows."""
        return sorted(r.k for r in rows.select(self.bucket().alias("k")).distinct().collect())  # 2^MOST_BITS at most

    def merge(self, rows: DataFrame, seq: int, gone: DataFrame | None = None) -> list[int]:
        """Replaces the rows that have the keys of ``rows`` (or of ``gone``, with ``PLACE``). Returns the buckets written."""
        hit = self.hit(rows if gone is None else gone)
        old = self.read(hit).join(merged((rows if gone is None else gone).select(*self.keys)), self.keys, "left_anti")
        made = self._write(old.unionByName(rows.select(*old.columns)), f"{self.family}_part")
        before = [(k, self.where[k]) for k in hit if k in self.where]
        self.where = {k: n for k, n in self.where.items() if k not in hit} | made
        self.counts = {k: c for k, c in self.counts.items() if k in self.where}
        text = json.dumps({"seq": seq, "buckets": self.where})
        self.folder.write_text(tables.artifact_name(f"{self.family}_buckets", self.log.run, self.log.stamp(), "json"), text)
        # Versions that the file before this one no longer named can go.
        for k, name in self.written:
            if name.startswith(f"{self.family}_part__") and self.where.get(k) != name:
                self.folder.delete_object(f"{name}/{BUCKET}={k}")
        self.written, self.parts = before, self.parts + 1
        return hit

    def finish(self, plain: bool = False) -> None:
        """One whole artifact again, as others read it; ``plain``: without the columns that buckets need."""
        if plain and self.where is not None:
            self.log.write(self.folder, self.read().drop(PLACE), self.family)
            self.drop_parts()
        elif self.parts:
            self.write_whole(self.read())

    def drop_parts(self) -> None:
        """Parts and bucket files are done with once a whole artifact is newer."""
        for name in self.folder.list_objects():
            if name.startswith((f"{self.family}_part__run_", f"{self.family}_buckets__run_")):
                self.folder.delete_object(name)

    def totals(self) -> dict[str, int]:
        """Rows of each status."""
        out: dict[str, int] = {}
        for counts in self.counts.values():
            for status, n in counts.items():
                out[status] = out.get(status, 0) + n
        return out
