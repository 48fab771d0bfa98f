"""Leaving out, before a join deals rows out, most of those that have no partner in it.

A key's hash names one of at most ``MOST_BITS`` bits. The bits of all keys of a table are a table of its own, of 8 MB at most whatever
the keys are, which every task gets. A row whose bit is free has no partner for certain; one whose bit is set may have none, so an exact
join follows. More keys than there is room for only make the sieve coarser.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.workspace import Workspace

BITS_A_KEY = 16
FEWEST_BITS, MOST_BITS = 1 << 18, 1 << 26


class Sieve:
    """The bits of the keys in ``columns`` of a written table."""

    def __init__(self, keys: DataFrame, columns: Sequence[str], work: Workspace, name: str):
        self.columns = list(columns)
        self.bits = min(MOST_BITS, max(FEWEST_BITS, 1 << (BITS_A_KEY * keys.count()).bit_length()))
        places = keys.select(self._place(self.columns).alias("place"))
        bitmap = F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("__bitmap")
        self.table = work.save(places.groupBy(F.bitmap_bucket_number("place").alias("__bucket")).agg(bitmap), name)

    def _place(self, columns: Sequence[str]) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(self.bits)) + 1

    def _told(self, rows: DataFrame, columns: Sequence[str] | None) -> tuple[DataFrame, Column]:
        """rows with the bits around theirs, and whether their own is set."""
        place = self._place(columns or self.columns)
        at = F.bitmap_bit_position(place)
        byte = F.conv(F.hex(F.substring("__bitmap", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
        return rows.join(F.broadcast(self.table), F.bitmap_bucket_number(place) == F.col("__bucket"), "left"), F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))

    def hits(self, rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        """All rows that have a partner among the keys, and some others."""
        told, hit = self._told(rows, columns)
        return told.where(hit).select(*rows.columns)

    def misses(self, rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        """The other rows."""
        told, hit = self._told(rows, columns)
        return told.where(~hit).select(*rows.columns)
