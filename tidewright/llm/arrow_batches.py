"""Helpers for functions that ``mapInArrow`` runs."""

from __future__ import annotations

import ctypes
import gc
import weakref
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import SparkSession


class BoundedCache(dict):
    """A dict that computes missing values in bulk. It forgets all of them once it holds ``limit`` entries or keys of
    ``most_chars`` characters in all; keys over ``longest`` characters stay for one call of ``learn`` only.

    Spark hands a worker on from stage to stage. So that what one stage has learned does not fill the worker while others run,
    the caches of a module are forgotten, and their memory is handed back, once those of another module learn."""

    _made: list[weakref.ref] = []
    _learning = ""

    def __init__(self, compute: Callable[[list], list], limit: int, fixed: dict | None = None, most_chars: int = 64 << 20, longest: int = 256):
        super().__init__(fixed or {})
        self.compute, self.limit, self.fixed, self.most_chars, self.longest = compute, limit, fixed or {}, most_chars, longest
        self.chars, self.passing = 0, []
        self._made.append(weakref.ref(self, self._made.remove))

    def forget(self) -> None:
        self.clear()
        self.update(self.fixed)
        self.chars, self.passing = 0, []

    def _take_turn(self) -> None:
        own = self.compute.__module__
        if BoundedCache._learning == own:
            return
        BoundedCache._learning = own
        others = [c for c in (ref() for ref in self._made) if c is not None and c.compute.__module__ != own and len(c) > len(c.fixed)]
        for cache in others:
            cache.forget()
        if others:
            hand_back()

    def learn(self, keys: Iterable) -> None:
        self._take_turn()
        for key in self.passing:
            del self[key]
        self.passing = []
        wanted = set(keys)
        missing = [k for k in wanted if k not in self]
        if not missing:
            return
        chars = sum(len(k) for k in missing if len(k) <= self.longest)
        if len(self) + len(missing) > self.limit + len(self.fixed) or self.chars + chars > self.most_chars:
            self.forget()
            missing = [k for k in wanted if k not in self]
            chars = sum(len(k) for k in missing if len(k) <= self.longest)
        self.chars += chars
        self.passing = [k for k in missing if len(k) > self.longest]
        self.update(zip(missing, self.compute(missing), strict=True))


def hand_back() -> None:
    """Returns memory that nothing uses to the system, where its allocators can; else a worker holds it as long as it lives."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def without_collector() -> None:
    """Ends the search for cycles in a worker whose caches hold millions of values; nothing there makes cycles."""
    gc.disable()


def split_batch(batch: pa.RecordBatch, most_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``most_bytes`` or one row, so that few very long texts do not fill a worker."""
    if batch.nbytes <= most_bytes or batch.num_rows < 2:
        yield batch
        return
    half = batch.num_rows // 2
    yield from split_batch(batch.slice(0, half), most_bytes)
    yield from split_batch(batch.slice(half), most_bytes)


@contextmanager
def rows_at_once(spark: SparkSession, most: int) -> Iterator[None]:
    """While this lasts, jobs that start send rows to Python by at most so many: for tables of few and large rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)
