"""Removal of repeated passages: a depth-limited radix sort of suffixes, most significant digit first.

A text is a string of symbols: its bytes, or the hashes of its words. A passage of ``length`` symbols is a suffix cut at that
depth, and two of them are equal exactly when every pass leaves them in one group, so the sort goes no deeper than that. A
pass deals the suffixes by their next digit and drops those that are alone; no group is gathered, only counted, so neither copies
nor frequent passages meet in a task. Digits are 64-bit polynomial hashes of stretches of symbols.

* The first pass needs no row for each suffix. Its digit is a suffix's anchor: of the ``gram``-symbol strings within its depth
  the one with the least hash, which equal suffixes have at the same place. One row stands for all suffixes of an anchor.
* The next passes take the suffixes of anchors that are left, on ever finer grids (``Depth.grids``): every 16th suffix, counted
  back from its anchor, then every fourth, then all. A grid suffix is cut where the suffixes up to the grid suffix before would
  end, so it has company if any of these has. Where all symbols of a group's suffixes agree, there is nothing left to tell apart
  and all of them repeat; of equal stretches in other groups one is enough for the others to meet in the next pass.

Equal texts enter once, under a key of 128 bits. A text that stands twice, whatever its ids, repeats from end to end. Null text
counts as empty. Texts shorter than ``length`` repeat nothing. Ids play no part: null, equal and ill-typed ids pass through, and
rows that tie get equal results. Very long texts go by overlapping chunks. An empty table gives an empty result. Only the id
and text columns are read, so extra columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.arrow_batches import split_batch
from tidewright.llm.sieve import Sieve
from tidewright.llm.workspace import Workspace

LENGTH = 400
CHUNK = 1 << 19
PLACE = np.uint64((1 << 20) - 1)
MOST_SEEN = 200_000
_DRAWN = np.random.default_rng(400)
_BYTES = _DRAWN.integers(0, 1 << 64, 256, np.uint64)
_BASE = np.uint64(int(_DRAWN.integers(0, 1 << 62)) * 2 + 1)
_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


@dataclass(frozen=True)
class Depth:
    """How deep suffixes are sorted, in symbols, and the grids of the passes after the first."""

    length: int
    gram: int
    grids: tuple[int, ...]
    words: bool = False

    @property
    def name(self) -> str:
        return "words" if self.words else "bytes"


def _depth(length: int, grids: Sequence[int], words: bool) -> Depth:
    return Depth(length, max(1, length * 3 // 8), tuple(g for g in grids if 4 * g <= length or g == 1), words)


def in_bytes(length: int = LENGTH) -> Depth:
    return _depth(length, (16, 4, 1), False)


def in_words(length: int) -> Depth:
    return _depth(length, (4, 1), True)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers and their inverses, to n."""
    if len(_POWERS[0]) < n:
        size = 1 << int(n - 1).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            _POWERS[k] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, base, np.uint64)]), dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


class Digits:
    """Hashes of any stretch of a chunk of bytes, or of 64-bit symbols."""

    def __init__(self, data: np.ndarray):
        powers, self.inverse = _powers(len(data) + 1)
        self.n = len(data)
        values = _BYTES[data] if data.dtype == np.uint8 else data
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers[: len(data)], dtype=np.uint64)])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.inverse[start]
        raw = (raw ^ (raw >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return raw ^ (raw >> np.uint64(32))


def word_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text start and end, in bytes."""
    gaps = np.concatenate([[True], _SPACE[data], [True]])
    edges = np.flatnonzero(gaps[1:] != gaps[:-1])
    return edges[::2], edges[1::2]


def symbols(texts: Sequence[bytes], words: bool) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all texts in one string, and where each text ends in it."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    if not words:
        return np.frombuffer(b"".join(texts), np.uint8), np.cumsum(sizes)
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    starts, stops = word_places(data)
    made = np.zeros(len(starts), np.uint64)
    seams = np.searchsorted(starts, np.arange(0, len(data) + CHUNK, CHUNK))
    for a, b in zip(seams[:-1], seams[1:], strict=True):
        if a < b:
            own = Digits(data[starts[a] : stops[b - 1]])
            made[a:b] = own.of(starts[a:b] - starts[a], stops[a:b] - starts[a])
    return made, np.searchsorted(starts, np.cumsum(sizes + 1))


def window_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by running minima from both ends of blocks."""
    n = len(keys) - width + 1
    padded = np.concatenate([keys, np.full(-len(keys) % width, ~np.uint64(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def _chunks(size: int, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(start, end, first, last): overlapping stretches of a string, and the anchors that each of them sees whole."""
    step, start = CHUNK - 4 * length, 0
    while True:
        end = min(size, start + CHUNK)
        yield start, end, start and start + length, size if end == size else start + step + length
        if end == size:
            return
        start += step


def anchors(data: np.ndarray, ends: np.ndarray, depth: Depth) -> Iterator[tuple[np.ndarray, ...]]:
    """(at, first, last, digit): anchors, the first and the last suffix that each is the anchor of, and their hashes. No suffix
    reaches over the end of its text."""
    length, gram = depth.length, depth.gram
    for start, end, low, high in _chunks(len(data), length):
        if end - start < length:
            continue
        own, at = Digits(data[start:end]), np.arange(end - start - gram + 1)
        keys = own.of(at, at + gram) & ~PLACE | at.astype(np.uint64)
        least = (window_least(keys, length - gram + 1) & PLACE).astype(np.int64)
        crossing = np.zeros(len(least) + 1, np.int64)
        border = ends[(ends > start) & (ends < end)] - start
        np.add.at(crossing, np.clip(border - length + 1, 0, len(least)), 1)
        np.add.at(crossing, np.minimum(border, len(least)), -1)
        suffix = np.flatnonzero(np.cumsum(crossing[:-1]) == 0)
        if not len(suffix):
            continue
        found = least[suffix]
        new = np.flatnonzero(np.concatenate([[True], (found[1:] != found[:-1]) | (suffix[1:] != suffix[:-1] + 1)]))
        at, first, last = found[new], suffix[new], suffix[np.concatenate([new[1:], [len(suffix)]]) - 1]
        seen = (at + start >= low) & (at + start < high)
        yield at[seen] + start, first[seen] + start, last[seen] + start, own.of(at[seen], at[seen] + gram)


def grid_digits(data: np.ndarray, bounds: tuple[np.ndarray, np.ndarray], at: np.ndarray, back: np.ndarray, length: int, grid: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For the grid suffixes that start ``back`` before their anchors: which they are, their digits, and the digits of all symbols
    of the suffixes up to the grid suffix before, where symbols beyond the text count as such. bounds: where their texts begin
    and end; grid suffixes that none of their own ends in are left out."""
    for start, end, low, high in _chunks(len(data), length):
        mine = np.flatnonzero((at >= low) & (at < high) & (at - back >= bounds[0]) & (at - back + length - grid < bounds[1]))
        if not len(mine):
            continue
        own, place = Digits(data[start:end]), at[mine] - back[mine] - start
        core = own.of(place, place + length - grid + 1)
        left, right = place - grid + 1, place + length
        before, after = np.maximum(bounds[0][mine] - start - left, 0), np.maximum(right - (bounds[1][mine] - start), 0)
        beyond = (before * 65_537 + after).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        yield mine, core, own.of(left + before, right - after) ^ beyond


def row_key(text: str) -> dict[str, Column]:
    """128 bits of a text."""
    whole = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return {"h1": F.xxhash64(whole), "h2": F.xxhash64(F.lit("text"), whole)}


KEY = ["h1", "h2"]


def _arrays(schema: dict[str, type], batch: pa.RecordBatch, rows: np.ndarray, values: Sequence[np.ndarray]) -> pa.RecordBatch:
    """Values of rows of a batch, with their texts' keys."""
    index = pa.array(rows)
    made = [pa.array(v.view(np.int64) if v.dtype == np.uint64 else v.astype(kind, copy=False)) for v, kind in zip(values, schema.values(), strict=True)]
    return pa.RecordBatch.from_arrays([batch.column("h1").take(index), batch.column("h2").take(index), *made], [*KEY, *schema])


def _ddl(schema: dict[str, type]) -> str:
    return ", ".join(["h1 long", "h2 long", *(f"{name} {'int' if kind is np.int32 else 'long'}" for name, kind in schema.items())])


def first_pass(texts: DataFrame, depth: Depth) -> DataFrame:
    """A row for each anchor of (h1, h2, text). Texts that a task has seen before give none."""
    schema = {"at": np.int64, "first": np.int64, "last": np.int64, "digit": np.int64}

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for whole in batches:
            for batch in split_batch(whole, 4 << 20):
                if len(seen) > MOST_SEEN:
                    seen.clear()
                new = []
                for k, key in enumerate(zip(batch.column("h1").to_pylist(), batch.column("h2").to_pylist(), strict=True)):
                    if key not in seen:
                        seen.add(key)
                        new.append(k)
                batch = batch.take(pa.array(new, pa.int64()))
                data, ends = symbols(batch.column("text").to_pylist(), depth.words)
                begins = np.concatenate([[0], ends[:-1]])
                for at, first, last, digit in anchors(data, ends, depth):
                    row = np.searchsorted(ends, at, "right")
                    yield _arrays(schema, batch, row, [at - begins[row], first - begins[row], last - begins[row], digit])

    return texts.mapInArrow(make, _ddl(schema))


def _places(batch: pa.RecordBatch, fields: Sequence[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The rows of a batch that its places belong to, and the places' fields."""
    places = batch.column("places")
    sizes = np.diff(np.asarray(places.offsets))
    flat = places.flatten()
    return np.repeat(np.arange(batch.num_rows), sizes), [np.asarray(flat.field(f)).astype(np.int64) for f in fields]


def next_pass(waiting: DataFrame, depth: Depth, grid: int) -> DataFrame:
    """The grid suffixes of (h1, h2, text, places), places being an anchor and the first and last of some of its suffixes, with the
    digit they have in this pass (``core``) and that of all symbols of the suffixes between (``wide``)."""
    schema = {"at": np.int64, "back": np.int32, "core": np.int64, **({"wide": np.int64} if grid > 1 else {})}

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in split_batch(whole, 4 << 20):
                data, ends = symbols(batch.column("text").to_pylist(), depth.words)
                begins = np.concatenate([[0], ends[:-1]])
                row, (at, first, last) = _places(batch, ("at", "first", "last"))
                low, high = (at - last) // grid, (at - first) // grid
                counts = high - low + 1
                one = np.repeat(np.arange(len(at)), counts)
                back = (low[one] + np.arange(len(one)) - np.repeat(np.cumsum(counts) - counts, counts)) * grid
                row, at = row[one], at[one]
                for mine, core, wide in grid_digits(data, (begins[row], ends[row]), at + begins[row], back, depth.length, grid):
                    yield _arrays(schema, batch, row[mine], [at[mine], back[mine], core, wide][: len(schema)])

    return waiting.mapInArrow(make, _ddl(schema))


def _in_company(rows: DataFrame, keys: list[str], work: Workspace, name: str, *more: Column) -> DataFrame:
    """The rows that share their digits with others. Groups are written first, so that the join deals out both sides itself and
    can split a frequent one. A group of one place is no company, however often it was read."""
    place = F.xxhash64("h1", "at")
    groups = rows.groupBy(*keys).agg(F.min(place).alias("__a"), F.max(place).alias("__z"), *more).where("__a != __z").drop("__a", "__z")
    return work.save(rows.join(work.save(groups, f"{name}-groups"), keys), f"{name}-left")


class _Sort:
    """The passes over the texts of a table, by one depth."""

    def __init__(self, keyed: DataFrame, work: Workspace, depth: Depth):
        self.work, self.depth = work, depth
        rows = work.save(first_pass(keyed, depth), f"{depth.name}-anchors")
        self.left = _in_company(rows, ["digit"], work, depth.name).drop("digit")
        for done in ("anchors", "groups"):
            work.drop(f"{depth.name}-{done}")
        work.release()

    def spans(self, held: DataFrame) -> list[DataFrame]:
        """(h1, h2, start, end) of what repeats, in symbols; an end may lie beyond the text, where the text ends."""
        depth, work, places, found = self.depth, self.work, self.left, []
        for grid in depth.grids:
            name = f"{depth.name}-{grid}"
            gathered = places.groupBy(*KEY).agg(F.collect_set(F.struct("at", "first", "last")).alias("places"))
            rows = work.save(next_pass(held.join(gathered, KEY).select(*KEY, "text", "places"), depth, grid), name)
            alike = [(F.min("wide") == F.max("wide")).alias("alike")] if grid > 1 else []
            left = _in_company(rows, ["back", "core"], work, name, *alike)
            stretch = [(F.col("at") - F.col("back") - (grid - 1)).alias("start"), (F.col("at") - F.col("back") + depth.length).alias("end")]
            if grid > 1:
                mixed, key = left.where(~F.col("alike")), ["back", "core", "wide"]
                kinds = work.save(mixed.groupBy(*key).agg(F.count("*").alias("n"), F.min(F.struct(*KEY, "at")).alias("x")), f"{name}-kinds")
                twice = mixed.join(kinds.where("n > 1").select(*key), key, "left_semi")
                done = left.where("alike").select(*KEY, *stretch).unionByName(twice.select(*KEY, *stretch))
                last = F.col("x.at") - F.col("back")
                places = kinds.select("x.h1", "x.h2", "x.at", (last - (grid - 1)).alias("first"), last.alias("last"))
            else:
                done = left.select(*KEY, *stretch)
            found.append(work.save(done, f"{name}-spans"))
            for table in (name, f"{name}-groups", f"{name}-left", f"{depth.name}-left"):
                work.drop(table)
            work.release()
        return found


def _merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of spans that overlap or touch."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > reach[:-1]])
    return start[new], reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(start) - 1]])]


def _cut(marked: DataFrame, depths: Sequence[Depth], removed: Sequence[int], characters: bool) -> DataFrame:
    """(h1, h2, text, twice, spans0, ...) to what is left of the text without the spans of depths ``removed``, and of each depth
    the number of bytes and of runs in its spans. With ``characters``, a character that loses a byte goes whole."""

    def byte_spans(batch: pa.RecordBatch, row: int, text: bytes, k: int) -> tuple[np.ndarray, np.ndarray]:
        own, depth = batch.column(f"spans{k}")[row].values, depths[k]
        start, end = (np.asarray(own.field(f)) for f in ("start", "end")) if own is not None else (np.zeros(0, np.int64),) * 2
        words = word_places(np.frombuffer(text, np.uint8)) if depth.words else None
        size = len(words[0]) if words else len(text)
        if batch.column("twice")[row].as_py() and size >= depth.length:
            start, end = np.zeros(1, np.int64), np.full(1, size)
        if not len(start):
            return start, end
        start, end = _merged(np.maximum(start, 0), np.minimum(end, size))
        return (words[0][start], words[1][end - 1]) if words else (start, end)

    def at_characters(text: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        inside = lambda at: at < len(text) and text[at] & 0xC0 == 0x80
        starts, ends = start.tolist(), end.tolist()
        for k in range(len(starts)):
            while starts[k] > 0 and inside(starts[k]):
                starts[k] -= 1
            while inside(ends[k]):
                ends[k] += 1
        return np.array(starts, np.int64), np.array(ends, np.int64)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in split_batch(whole):
                sizes, runs, left = [], [], []
                for row, text in enumerate(batch.column("text").to_pylist()):
                    found = [byte_spans(batch, row, text, k) for k in range(len(depths))]
                    sizes.append([int((e - s).sum()) for s, e in found])
                    runs.append([len(s) for s, _ in found])
                    start, end = (np.concatenate([found[k][n] for k in removed]) for n in (0, 1))
                    if len(start) and characters:
                        start, end = at_characters(text, start, end)
                    if len(start):
                        start, end = _merged(start, end)
                    edges = [0, *np.stack([start, end], 1).ravel().tolist(), len(text)]
                    left.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                columns = [pa.array(sizes, pa.list_(pa.int64())), pa.array(runs, pa.list_(pa.int64())), pa.array(left, pa.binary())]
                yield pa.RecordBatch.from_arrays([batch.column("h1"), batch.column("h2"), *columns], [*KEY, "sizes", "runs", "left"])

    return marked.mapInArrow(make, "h1 long, h2 long, sizes array<long>, runs array<long>, left binary")


def find_repeats(docs: DataFrame, work: Workspace, text: str, depths: Sequence[Depth], removed: Sequence[int], characters: bool = False) -> DataFrame:
    """For each text with repeats by any depth, under its key: of each depth ``sizes`` (bytes) and ``runs`` of what repeats,
    and ``left``, the bytes that remain without the repeats of the depths ``removed``."""
    keyed = docs.select(*[c.alias(n) for n, c in row_key(text).items()], F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    sorts = [_Sort(keyed, work, d) for d in depths]
    copies = work.save(keyed.groupBy(*KEY).agg(F.count("*").alias("n")).where("n > 1").select(*KEY), "copies")
    wanted = copies
    for s in sorts:
        wanted = wanted.unionByName(s.left.select(*KEY))
    table, parts = f"repeats_{work.path[-32:]}", int(work.spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        wanted = work.save(wanted.distinct(), "wanted")
        # Texts without company stay where they are.
        texts = Sieve(wanted, KEY, work, "wanted-bits").hits(keyed).dropDuplicates(KEY).join(wanted, KEY, "left_semi")
        work.release()
        texts.write.bucketBy(parts, *KEY).option("compression", "zstd").option("path", f"{work.path}/texts").saveAsTable(table)
        work.release()
        held = work.spark.table(table)
        marked = held.join(copies.withColumn("twice", F.lit(True)), KEY, "left").withColumn("twice", F.coalesce("twice", F.lit(False)))
        for k, s in enumerate(sorts):
            spans = reduce(DataFrame.unionByName, s.spans(held)).groupBy(*KEY).agg(F.collect_set(F.struct("start", "end")).alias(f"spans{k}"))
            marked = marked.join(spans, KEY, "left")
        return work.save(_cut(marked, depths, removed, characters), "cut")
    finally:
        work.spark.sql(f"DROP TABLE IF EXISTS {table}")
        work.drop_all_but("cut")
        work.release()


def remove_repeats(docs: DataFrame, work: Workspace, id_column: str = "doc_id", text: str = "text", length: int = LENGTH, words: int | None = None) -> DataFrame:
    """``id``, ``n_bytes``, and of strings of ``length`` bytes that repeat ``n_removed``, ``n_spans`` and the ``kept_sha256`` of the
    bytes that remain. With ``words``, also ``n_passage_bytes``, the bytes in passages of so many words that repeat; they stay."""
    depths = [in_bytes(length), *([in_words(words)] if words else [])]
    cut = find_repeats(docs, work, text, depths, [0])
    extra = ["n_passage_bytes"] if words else []
    found = cut.select(*KEY, F.get("sizes", F.lit(0)).alias("n_removed"), F.get("runs", F.lit(0)).alias("n_spans"), *[F.get("sizes", F.lit(1)).alias(c) for c in extra], F.sha2("left", 256).alias("digest"))
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id_column), F.octet_length(whole).cast("long").alias("n_bytes"), F.sha2(whole.cast("binary"), 256).alias("own"), *[c.alias(n) for n, c in row_key(text).items()])
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_removed", "n_spans", *extra)]
    return rows.join(found, KEY, "left").select(id_column, "n_bytes", *counts, F.coalesce("digest", "own").alias("kept_sha256"))


def without_repeats(docs: DataFrame, work: Workspace, text: str = "text", length: int = LENGTH, words: int | None = None) -> DataFrame:
    """docs with the remaining text, without strings of ``length`` bytes and passages of ``words`` words that repeat. A character
    that loses some of its bytes goes whole; all others stay as they are."""
    depths = [in_bytes(length), *([in_words(words)] if words else [])]
    cut = find_repeats(docs, work, text, depths, range(len(depths)), characters=True)
    keyed = docs.withColumns({f"__{n}": c for n, c in row_key(text).items()})
    changed = cut.select(F.col("h1").alias("__h1"), F.col("h2").alias("__h2"), F.col("left").cast("string").alias("__left"))
    # Only texts that may have lost something are dealt out.
    sieve = Sieve(cut, KEY, work, "cut-bits")
    joined = sieve.hits(keyed, ["__h1", "__h2"]).join(changed, ["__h1", "__h2"], "left")
    met = joined.withColumn(text, F.when(F.col(text).isNotNull(), F.coalesce("__left", F.col(text))))
    return sieve.misses(keyed, ["__h1", "__h2"]).select(*docs.columns).unionByName(met.select(*docs.columns))
