"""Ranked lexical search over a clustered index whose documents are ordered by recursive graph bisection.

* **Order.** Recursive bisection of the graph of documents and terms halves a set of documents so that the documents of a half share
  their terms, and goes on with both halves. It is fitted on at most ``SAMPLE`` documents (drawn by hash, ``SAMPLE_CHARS`` characters and
  ``SAMPLE_TERMS`` terms of each, terms hashed to ``FEATURES``); what a node has learned, how much dearer each term is on the other side, then
  sends every document down the tree, in the one pass that reads its terms. Documents are ordered by their leaf and by how clearly they are in it.
* **Index.** Runs of at most ``SHARD`` documents in that order are shards, a row each: its documents, and for each of its terms the documents
  that have it with their impacts, and the largest of these. Impacts do not depend on the query.
* **Search.** A shard's largest impacts bound the score that any of its documents can have for an item. Each item visits its shards by
  bound, ``VISITS`` in the first round and eight times as many in each further one, until no bound reaches the item's last score (with
  ties, until no shard that could tie has a smaller id). So the result is that of scoring all documents. Items go in blocks of at most ``CELLS``
  pairs of items and distinct terms; a block's weights are all that goes to the tasks.

Scores are integers: an item's term of document frequency df weighs floor(1000 ln((2 N + 2) / (2 df + 1))) and a document that has it tf times
counts 10^9 tf div (1000 tf + 8 m), m being 25 + 75 n N div L, for a document of n terms, N documents with terms and L terms in all. Equal
scores go by ascending document id, null ids last.

Terms are told apart by 64 bits: with 10,000 asked and 10^9 in the corpus, the chance that any asked one meets another is below 10^-6. Null and
empty texts have no terms: as documents they count nowhere, as items they find nothing. Each row is a document, so repeated rows are found each by
itself; each row of items is an item, so repeated items get equal rows. Very long texts are one document each. Empty tables give an empty result. Only the
id and text columns are read, so extra columns may have any name. Document ids are integers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm.arrow_batches import BoundedCache, rows_at_once, split_batch
from tidewright.llm.workspace import Workspace

SAMPLE, SAMPLE_CHARS, SAMPLE_TERMS, FEATURES = 4096, 8192, 256, 1 << 14
LEVELS, SWAPS = 6, 12
SHARD, MOST_POSTINGS = 512, 1 << 20
SHARD_BYTES, SHARDS_AT_ONCE = 4 << 20, 8
"""Of a row group of the index, and shards that a task takes to Python at a time."""
VISITS, WIDER = 4, 8
CELLS = 1 << 22
TOP = 10
#: The bytes of terms, with A-Z lower-cased; all others part them.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_CODES = BoundedCache(lambda terms: [xxhash.xxh64_intdigest(t) for t in terms], 200_000)


def term_counts(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit codes of a text's distinct terms, and how often each occurs."""
    counts = Counter(text.translate(_TERM).split())
    _CODES.learn(counts.keys())
    codes = np.fromiter(map(_CODES.__getitem__, counts), np.uint64, len(counts)).view(np.int64)
    return codes, np.fromiter(counts.values(), np.int64, len(counts))


@dataclass(frozen=True)
class Bisection:
    """A tree of ``levels`` levels, its nodes numbered from 1 as in a heap: of each term how much dearer the right half is, and the
    sum from which on a document goes left."""

    weights: np.ndarray
    least: np.ndarray
    levels: int

    def place(self, row: np.ndarray, term: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(leaf, margin at the last node) of n documents, given as pairs of row and code of a term."""
        node, margin, feature = np.ones(n, np.int64), np.zeros(n), term % self.weights.shape[1]
        for _ in range(self.levels):
            margin = np.bincount(row, self.weights[node[row], feature], n) - self.least[node]
            node = 2 * node + (margin < 0)
        return node - (1 << self.levels), -margin


def _dearness(degrees: np.ndarray, size: int) -> np.ndarray:
    return degrees * np.log2(size / (degrees + 1.0))


def _halves(row: np.ndarray, term: np.ndarray, n: int, features: int) -> tuple[np.ndarray, np.ndarray]:
    """Bisection of n documents: which are in the left half, and the terms' weights. Pairs of documents that gain most by moving are swapped."""
    left = np.arange(n) < n // 2
    for _ in range(SWAPS):
        sizes = max(1, int(left.sum())), max(1, int(n - left.sum()))
        here, there = (np.bincount(term[left[row] == side], minlength=features) for side in (True, False))
        stay_left = _dearness(here, sizes[0]) - _dearness(np.maximum(here - 1, 0), sizes[0]) - _dearness(there + 1, sizes[1]) + _dearness(there, sizes[1])
        stay_right = _dearness(there, sizes[1]) - _dearness(np.maximum(there - 1, 0), sizes[1]) - _dearness(here + 1, sizes[0]) + _dearness(here, sizes[0])
        gain = np.bincount(row, np.where(left[row], stay_left[term], stay_right[term]), n)
        go, come = (np.flatnonzero(side)[np.argsort(-gain[side], kind="stable")] for side in (left, ~left))
        pairs = min(len(go), len(come))
        swapped = int(np.searchsorted(-(gain[go[:pairs]] + gain[come[:pairs]]), -1e-9))
        if not swapped:
            break
        left[go[:swapped]], left[come[:swapped]] = False, True
    sizes = max(1, int(left.sum())), max(1, int(n - left.sum()))
    here, there = (np.bincount(term[left[row] == side], minlength=features) for side in (True, False))
    return left, _dearness(there + 1, sizes[1]) - _dearness(there, sizes[1]) - _dearness(here + 1, sizes[0]) + _dearness(here, sizes[0])


def fit_bisection(documents: Sequence[Sequence[int]], levels: int = LEVELS, features: int = FEATURES) -> Bisection:
    """The tree of a bounded sample of documents, given by the codes of their terms."""
    weights, least = np.zeros((1 << levels, features), np.float32), np.zeros(1 << levels)
    row = np.repeat(np.arange(len(documents)), [len(d) for d in documents])
    term = np.array([t for d in documents for t in d], np.int64) % features
    node = np.ones(len(documents), np.int64)
    for at in range(1, 1 << levels):
        own = np.flatnonzero(node == at)
        if len(own) < 2:
            continue
        number = np.full(len(documents), -1)
        number[own] = np.arange(len(own))
        mine = number[row] >= 0
        _, weights[at] = _halves(number[row[mine]], term[mine], len(own), features)
        margin = np.bincount(number[row[mine]], weights[at][term[mine]], len(own))
        least[at] = np.median(margin)
        node[own] = 2 * at + (margin < least[at])
    return Bisection(weights, least, levels)


def _sampled(docs: DataFrame, id_column: str, text: str) -> list[list[int]]:
    """The terms of at most ``SAMPLE`` documents."""
    mark = F.xxhash64(F.col(id_column), F.col(text))
    real = docs.where(F.col(text).isNotNull())
    last = real.select(mark.alias("mark")).orderBy("mark").limit(SAMPLE).agg(F.max("mark")).first()[0]
    if last is None:
        return []

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.sort(term_counts(t)[0])[:SAMPLE_TERMS].tolist() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int64()))], ["terms"])

    few = real.where(mark <= last).limit(SAMPLE).select(F.substring(text, 1, SAMPLE_CHARS).cast("binary").alias("text"))
    return [r.terms for r in few.mapInArrow(terms, "terms array<long>").collect()]


def _forward(docs: DataFrame, id_column: str, text: str, tree: Bisection) -> DataFrame:
    """(doc, n, leaf, margin, terms, counts) of every document that has terms."""
    shared = docs.sparkSession.sparkContext.broadcast(tree)  # 2^LEVELS x FEATURES numbers

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in split_batch(whole, 4 << 20):
                found = [term_counts(t) for t in batch.column("text").to_pylist()]
                sizes = [len(codes) for codes, _ in found]
                terms, counts = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
                counts = counts.astype(np.int32)
                row = np.repeat(np.arange(len(found)), sizes)
                leaf, margin = shared.value.place(row, terms, len(found))
                ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                n = np.bincount(row, counts, len(found)).astype(np.int64)
                lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (terms, counts)]
                made = pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(n), pa.array(leaf), pa.array(margin), *lists], ["doc", "n", "leaf", "margin", "terms", "counts"])
                yield made.filter(pa.array(n > 0))

    rows = docs.where(F.col(text).isNotNull()).select(F.col(id_column).cast("long").alias("doc"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(make, "doc long, n long, leaf long, margin double, terms array<long>, counts array<int>")


@dataclass(frozen=True)
class Index:
    """A row for each shard: ``shard``, ``least`` id, ``docs``, and of each of its ``terms`` in ascending order the largest impact ``peak`` and where its
    postings end (``ends``); a posting is the place of a document in the shard (``at``) and its ``impact``. Numbers of terms and postings
    are bytes (``KINDS``), as readers of long arrays hold several copies of them."""

    shards: DataFrame
    documents: int
    terms: int


SHARDS = "shard long, least long, docs array<long>, terms binary, ends binary, peak binary, at binary, impact binary"
KINDS = {"terms": np.dtype("<i8"), "ends": np.dtype("<i4"), "peak": np.dtype("<i4"), "at": np.dtype("<i4"), "impact": np.dtype("<i4")}


def _read(batch: pa.RecordBatch, row: int, *columns: str) -> list[np.ndarray]:
    return [np.frombuffer(batch.column(c)[row].as_py(), KINDS[c]) for c in columns]


def _shards(documents: int, total: int):
    """Runs of documents as shards, for mapInArrow. Documents come in order, with ``place`` in it."""

    def packed(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        lists = [table.column(c).combine_chunks() for c in ("terms", "counts")]
        terms, counts = (np.asarray(x.flatten()) for x in lists)
        at = np.repeat(np.arange(table.num_rows), np.diff(np.asarray(lists[0].offsets)))
        m = np.array([25 + 75 * n * documents // total for n in table.column("n").to_pylist()], np.int64)
        counts = counts.astype(np.int64)
        impact = 1_000_000_000 * counts // (1000 * counts + 8 * m[at])
        order = np.lexsort((at, terms))
        terms, at, impact = terms[order], at[order], impact[order]
        starts = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))
        ends = np.append(starts[1:], len(terms))
        docs = table.column("docs").to_pylist()
        named = [pa.array([table.column("place")[0].as_py()], pa.int64()), pa.array([min((d for d in docs if d is not None), default=None)], pa.int64()), pa.array([docs], pa.list_(pa.int64()))]
        numbers = zip(KINDS.values(), (terms[starts], ends, np.maximum.reduceat(impact, starts), at, impact), strict=True)
        return pa.RecordBatch.from_arrays([*named, *(pa.array([x.astype(kind).tobytes()], pa.binary()) for kind, x in numbers)], ["shard", "least", "docs", *KINDS])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = postings = 0
        for whole in batches:
            for batch in split_batch(whole, 4 << 20):
                batch = batch.rename_columns(["docs" if n == "doc" else n for n in batch.schema.names])
                while batch.num_rows:
                    part = batch.slice(0, SHARD - rows)
                    batch = batch.slice(part.num_rows)
                    held.append(part)
                    rows, postings = rows + part.num_rows, postings + len(part.column("terms").flatten())
                    if rows >= SHARD or postings >= MOST_POSTINGS:
                        yield packed(held)
                        held, rows, postings = [], 0, 0
        if held:
            yield packed(held)

    return make


def build_index(docs: DataFrame, work: Workspace, id_column: str = "doc_id", text: str = "text") -> Index:
    """The clustered index of all documents, written in the workspace."""
    tree = fit_bisection(_sampled(docs, id_column, text))
    forward = work.save(_forward(docs, id_column, text, tree), "forward")
    told = forward.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    # The hash parts copies, which all have one place in the tree.
    order = ["leaf", "margin", F.xxhash64("doc")]
    placed = forward.repartitionByRange(*order).sortWithinPartitions(*order).select("doc", "n", "terms", "counts", F.monotonically_increasing_id().alias("place"))
    shards = work.save(placed.mapInArrow(_shards(told.documents, told.terms), SHARDS), "shards", group_bytes=SHARD_BYTES)
    work.drop("forward")
    return Index(shards, told.documents, told.terms)


@dataclass(frozen=True)
class Block:
    """Items that are searched together: their terms in ascending order, and how often each item has each (terms x items)."""

    ids: list
    asked: np.ndarray
    counts: np.ndarray

    def slots(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which asked terms are among the ascending ``terms``, and where."""
        at = np.minimum(np.searchsorted(terms, self.asked), len(terms) - 1)
        there = np.flatnonzero(terms[at] == self.asked)
        return there, at[there]


def _block(items: list[tuple[object, np.ndarray, np.ndarray]]) -> Block:
    asked = np.unique(np.concatenate([codes for _, codes, _ in items]))
    counts = np.zeros((len(asked), len(items)), np.int64)
    for k, (_, codes, n) in enumerate(items):
        counts[np.searchsorted(asked, codes), k] = n
    return Block([i for i, *_ in items], asked, counts)


def blocks(items: DataFrame, id_column: str, text: str, cells: int = CELLS) -> Iterator[Block]:
    """The items, in blocks of at most ``cells`` pairs of distinct terms and items, or one item."""
    held: list[tuple[object, np.ndarray, np.ndarray]] = []
    seen: set[int] = set()
    for r in items.select(F.col(id_column).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).toLocalIterator():
        codes, counts = term_counts(r.text.encode())
        more = seen | set(codes.tolist())
        if held and len(more) * (len(held) + 1) > cells:
            yield _block(held)
            held, more = [], set(codes.tolist())
        held.append((r.id, codes, counts))
        seen = more
    if held:
        yield _block(held)


def _asked(index: Index, block: Block) -> DataFrame:
    """(shard, least, slots, dfs, peaks): of the terms asked for, those that the shard has."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for k in range(batch.num_rows):
                terms, ends, peak = _read(batch, k, "terms", "ends", "peak")
                slot, at = block.slots(terms)
                made.append((slot, np.diff(ends, prepend=0)[at], peak[at]))
            lists = [pa.array([m[k].tolist() for m in made], pa.list_(pa.int32())) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column("shard"), batch.column("least"), *lists], ["shard", "least", "slots", "dfs", "peaks"])

    return index.shards.select("shard", "least", "terms", "ends", "peak").mapInArrow(make, "shard long, least long, slots array<int>, dfs array<int>, peaks array<int>")


def _times(impacts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Integer product. Doubles, which are faster, hold it exactly unless an item's weights are huge."""
    if weights.sum(axis=0).max(initial=0) * 1_000_000 < 1 << 53:
        return (impacts.astype(np.float64) @ weights.astype(np.float64)).astype(np.int64)
    return impacts.astype(np.int64) @ weights


def _bounds(asked: DataFrame, weights: np.ndarray) -> DataFrame:
    """(item, shard, least, bound) of each item and shard that share a term."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                peaks = np.zeros((batch.num_rows, len(weights)), np.int32)
                row = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(batch.column("slots").offsets)))
                peaks[row, np.asarray(batch.column("slots").flatten())] = np.asarray(batch.column("peaks").flatten())
                bound = _times(peaks, weights)
                at, item = np.nonzero(bound)
                index = pa.array(at)
                yield pa.RecordBatch.from_arrays([pa.array(item), batch.column("shard").take(index), batch.column("least").take(index), pa.array(bound[at, item])], ["item", "shard", "least", "bound"])

    return asked.select("shard", "least", "slots", "peaks").mapInArrow(make, "item long, shard long, least long, bound long")


def _scored(visits: DataFrame, block: Block, weights: np.ndarray, top: int) -> DataFrame:
    """(item, doc, score): of each visited shard the best documents for each of its ``items``."""
    last = np.iinfo(np.int64).max

    def best(docs: np.ndarray, scores: np.ndarray) -> np.ndarray:
        good = np.flatnonzero(scores > 0)
        if len(good) > top:
            good = good[scores[good] >= np.partition(scores[good], -top)[-top]]
        return good[np.lexsort((docs[good], -scores[good]))][:top]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                terms, ends, at, impact = _read(batch, k, *(c for c in KINDS if c != "peak"))
                named, items = (batch.column(c)[k].values for c in ("docs", "items"))
                items = np.asarray(items)
                docs = np.asarray(named.fill_null(last))
                slot, term = block.slots(terms)
                own = weights[slot][:, items]
                used = own.any(axis=1)
                term, own = term[used], own[used]
                starts, sizes = np.where(term > 0, ends[term - 1], 0), np.diff(ends, prepend=0)[term]
                posting = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                impacts = np.zeros((len(docs), len(term)), np.int32)
                impacts[at[posting], np.repeat(np.arange(len(term)), sizes)] = impact[posting]
                scores = _times(impacts, own)
                found = [best(docs, scores[:, j]) for j in range(len(items))]
                item = np.repeat(items, [len(f) for f in found]).astype(np.int64)
                place = np.concatenate(found) if found else np.zeros(0, np.int64)
                score = np.concatenate([scores[f, j] for j, f in enumerate(found)]) if found else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(item), named.take(pa.array(place)), pa.array(score)], ["item", "doc", "score"])

    return visits.mapInArrow(make, "item long, doc long, score long")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc").asc_nulls_last()))
    return found.withColumn("rank", place).where(F.col("rank") <= top)


def _search_block(index: Index, block: Block, work: Workspace, name: str, top: int) -> DataFrame:
    """(item, rank, doc, score) of a block's items, by their numbers in it."""
    with rows_at_once(work.spark, SHARDS_AT_ONCE):
        asked = work.save(_asked(index, block), f"{name}-asked")
    df = np.zeros(len(block.asked), np.int64)
    for r in asked.select(F.explode(F.arrays_zip("slots", "dfs")).alias("x")).groupBy("x.slots").agg(F.sum("x.dfs").alias("df")).collect():  # one row a term of the block
        df[r.slots] = r.df
    weight = np.array([math.floor(1000 * math.log((2 * index.documents + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
    weights = weight[:, None] * block.counts
    left, best, visits, turn = work.save(_bounds(asked, weights), f"{name}-bounds-0"), None, VISITS, 0
    while True:
        nearest = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("bound"), "least", "shard"))
        now = left.withColumn("k", nearest).where(F.col("k") <= visits)
        by_shard = work.save(now.groupBy("shard").agg(F.collect_list("item").alias("items")), f"{name}-visits-{turn}")
        pages = index.shards.select("shard", "docs", "terms", "ends", "at", "impact").join(by_shard, "shard").drop("shard")
        scored = _scored(pages, block, weights, top)
        with rows_at_once(work.spark, SHARDS_AT_ONCE):
            best = work.save(_ranked(scored if best is None else scored.unionByName(best.drop("rank")), top), f"{name}-best-{turn}")
        # A block's last scores are few: what they rule out need not be visited.
        last = best.where(F.col("rank") == top).select("item", F.col("score").alias("reached"), F.col("doc").alias("by"))
        seen = by_shard.select("shard", F.explode("items").alias("item"))
        may: Column = F.col("reached").isNull() | (F.col("bound") > F.col("reached")) | ((F.col("bound") == F.col("reached")) & (F.col("by").isNull() | (F.col("least") < F.col("by"))))
        left = work.save(left.join(seen, ["item", "shard"], "left_anti").join(last, "item", "left").where(may).select("item", "shard", "least", "bound"), f"{name}-bounds-{turn + 1}")
        if left.isEmpty():
            return best
        visits, turn = visits * WIDER, turn + 1


def search(index: Index, items: DataFrame, work: Workspace, id_column: str = "item_id", text: str = "text", top: int = TOP) -> DataFrame:
    """(id, rank, doc_id, score): the ``top`` documents of each item with a score above 0."""
    kind, spark = items.schema[id_column].dataType, items.sparkSession
    found = []
    for k, block in enumerate(blocks(items, id_column, text)):
        if len(block.asked):
            names = spark.createDataFrame(list(enumerate(block.ids)), f"item long, id {kind.simpleString()}")
            found.append(_search_block(index, block, work, f"block-{k}", top).join(names, "item").select(F.col("id").alias(id_column), "rank", F.col("doc").alias("doc_id"), "score"))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], f"{id_column} {kind.simpleString()}, rank int, doc_id long, score long")
