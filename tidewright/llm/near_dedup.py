"""Near duplicates by bottom-k sketches from one hash function.

A document's set is its distinct shingles of ``SHINGLE`` words (lower-cased in A-Z), as 64-bit hashes; a text of fewer words
is one shingle. Documents with equal sets (by a 128-bit mark) are one class. A class's sketch is the ``k``
smallest hashes; inverted lists of the rarest retained values generate overlaps, without a pair for each two members of a list:

1. In each of ``ROUNDS`` rounds one member of a list's largest component, its hub, is compared with the members of other
   components, and what links to it joins. The union of both sketches estimates the similarity, and full sets verify it.
2. Members of lists that still hold several components are put in an order of their sketches, and each is compared with the
   likeliest of the ``WINDOW`` before it that is of another component. Each turn has another order, and turns go on while they
   join many, so a large group of sets that are alike becomes one component in time that grows as its rows do.
3. What is left in lists over several components is compared by full sets alone. A set can share no shingle that it alone
   has, which bounds its similarity to any other; for what is within bounds, sets are ordered by frequency, rarest shingle
   first. Two similar sets have their first common shingle so early that enough can follow in both, so only those first
   shingles enter lists, and a pair is compared only if both places, both sizes, both components and the parities of both sets
   allow a link. Within such a list the largest component's members are never compared with each other, all others are with all
   members, so sets that are many, just under the threshold and hard to tell apart by these bounds make many pairs still.

A link of similarity 0.75 is missed by step 1's lists or estimates only if two 32-value sketches share fewer than 8 values of their
union's, the chance of which is below 1e-9 (24 are expected); step 3 is exact, and step 2 only leaves it less to do. Nothing is
capped or sampled. Components come from alternating large-star and small-star steps. All tables between rounds are written to the
shared folder.

Null text and text without words have no set and link with nothing. Repeated rows are copies like any other. Rows that share an id
but not a text are separate: each has the component of its own set. Rows with a null id are kept: they have a component
of their own, null, and ``kept`` is true. Very long texts are one set each. An empty table gives an empty result. Only the id and
text columns are read, so extra columns may have any name.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.arrow_batches import BoundedCache, split_batch
from tidewright.llm.sieve import Sieve
from tidewright.llm.workspace import Workspace

SHINGLE = 5
PERCENT = 75
K = 32
SHARED_SHARE = 0.25
"""Of the values of the larger sketch, the share that two similar sets have in common at least."""
LEAST_ESTIMATE = 0.25
ROUNDS = 2
WINDOW = 8
"""Sets before it in an order of sketches that a set is held against."""
LIKELY = 0.5
"""The share of two sketches' values that both have, in pairs of neighbours worth a comparison of full sets."""
WORTH = 64
"""Turns of neighbours go on while one of so many sets is linked in a turn."""
EDGES_AT_ONCE = 50_000
PARITIES = 8
"""Words of 64 bits for the parities of a set."""
#: Odd multipliers of the words of a shingle, and of the finishing mix.
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_WORDS = BoundedCache(lambda words: [xxhash.xxh64_intdigest(w) for w in words], 100_000)


def shingle_set(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a UTF-8 text's shingles."""
    words = text.translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    _WORDS.learn(set(words))
    codes = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    n = min(shingle, len(words))
    mixed = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * MULTIPLIERS[k % len(MULTIPLIERS)] + codes[k : len(codes) - n + 1 + k]
    for shift, factor in zip((30, 27), MIX, strict=True):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * factor
    return np.unique(mixed ^ (mixed >> np.uint64(31)))


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int64)))


def sketches(docs: DataFrame, id_column: str, text: str, k: int = K) -> DataFrame:
    """``doc``, ``h`` of its text, ``n`` distinct shingles, ``mark`` of the whole set, and the ``sketch`` in ascending order."""
    id_type = docs.schema[id_column].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in split_batch(whole):
                sets = [shingle_set(t) for t in batch.column("t").to_pylist()]
                marks = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                columns = [pa.array([len(s) for s in sets], pa.int64()), pa.array(marks, pa.binary()), _lists([s[:k].view(np.int64) for s in sets])]
                yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("h"), *columns], ["doc", "h", "n", "mark", "sketch"])

    rows = docs.select(F.col(id_column).alias("doc"), _text_hash(text).alias("h"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"))
    return rows.mapInArrow(make, f"doc {id_type}, h long, n long, mark binary, sketch array<long>")


def _text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _union_estimates(pairs: DataFrame, k: int) -> DataFrame:
    """pairs (a, b, sketch_a, sketch_b) whose estimated similarity is ``LEAST_ESTIMATE`` or more."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            passed = []
            for x, y in zip(batch.column("sketch_a").to_pylist(), batch.column("sketch_b").to_pylist(), strict=True):
                x, y = np.array(x, np.int64).view(np.uint64), np.array(y, np.int64).view(np.uint64)
                least = np.union1d(x, y)[:k]
                shared = len(np.intersect1d(np.intersect1d(x, y, True), least, True))
                passed.append(shared >= LEAST_ESTIMATE * len(least))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(passed, pa.bool_()))

    return pairs.mapInArrow(keep, "a long, b long")


def _exact(pairs: DataFrame, percent: int) -> DataFrame:
    """pairs (a, b, text_a, text_b) whose sets have the similarity."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in split_batch(whole):
                passed, at, left = [], None, None
                for a, x, y in zip(*[batch.column(c).to_pylist() for c in ("a", "text_a", "text_b")], strict=True):
                    if at != a or left is None:
                        at, left = a, shingle_set(x)
                    right = shingle_set(y)
                    both = len(np.intersect1d(left, right, True))
                    passed.append(100 * both >= percent * (len(left) + len(right) - both))
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(passed, pa.bool_()))

    return pairs.mapInArrow(keep, "a long, b long")


def components(edges: DataFrame, work: Workspace, name: str) -> DataFrame:
    """(node, component) for the nodes of edges (a, b): the smallest node each can reach."""
    now = work.save(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), f"{name}-0")
    most = int(work.spark.conf.get("spark.sql.shuffle.partitions"))
    step = 0
    while True:
        # Steps never add edges, so what is few at first needs few partitions from then on.
        width = max(1, min(most, math.ceil(now.count() / EDGES_AT_ONCE)))
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        large = work.save(large.coalesce(width), f"{name}-{step}-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        now = work.save(small.coalesce(width), f"{name}-{step + 1}")
        for done in (f"{name}-{step}", f"{name}-{step}-large"):
            work.drop(done)
        step += 1
        # Done when the edges are stars: no node has two, and none at an end is a centre too.
        ends = now.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(now.select(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("into")))
        if ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out > 1 OR (out = 1 AND into = 1)").isEmpty():
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _inverted(classes: DataFrame) -> DataFrame:
    """(value, node, n, lonely): of each class the rarest retained values that a similar class must share one of, without
    lonely ones. ``lonely`` is the share of the sketch that no other sketch has."""
    kept = classes.select("node", "n", F.size("sketch").alias("m"), F.explode("sketch").alias("value"))
    often = kept.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    # Lonely values are the rarest, so only their number matters; the rows of the others are few.
    ranked = kept.join(often, "value").groupBy("node").agg(F.first("n").alias("n"), F.first("m").alias("m"), F.sort_array(F.collect_list(F.struct("df", "value"))).alias("values"))
    needed = F.col("m") - F.ceil(F.col("m") * F.lit(SHARED_SHARE)).cast("int") + 1
    lonely = F.col("m") - F.size("values")
    rarest = F.slice("values", F.lit(1), F.greatest(F.greatest(needed, F.lit(1)) - lonely, F.lit(0)))
    entries = ranked.select("node", "n", (lonely / F.col("m")).alias("lonely"), F.explode(rarest).alias("x"))
    return entries.select("x.value", "node", "n", "lonely")


def _mains(placed: DataFrame, turn: int) -> DataFrame:
    """(value, main, hub): of each list over several components its largest one, and a hub in it. The first hub is the
    document with the least of its own, as a text that others were made from is; later ones are drawn from those with little."""
    own = F.floor(F.col("lonely") * (8 if turn else 64))
    hub = F.min(F.struct(own.alias("own"), F.xxhash64("node", F.lit(turn)).alias("h"), F.col("node").alias("hub")))
    by_part = placed.groupBy("value", "component").agg(F.count("*").alias("size"), hub.alias("x"))
    most = F.max(F.struct("size", F.col("x.h").alias("h"), F.col("component").alias("main"), F.col("x.hub").alias("hub")))
    return by_part.groupBy("value").agg(F.count("*").alias("parts"), most.alias("y")).where("parts > 1").select("value", "y.main", "y.hub")


def _shingles(texts: DataFrame) -> DataFrame:
    """(node, s) for each distinct shingle of (node, text)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in split_batch(whole, 2 << 20):
                sets = _lists([shingle_set(t).view(np.int64) for t in batch.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column("node"), sets], ["node", "sets"])

    return texts.select("node", "text").mapInArrow(make, "node long, sets array<long>").select("node", F.explode("sets").alias("s"))


def _parities(texts: DataFrame) -> DataFrame:
    """(node, bits0, ...) of (node, text): of each of ``PARITIES`` * 64 buckets of shingles, whether the set has an odd number.
    Two sets differ in one shingle at least for each bit in which these differ."""
    names = [f"bits{k}" for k in range(PARITIES)]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in split_batch(whole, 2 << 20):
                odd = [np.bincount((shingle_set(t) % np.uint64(PARITIES * 64)).astype(np.int64), minlength=PARITIES * 64) & 1 for t in batch.column("text").to_pylist()]
                words = np.packbits(np.array(odd, np.uint8).reshape(len(odd), PARITIES * 64), axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("node"), *[pa.array(words[:, k].copy()) for k in range(PARITIES)]], ["node", *names])

    return texts.select("node", "text").mapInArrow(make, ", ".join(["node long", *(f"{n} long" for n in names)]))


def likeliest(nodes: np.ndarray, components: np.ndarray, sketches: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): for rows from ``first`` on, the node b and that of the ``WINDOW`` rows before it which shares the most values with
    it and is of another component, if it shares enough. A row of ``sketches`` has no value twice."""
    best, partner = np.zeros(len(nodes)), np.zeros(len(nodes), np.int64)
    width = sketches.shape[1]
    for back in range(1, min(WINDOW, len(nodes) - 1) + 1):
        both = np.sort(np.concatenate([sketches[back:], sketches[:-back]], axis=1), axis=1)
        shared = (both[:, 1:] == both[:, :-1]).sum(axis=1)
        share = np.where(components[back:] != components[:-back], shared / (2 * width - shared), 0)
        better = np.flatnonzero(share > best[back:]) + back
        best[better], partner[better] = share[better - back], better - back
    found = np.flatnonzero(best >= LIKELY)
    found = found[found >= first]
    return nodes[partner[found]], nodes[found]


def _neighbours(live: DataFrame, marks: DataFrame, turn: int, k: int) -> DataFrame:
    """Pairs (a, b) of (node, component): of each node the likeliest of those before it, in this turn's order of its sketch."""
    order = F.array_sort(F.transform("sketch", lambda v: F.xxhash64(v, F.lit(turn))))
    rows = live.select("node", "component").join(marks, "node").select("node", "component", order.alias("order"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, components, sketches = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, k), np.int64)
        filler = 0
        for batch in batches:
            kept = len(nodes)
            own = batch.column("order")
            sizes = np.diff(np.asarray(own.offsets))
            # Places that a short sketch leaves free get numbers that no other place has.
            values = filler + np.arange(batch.num_rows * k, dtype=np.int64).reshape(-1, k)
            filler += values.size
            values[np.arange(k) < sizes[:, None]] = np.asarray(own.flatten())
            nodes = np.concatenate([nodes, np.asarray(batch.column("node"))])
            components = np.concatenate([components, np.asarray(batch.column("component"))])
            sketches = np.concatenate([sketches, values])
            a, b = likeliest(nodes, components, sketches, kept)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])
            nodes, components, sketches = nodes[-WINDOW:], components[-WINDOW:], sketches[-WINDOW:]

    return rows.repartitionByRange("order").sortWithinPartitions("order").mapInArrow(make, "a long, b long")


def _least_overlap(n: Column, other: Column, percent: int) -> Column:
    """Shingles that sets of these sizes have in common if they link."""
    return F.ceil((n + other) * percent / (100 + percent))


def _within_bounds(placed: DataFrame, texts: DataFrame, work: Workspace, percent: int) -> DataFrame | None:
    """(node, n, component) of members of lists over several components that may link beyond their own still, by the shingles
    that each has for itself. Two passes, since what leaves takes company from others."""
    for step in range(2):
        mains = work.save(_mains(placed, ROUNDS).select("value"), f"open-{step}")
        if mains.isEmpty():
            return None
        lists = work.save(placed.join(mains, "value"), f"open-lists-{step}")
        members = Sieve(work.save(lists.select("node").distinct(), f"open-members-{step}"), ["node"], work, f"open-bits-{step}")
        # Some other texts pass too. All they can do is to give a member's shingles company, so the bounds still hold.
        counts = _shingles(members.hits(texts.select("node", "text"))).groupBy("s").agg(F.count("*").alias("df"), F.min("node").alias("node"))
        alone = counts.where("df = 1").groupBy("node").agg(F.count("*").alias("alone"))
        least = lists.groupBy("value").agg(F.min("n").alias("least"))
        bounded = lists.join(alone, "node", "left").withColumn("shared", F.col("n") - F.coalesce("alone", F.lit(0))).join(least, "value")
        partner = F.greatest(F.ceil(F.col("n") * percent / 100), F.col("least"))
        placed = work.save(bounded.where(F.col("shared") >= _least_overlap(F.col("n"), partner, percent)).drop("least", "alone", "shared"), f"bounded-{step}")
    return placed.select("node", "n", "component").distinct()


def _first_common(live: DataFrame, texts: DataFrame, work: Workspace, percent: int) -> DataFrame:
    """Pairs (a, b) of (node, n, component) over several components that can link by where their first common shingle is, sets
    being ordered by frequency among these nodes."""
    own = work.save(_shingles(texts.join(live, "node", "left_semi")), "own-shingles")
    often = own.groupBy("s").agg(F.count("*").alias("df"))
    ordered = own.join(often, "s").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "s"))).alias("order")).join(live, "node")
    first = F.col("n") - _least_overlap(F.col("n"), F.ceil(F.col("n") * percent / 100), percent) + 1
    placed = ordered.select("node", "n", "component", F.posexplode(F.slice("order", 1, first.cast("int"))).alias("place", "x"))
    entries = work.save(placed.where("x.df > 1").select(F.col("x.s").alias("s"), "node", "n", "component", "place"), "first-shingles-0")
    for step in range(2):
        least = entries.groupBy("s").agg(F.min("n").alias("least"), F.min("component").alias("one"), F.max("component").alias("other")).where("one != other").select("s", "least")
        partner = F.greatest(F.ceil(F.col("n") * percent / 100), F.col("least"))
        near = entries.join(least, "s").where(F.col("n") - F.col("place") >= _least_overlap(F.col("n"), partner, percent)).drop("least")
        entries = work.save(near, f"first-shingles-{step + 1}")
    sizes = entries.groupBy("s", "component").agg(F.count("*").alias("size"))
    main = sizes.groupBy("s").agg(F.max_by("component", F.struct("size", "component")).alias("main"))
    bits = _parities(texts.join(entries.select("node").distinct(), "node", "left_semi"))
    entries = work.save(entries.join(bits, "node"), "first-shingles-bits")
    outside = entries.join(work.save(main, "first-mains"), "s").where("component != main")
    other = entries.select("s", *[F.col(c).alias(f"other_{c}") for c in entries.columns if c != "s"])
    # Of two that are both outside the largest component, one side is enough.
    once = (F.col("other_component") == F.col("main")) | (F.col("node") < F.col("other_node"))
    sizes_allow = (100 * F.least("n", "other_n") >= percent * F.greatest("n", "other_n")) & (F.least(F.col("n") - F.col("place"), F.col("other_n") - F.col("other_place")) >= _least_overlap(F.col("n"), F.col("other_n"), percent))
    differ = sum((F.bit_count(F.col(f"bits{k}").bitwiseXOR(F.col(f"other_bits{k}"))) for k in range(PARITIES)), F.lit(0))
    bits_allow = differ <= F.col("n") + F.col("other_n") - 2 * _least_overlap(F.col("n"), F.col("other_n"), percent)
    both = outside.join(other, "s").where((F.col("component") != F.col("other_component")) & once & sizes_allow & bits_allow)
    return both.select(F.least("node", "other_node").alias("a"), F.greatest("node", "other_node").alias("b"))


def near_duplicates(docs: DataFrame, work: Workspace, id_column: str = "doc_id", text: str = "text", percent: int = PERCENT, k: int = K) -> DataFrame:
    """``id``, ``n_shingles``, ``component_id`` and ``kept`` of every row."""
    found = work.save(sketches(docs, id_column, text, k), "sketches")
    real = found.where(F.col("doc").isNotNull() & (F.col("n") > 0))
    members = real.groupBy("mark").agg(F.min(F.struct("doc", "h")).alias("x"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    # Numbers are given once, as the table is written.
    classes = work.save(members.select(F.monotonically_increasing_id().alias("node"), "mark", "x.doc", "x.h", "n", "sketch"), "classes")
    lists = work.save(_inverted(classes), "lists")
    listed = work.save(classes.join(lists.select("node").distinct(), "node", "left_semi").select("doc", "h", "node"), "listed")
    whole = docs.select(F.col(id_column).alias("doc"), _text_hash(text).alias("h"), F.col(text).cast("binary").alias("text"))
    # Only texts that may be in a list are dealt out, and once: rows of one id and text are in the task that the join deals them to.
    whole = Sieve(listed, ["doc", "h"], work, "listed-bits").hits(whole)
    work.release()
    texts = work.save(whole.join(listed, ["doc", "h"]).dropDuplicates(["doc", "h", "node"]).select("node", "text"), "texts")
    work.release()
    marks = work.save(Sieve(listed, ["node"], work, "marks-bits").hits(classes.select("node", "sketch")), "marks")

    def with_both(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
        """pairs with both sides' values. Each side is found by itself, so that few pairs never make a large table move."""
        side = lambda x: pairs.join(table.select(F.col("node").alias(x), F.col(column).alias(f"{column}_{x}")), x)
        return side("a").join(side("b"), ["a", "b"]).select("a", "b", f"{column}_a", f"{column}_b")

    def placed(table: DataFrame) -> DataFrame:
        """table with the component that each node has reached."""
        return table.withColumn("component", F.col("node")) if parts is None else table.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))

    def linked(pairs: DataFrame, name: str) -> int:
        """Compares pairs by full sets and joins the components of those that link, of which it returns the number."""
        nonlocal parts
        new = work.save(_exact(with_both(pairs, texts, "text"), percent), f"edges-{name}")
        count = new.count()
        if count:
            known = new if parts is None else new.unionByName(parts.select(F.col("node").alias("a"), F.col("component").alias("b")))
            parts = components(known, work, f"stars-{name}")
        work.release()
        return count

    parts = None
    for turn in range(ROUNDS):
        now = placed(lists)
        mains = work.save(_mains(now, turn), f"mains-{turn}")
        pairs = work.save(now.join(mains, "value").where("component != main").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), f"pairs-{turn}")
        linked(work.save(_union_estimates(with_both(pairs, marks, "sketch"), k), f"alike-{turn}"), str(turn))
    live = _within_bounds(work.save(placed(lists), "placed"), texts, work, percent)
    if live is not None:
        live = work.save(live.drop("component"), "live")
        most = count = live.count()
        turn = 0
        while count and count * WORTH >= most:
            count = linked(work.save(_neighbours(placed(live), marks, turn, k), f"neighbours-{turn}"), f"near-{turn}")
            turn += 1
        now = placed(lists)
        members = now.join(_mains(now, ROUNDS).select("value"), "value").select("node").distinct()
        still = work.save(placed(live).join(members, "node", "left_semi"), "still-open")
        if not still.isEmpty():
            linked(work.save(_first_common(still, texts, work, percent).distinct(), "first-pairs"), "first")
    if parts is None:
        parts = marks.select("node", F.col("node").alias("component")).limit(0)
    labelled = classes.select("node", "mark", "doc").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = labelled.groupBy("component").agg(F.min("doc").alias("component_id"))
    reached = work.save(labelled.join(smallest, "component").select("mark", "component_id"), "reached")
    work.drop_all_but("sketches", "reached")
    joined = found.select("doc", "n", "mark").join(reached, "mark", "left")
    own = F.when(F.col("n") > 0, F.coalesce("component_id", "doc")).otherwise(F.col("doc"))
    result = joined.select(F.col("doc").alias(id_column), F.col("n").alias("n_shingles"), F.when(F.col("doc").isNotNull(), own).alias("component_id"))
    return result.withColumn("kept", F.coalesce(F.col(id_column) == F.col("component_id"), F.lit(True)))
