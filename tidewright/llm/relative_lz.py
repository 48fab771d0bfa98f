"""Removal of passages that stand in an earlier document, by relative Lempel-Ziv parsing.

A window is ``length`` consecutive words of one document. A word goes if a window that covers it stands, word for word, in a
document with a smaller id. The documents themselves are the reference: it is held in blocks of ``BLOCK`` words, indexed by seeds, and each
document is parsed into the longest factors that blocks of earlier documents give.

* **Index.** A window's seed is, of the strings of 3/8 of its words, the one with the least hash, so equal windows have one seed at
  the same place. A row stands for a seed's place and for all windows that it is the seed of. Seeds that stand in one document only drop out.
* **Factors.** Of each seed the place in the earliest document is the reference. All other places of the seed are joined with that
  block, and the words on both sides are compared one by one: the longest common stretch through the seed is a factor. Factors along one
  diagonal of a block are found together. Windows inside a factor are duplicates.
* **Factor boundaries.** A window of the seed that crosses an end of the factor is not in this block but may be in another. What
  all such windows of one end have in common, the seed as far as the first word beyond the factor, is the seed of the next round, in which
  the earliest document among those that share it is the reference. Each seed is longer than the one before.
* After ``ROUNDS`` rounds the windows that are still open and share a seed are compared as wholes, by 128 bits.

A place is compared with one block a round, so the work grows with the places, not with pairs of documents, however many share a passage. Nothing
is capped; a document is gathered with its own seeds only. Equal texts are parsed once: copies of an earlier document go as a
whole if they have ``length`` words.

Null text counts as empty. Rows with a null id lose nothing and are in no reference, as null is neither smaller nor larger. Rows that
share an id are not earlier than one another. Repeated rows get equal results. Texts of fewer than ``length`` words lose
nothing; very long ones go by overlapping chunks. An empty table gives an empty result. Only the id and text columns are read, so
extra columns may have any name.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.arrow_batches import split_batch
from tidewright.llm.repeats import KEY, anchors, in_words, row_key, symbols
from tidewright.llm.workspace import Workspace

LENGTH = 50
BLOCK = 128
"""Words of a block of the reference, without the margins that windows reach into."""
ROUNDS = 3
SPAN, REST = 0, 1
PLACE = "at int, first int, last int, lo int, hi int, key long"


def _seeds(docs: DataFrame, id_column: str, text: str, length: int) -> DataFrame:
    """(doc, h1, h2, n_words, own, seeds) of each row: ``own`` is the digest of all its words, ``seeds`` the places of its seeds with the first
    and the last window of each."""
    depth, id_type = in_words(length), docs.schema[id_column].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in split_batch(whole, 4 << 20):
                texts = batch.column("text").to_pylist()
                data, ends = symbols(texts, True)
                begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                found = [np.concatenate(x) for x in zip(*anchors(data, ends, depth), strict=True)] or [np.zeros(0, np.int64)] * 4
                row = np.searchsorted(ends, found[0], "right")
                fields = [(x - begins[row]).astype(np.int32) for x in found[:3]] + [found[3].view(np.int64)]
                starts = np.searchsorted(row, np.arange(len(texts) + 1)).astype(np.int32)
                seeds = pa.StructArray.from_arrays([pa.array(x) for x in fields], ["at", "first", "last", "key"])
                own = [hashlib.sha256(b" ".join(t.split())).hexdigest() for t in texts]
                columns = [pa.array(ends - begins), pa.array(own, pa.string()), pa.ListArray.from_arrays(pa.array(starts), seeds)]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("doc", *KEY)], *columns], ["doc", *KEY, "n_words", "own", "seeds"])

    rows = docs.select(F.col(id_column).alias("doc"), *[c.alias(n) for n, c in row_key(text).items()], F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(make, f"doc {id_type}, h1 long, h2 long, n_words long, own string, seeds array<struct<at: int, first: int, last: int, key: long>>")


def _blocks(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(ref, block, start, words) of (row, text, blocks): the words of blocks with their margins, and where they start."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in split_batch(whole, 4 << 20):
                out: list[tuple[int, int, int, bytes]] = []
                for row, text, blocks in zip(*[batch.column(c).to_pylist() for c in ("row", "text", "blocks")], strict=True):
                    words = text.split()
                    for b in blocks:
                        start = max(0, b * BLOCK - (length - gram))
                        out.append((row, b, start, b" ".join(words[start : (b + 1) * BLOCK + length])))
                columns = zip(*out, strict=True) if out else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)], ["ref", "block", "start", "words"])

    return texts.mapInArrow(make, "ref long, block int, start int, words binary")


def _by_texts(gathered: DataFrame, parse: Callable[[list[bytes], int, object, list], Iterator[tuple]], schema: str) -> DataFrame:
    """The rows that ``parse`` makes of each text's words, row, document and ``refs``. gathered: (row, doc, text, refs)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        for whole in batches:
            for batch in split_batch(whole, 4 << 20):
                columns = [batch.column(c) for c in ("text", "row", "doc")]
                made = [r for text, row, doc, refs in zip(*[c.to_pylist() for c in columns], _lists(batch.column("refs")), strict=True) for r in parse(text.split(), row, doc, refs)]
                kind = kind or [columns[2].type if n.split()[0] == "doc" else {"int": pa.int32(), "long": pa.int64()}[n.split()[1]] for n in schema.split(", ")]
                fields = zip(*made, strict=True) if made else [[]] * len(kind)
                yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(fields, kind, strict=True)], [n.split()[0] for n in schema.split(", ")])

    return gathered.select("row", "doc", "text", "refs").mapInArrow(make, schema)


def _lists(array: pa.Array) -> Iterator[list]:
    """Lists of structs as lists of tuples, nested ones too; faster than dicts."""
    flat = array.flatten()
    fields = [list(_lists(f)) if pa.types.is_list(f.type) else f.to_pylist() for f in map(flat.field, range(flat.type.num_fields))]
    made, at = list(zip(*fields, strict=True)), 0
    for n in np.diff(np.asarray(array.offsets)).tolist():
        yield made[at : at + n]
        at += n


def _factors(words: list[bytes], row: int, doc, refs: list, length: int, salt: int) -> Iterator[tuple]:
    """Of a document's places in blocks of the reference, (row, doc, kind, place): spans of duplicates, and what is open. refs: (document,
    start, words, places), a place being (at, first, last, lo, hi, place in the reference)."""

    def rest(at: int, first: int, last: int, lo: int, hi: int) -> tuple:
        key = xxhash.xxh64_intdigest(b" ".join(words[lo:hi]), (at - lo) << 8 | salt)
        return row, doc, REST, at, first, last, lo, hi, key - (key >> 63 << 64)

    for ref_doc, start, block, places in refs:
        told, diagonals = block.split(), defaultdict(list)
        for place in places:
            diagonals[place[0] - place[5]].append(place)
        for shift, own in diagonals.items():
            begin = max(min(p[1] for p in own), start + shift)
            end = min(max(p[2] for p in own) + length, start + shift + len(told))
            breaks = [k for k, (x, y) in enumerate(zip(words[begin:end], told[begin - start - shift : end - start - shift], strict=True), begin) if x != y]
            for at, first, last, lo, hi, _ in own:
                k = bisect_left(breaks, lo)
                right = min(breaks[k] if k < len(breaks) else end, end)
                if lo < begin or right < hi:
                    yield rest(at, first, last, lo, hi)  # only the hashes were equal
                    continue
                left = max(first, begin, breaks[k - 1] + 1 if k else 0)
                right = min(right, last + length)
                if left <= min(last, right - length) and doc > ref_doc:
                    yield row, doc, SPAN, 0, left, min(last, right - length) + length, 0, 0, 0
                if left > first:
                    yield rest(at, first, min(last, left - 1), left - 1, hi)
                if (after := max(left, right - length + 1)) <= last:
                    yield rest(at, after, last, lo, right + 1)


def _windows(words: list[bytes], row: int, doc, refs: list, length: int) -> Iterator[tuple]:
    """(row, doc, start, two halves of a 128-bit hash) of each open window of (first, last)."""
    for start in sorted({s for first, last in refs for s in range(first, last + 1)}):
        mark = hashlib.blake2b(b" ".join(words[start : start + length]), digest_size=16).digest()
        yield row, doc, start, *(int.from_bytes(mark[k : k + 8], "little", signed=True) for k in (0, 8))


def _references(places: DataFrame, work: Workspace, name: str) -> DataFrame:
    """The places whose seed stands in several documents, with the earliest of them: (ref_doc, ref, ref_at). Groups are written
    first, so that the join deals out both sides itself and can split a frequent one."""
    earliest = F.min(F.struct("doc", "row", "at"))
    groups = places.groupBy("key").agg(earliest.alias("x"), F.max("doc").alias("latest")).where("x.doc < latest")
    known = work.save(groups.select("key", F.col("x.doc").alias("ref_doc"), F.col("x.row").alias("ref"), F.col("x.at").alias("ref_at")), name)
    return places.join(known, "key")


def _cut(texts: DataFrame) -> DataFrame:
    """(row, n_removed, left) of (row, text, spans): the words outside the spans, joined by spaces."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in split_batch(whole):
                removed, left = [], []
                for text, spans in zip(batch.column("text").to_pylist(), _lists(batch.column("spans")), strict=True):
                    words, kept, at = text.split(), [], 0
                    for start, end in sorted(spans):
                        kept += words[at:start]
                        at = max(at, end)
                    kept += words[at:]
                    removed.append(len(words) - len(kept))
                    left.append(b" ".join(kept))
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(removed, pa.int64()), pa.array(left, pa.binary())], ["row", "n_removed", "left"])

    return texts.mapInArrow(make, "row long, n_removed long, left binary")


def find_copied(docs: DataFrame, work: Workspace, id_column: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """(doc, h1, h2, n_words, n_removed, left, kept_sha256) of every row: its words, those that go, and the others joined by spaces,
    which are not given (null) where all words stay."""
    gram, id_type = in_words(length).gram, docs.schema[id_column].dataType.simpleString()
    rows = work.save(_seeds(docs, id_column, text, length).withColumn("row", F.monotonically_increasing_id()), "rows")
    named = rows.where(F.col("doc").isNotNull())
    first = F.min(F.struct("doc", "row"))
    copies = work.save(named.groupBy(*KEY).agg(F.count("*").alias("n"), first.alias("x")).where("n > 1").select(*KEY, F.col("x.doc").alias("first_doc"), F.col("x.row").alias("first_row")), "copies")
    once = named.join(copies.select(*KEY, "first_row"), KEY, "left").where(F.coalesce("first_row", "row") == F.col("row"))
    places = once.select("row", "doc", F.inline("seeds")).select("row", "doc", "at", "first", "last", F.col("at").alias("lo"), (F.col("at") + gram).alias("hi"), "key")
    texts, found = None, []
    for turn in range(ROUNDS):
        live = _references(places, work, f"seeds-{turn}").where((F.col("row") != F.col("ref")) | (F.col("at") != F.col("ref_at")))
        by_block = live.groupBy("row", "doc", "ref_doc", "ref", F.floor(F.col("ref_at") / BLOCK).cast("int").alias("block"))
        pairs = work.save(by_block.agg(F.collect_list(F.struct("at", "first", "last", "lo", "hi", "ref_at")).alias("places")), f"pairs-{turn}")
        if texts is None:
            wanted = work.save(pairs.select("row").unionByName(pairs.select(F.col("ref").alias("row"))).distinct(), "wanted")
            names = named.join(wanted, "row", "left_semi").select(*KEY, "doc", "row")
            whole = docs.select(*[c.alias(n) for n, c in row_key(text).items()], F.col(id_column).alias("doc"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
            texts = work.save(whole.join(names, [*KEY, "doc"]).dropDuplicates(["row"]).select("row", "text"), "texts")
        needed = pairs.groupBy(F.col("ref").alias("row")).agg(F.collect_set("block").alias("blocks"))
        blocks = work.save(_blocks(texts.join(needed, "row"), length, gram), f"blocks-{turn}")
        gathered = pairs.join(blocks, ["ref", "block"]).groupBy("row", "doc").agg(F.collect_list(F.struct("ref_doc", "start", "words", "places")).alias("refs"))
        parse = lambda w, row, doc, refs, salt=turn: _factors(w, row, doc, refs, length, salt)
        parsed = work.save(_by_texts(gathered.join(texts, "row"), parse, f"row long, doc {id_type}, kind int, {PLACE}"), f"parsed-{turn}")
        found.append(parsed.where(F.col("kind") == SPAN).select("row", F.col("first").alias("start"), F.col("last").alias("end")))
        places = parsed.where(F.col("kind") == REST).drop("kind")
        for done in (f"seeds-{turn}", f"pairs-{turn}", f"blocks-{turn}"):
            work.drop(done)
        if places.isEmpty():
            break
    else:
        live = _references(places, work, "seeds-last").groupBy("row", "doc").agg(F.collect_set(F.struct("first", "last")).alias("refs"))
        windows = work.save(_by_texts(live.join(texts, "row"), lambda *a: _windows(*a, length), f"row long, doc {id_type}, start int, w1 long, w2 long"), "windows")
        marks = windows.groupBy("w1", "w2").agg(F.min("doc").alias("least"), F.max("doc").alias("latest")).where("least < latest").select("w1", "w2", "least")
        twice = windows.join(work.save(marks, "marks"), ["w1", "w2"]).where("doc > least")
        found.append(work.save(twice.select("row", "start", (F.col("start") + length).alias("end")), "crossing"))
    spans = reduce(DataFrame.unionByName, found).groupBy("row").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    cut = work.save(_cut(texts.join(spans, "row")), "cut")
    work.drop_all_but("rows", "copies", "cut")
    return _results(rows.drop("seeds"), copies, cut, length)


def _results(rows: DataFrame, copies: DataFrame, cut: DataFrame, length: int) -> DataFrame:
    of = rows.join(copies, KEY, "left").withColumns({"first_row": F.coalesce("first_row", "row"), "first_doc": F.coalesce("first_doc", "doc")})
    both = of.join(cut.withColumnsRenamed({"row": "first_row", "n_removed": "cut_words", "left": "cut_left"}), "first_row", "left")
    copied = F.coalesce((F.col("doc") > F.col("first_doc")) & (F.col("n_words") >= length), F.lit(False))
    shared = F.col("doc").isNotNull() & F.col("cut_words").isNotNull()
    left: Column = F.when(copied, F.lit(b"")).when(shared, F.col("cut_left"))
    removed = F.when(copied, F.col("n_words")).when(shared, F.col("cut_words")).otherwise(F.lit(0).cast("long"))
    return both.select("doc", *KEY, "n_words", removed.alias("n_removed"), left.alias("left"), F.coalesce(F.sha2(left, 256), F.col("own")).alias("kept_sha256"))


def without_copied(docs: DataFrame, work: Workspace, id_column: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """docs with what is left of the texts that lose words, joined by spaces; other texts stay as they are."""
    lost = find_copied(docs, work, id_column, text, length).where("n_removed > 0")
    lost = lost.select("doc", *KEY, F.col("left").cast("string").alias("left")).distinct()
    # In a struct, the columns of docs cannot clash with those of the join.
    keyed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("all"), *[c.alias(n) for n, c in row_key(text).items()], F.col(id_column).alias("doc"))
    joined = keyed.join(lost, ["doc", *KEY], "left")
    return joined.withColumn("text", F.coalesce("left", F.col("all").getField(text))).select(*[F.col("text").alias(c) if c == text else F.col("all").getField(c).alias(c) for c in docs.columns])
