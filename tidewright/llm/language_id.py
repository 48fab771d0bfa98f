"""Language identification by string kernels.

The kernel of two texts is the weighted mean, over n-gram lengths, of the cosine of their n-gram presence vectors (each
n-gram counts once, however often it occurs; n-grams are hashed into ``2**bits`` places). ``train`` takes at most
``per_language`` documents of each language, ``MOST_DOCUMENTS`` in all and none of over ``MOST_CHARS`` characters, and fits
one-versus-rest kernel ridge regression on Nyström landmarks, at most ``landmarks`` of each language. Prediction reads
whole texts: presence vectors of a batch, times the landmark vectors folded with the regression weights.

Repeated rows are judged alike, very long texts whole; an empty table gives an empty result, and is no model to learn from but one that says ``und``.
Null text, or text without a letter, gives ``und`` with score 0, as does all text when nothing was learned. Rows with a null
language or id are not learned from. Ties go to the first language in alphabetical order. Ids pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm.arrow_batches import split_batch

ORDERS = {1: (10, 0.1), 2: (13, 0.3), 3: (15, 0.6)}
"""For each n-gram length the bits of its places and its weight."""
MOST_DOCUMENTS = 6_000
MOST_CHARS = 20_000
RIDGE = 1e-3
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


def presence(text: str) -> list[np.ndarray]:
    """For each n-gram length, the places of the n-grams that the text has, with repeats."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    places, mixed = [], None
    for n, (bits, _) in ORDERS.items():
        mixed = codes * np.uint64(0x9E3779B97F4A7C15) if mixed is None else (mixed[:-1] * np.uint64(0xD6E8FEB86659FD93) + codes[n - 1 :]) * np.uint64(0x9E3779B97F4A7C15) if len(mixed) else mixed
        places.append((mixed >> np.uint64(64 - bits)).astype(np.int64))
    return places


def presence_vectors(texts: list[str]) -> list[np.ndarray]:
    """A matrix of 0 and 1 for each n-gram length: texts by places."""
    out = [np.zeros((len(texts), 1 << bits), np.float32) for bits, _ in ORDERS.values()]
    for i, t in enumerate(texts):
        for m, at in zip(out, presence(t), strict=True):
            m[i, at] = 1
    return out


def _scaled(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt(np.maximum(vectors.sum(axis=1, keepdims=True), 1))


@dataclass
class KernelModel:
    languages: list[str]
    weights: list[np.ndarray]  # for each n-gram length: places by languages

    def scores(self, texts: list[str]) -> np.ndarray:
        total = np.zeros((len(texts), len(self.languages)), np.float32)
        for vectors, w in zip(presence_vectors(texts), self.weights, strict=True):
            total += (vectors @ w) / np.sqrt(np.maximum(vectors.sum(axis=1, keepdims=True), 1))
        return total


def fit(texts: list[str], languages: list[str], landmarks: int) -> KernelModel:
    """texts in an order that does not depend on how Spark dealt them."""
    names = sorted(set(languages))
    chosen = [i for name in names for i in [k for k, x in enumerate(languages) if x == name][:landmarks]]
    marks = [_scaled(v) for v in presence_vectors([texts[i] for i in chosen])]
    shares = [w for _, w in ORDERS.values()]

    def kernel(some: list[str]) -> np.ndarray:
        return sum(w * (_scaled(v) @ m.T) for w, v, m in zip(shares, presence_vectors(some), marks, strict=True))

    inner = np.concatenate([kernel([texts[i] for i in chosen[k : k + 64]]) for k in range(0, len(chosen), 64)])
    values, axes = np.linalg.eigh(inner.astype(np.float64))
    whiten = axes / np.sqrt(np.maximum(values, 1e-6)) @ axes.T
    mapped = np.concatenate([kernel(texts[k : k + 64]) for k in range(0, len(texts), 64)]) @ whiten
    targets = np.array([[float(x == name) for name in names] for x in languages])
    solved = np.linalg.solve(mapped.T @ mapped + RIDGE * len(texts) * np.eye(len(chosen)), mapped.T @ targets)
    on_marks = (whiten @ solved).astype(np.float32)
    return KernelModel(names, [w * (m.T @ on_marks) for w, m in zip(shares, marks, strict=True)])


def train(docs: DataFrame, learned: Column, id_column: str = "doc_id", text: str = "text", language: str = "lang", per_language: int = 400, landmarks: int = 48) -> KernelModel:
    """Learns from a bounded sample of the rows for which ``learned`` holds, the same for any dealing of the rows."""
    usable = docs.where(learned & F.col(language).isNotNull() & F.col(text).rlike(r"\p{L}") & F.col(id_column).isNotNull() & (F.length(text) <= MOST_CHARS)).select(F.col(id_column).cast("string").alias("i"), F.col(language).alias("l"), F.col(text).alias("t"), F.xxhash64(F.col(id_column).cast("string"), F.lit(5)).alias("h"))
    counts = {r.l: r["n"] for r in usable.groupBy("l").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return KernelModel([], [])
    each = max(1, min(per_language, MOST_DOCUMENTS // len(counts)))
    rates = F.create_map(*[F.lit(x) for name, n in counts.items() for x in (name, min(1.0, 2 * each / n + 50 / n))])
    drawn = usable.where(F.pmod("h", F.lit(1 << 30)) < rates[F.col("l")] * float(1 << 30))
    first = drawn.withColumn("k", F.row_number().over(Window.partitionBy("l").orderBy("h", "i", "t"))).where(F.col("k") <= each)
    rows = sorted(first.select("l", "h", "i", "t").collect(), key=lambda r: (r.l, r.h, r.i, r.t))
    return fit([r.t for r in rows], [r.l for r in rows], max(1, min(landmarks, 2_000 // len(counts))))


def predict(docs: DataFrame, model: KernelModel, id_column: str = "doc_id", text: str = "text", batch: int = 64) -> DataFrame:
    """docs' ids with ``lang_pred`` and ``score``; ``id`` may be any list of columns to carry along."""
    carried = [id_column] if isinstance(id_column, str) else list(id_column)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for whole in batches:
            for part in split_batch(whole):
                texts = part.column(part.num_columns - 1).to_pylist()
                names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
                lettered = [i for i, t in enumerate(texts) if t and own.languages and _LETTER.search(t)]
                for k in range(0, len(lettered), batch):
                    at = lettered[k : k + batch]
                    found = own.scores([texts[i] for i in at])
                    for i, best, value in zip(at, found.argmax(axis=1), found.max(axis=1), strict=True):
                        names[i], scores[i] = own.languages[best], float(min(1.0, max(0.0, value)))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())], [*carried, "lang_pred", "score"])

    schema = ", ".join([*[f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carried], "lang_pred string", "score double"])
    return docs.select(*carried, F.col(text).alias("__text")).mapInArrow(run, schema)
