"""Operator 5, language identification: nearest of several centroids per language, over TF-IDF of letter grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import small_batches, table
from shelfwise.llm.kernels import FOLD, lean, pieces

#: Dimensions that grams of 1 to 3 bytes hash into.
DIMENSIONS = 4096
#: Bound of the sample that the centroids are fitted on: rows of all languages, and of one.
SAMPLE_ROWS, LANGUAGE_ROWS = 4000, 500
CENTROIDS, ROUNDS = 4, 8
#: A text further from every centroid than this many times the furthest training text of the language, and than this
#: distance, is rejected.
SLACK, LEAST_REACH = 1.05, 0.85
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
#: ASCII letters fold to lower case; other ASCII is a space; bytes of other characters stay.
_CODES = np.where((FOLD >= 97) & (FOLD <= 122) | (np.arange(256) >= 128), FOLD, 32).astype(np.uint8)


def grams(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, end row, counts): dampened gram counts of whole texts, rows x DIMENSIONS."""
    for a, b, data, off in pieces(texts, 1 << 20, 256):
        code = _CODES[data].astype(np.uint32)
        row = np.repeat(np.arange(b - a), np.diff(off)) * DIMENSIONS
        total = np.zeros((b - a) * DIMENSIONS, dtype=np.int64)
        h = np.zeros(len(code), dtype=np.uint32)
        for n in range(3):
            # The gram of n + 1 bytes that ends here; none crosses from one text into the next, and blanks alone say nothing.
            if n < len(code):
                h = code * np.uint32(31) if n == 0 else np.concatenate([np.zeros(1, np.uint32), h[:-1]]) * np.uint32(0x01000193) + code
                own = np.ones(len(code), dtype=bool)
                for k in range(n):
                    starts = off[:-1] + k
                    own[starts[starts < off[1:]]] = False
                own &= code != 32 if n == 0 else True
                slot = ((h * np.uint32(0x9E3779B1)) >> np.uint32(20)).astype(np.int64)
                total += np.bincount((row + slot)[own], minlength=len(total))
        yield a, b, np.sqrt(total.reshape(b - a, DIMENSIONS)).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-9)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    reach: np.ndarray

    def predict(self, texts: pa.Array) -> Iterator[tuple[int, int, list[str], np.ndarray, np.ndarray]]:
        """(first row, end row, languages, scores, rejected)."""
        for a, b, counts in grams(texts):
            own = texts.slice(a, b - a)
            lettered = np.array([t is not None and _LETTER.search(t) is not None for t in own.to_pylist()])
            if not self.languages:
                yield a, b, [UNKNOWN] * (b - a), np.zeros(b - a), np.ones(b - a, dtype=bool)
                continue
            near = _unit(counts * self.idf) @ self.centroids.T
            best = near.argmax(axis=1)
            score = np.where(lettered, np.clip(near[np.arange(b - a), best], 0, 1), 0.0).astype(float)
            names = [self.languages[self.owner[k]] if ok else UNKNOWN for k, ok in zip(best, lettered, strict=True)]
            yield a, b, names, score, ~lettered | (1 - score > self.reach[self.owner[best]])


def _holding(rows: DataFrame) -> np.ndarray:
    """For each dimension, the number of `rows` whose text holds a gram of it. A task gives one row a dimension."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(DIMENSIONS, dtype=np.int64)
        for batch in batches:
            for _, _, counts in grams(batch.column(0)):
                n += np.count_nonzero(counts, axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMENSIONS, dtype=np.int32)), pa.array(n)], names=["d", "n"])

    out = np.zeros(DIMENSIONS, dtype=np.int64)
    for r in rows.select("text").mapInArrow(lean(count), "d int, n long").groupBy("d").agg(F.sum("n").alias("n")).collect():
        out[r["d"]] = r["n"]
    return out


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Model:
    """Centroids from a sample of the rows with text and language, of at most about SAMPLE_ROWS rows.

    Rows are picked by a hash of `key` and text, at a rate set by the language's number of rows. Grams are counted in
    tasks; the driver gets one vector a sampled row and clusters each language's by spherical k-means. How many texts
    hold a gram is counted over all rows with text and language, and reaches the driver as one number a dimension.
    """
    small_batches(docs.sparkSession)
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(key).alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(SAMPLE_ROWS).collect()}
    if not sizes:
        return Model([], np.ones(DIMENSIONS), np.zeros((0, DIMENSIONS)), np.zeros(0, int), np.zeros(0))
    each = min(LANGUAGE_ROWS, max(SAMPLE_ROWS // len(sizes), 1))
    rates = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, each / n))])
    draw = (F.xxhash64("key", "text") / F.lit(2.0**64)) + 0.5
    picked = rows.where(draw < F.try_element_at(rates, F.col("lang"))).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, counts in grams(batch.column(1)):
                vectors = [x.tobytes() for x in counts.astype(np.float16)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(vectors, pa.binary())], names=["lang", "vector"])

    found = sorted((r["lang"], bytes(r["vector"])) for r in picked.mapInArrow(lean(count), "lang string, vector binary").collect())
    x = np.stack([np.frombuffer(v, dtype=np.float16).astype(np.float32) for _, v in found])
    idf = np.log((1 + sum(sizes.values())) / (1 + _holding(rows))).astype(np.float32) + 1
    x = _unit(x * idf)
    languages = sorted({k for k, _ in found})
    label = np.array([languages.index(k) for k, _ in found])
    centroids, owner, reach = [], [], []
    for i in range(len(languages)):
        own = x[label == i]
        c = own[np.linspace(0, len(own) - 1, min(CENTROIDS, len(own))).astype(int)]
        for _ in range(ROUNDS):
            at = (own @ c.T).argmax(axis=1)
            c = np.stack([_unit(own[at == k].sum(axis=0)) if (at == k).any() else c[k] for k in range(len(c))])
        centroids.append(c)
        owner += [i] * len(c)
        reach.append(max(LEAST_REACH, SLACK * float((1 - (own @ c.T).max(axis=1)).max())))
    return Model(languages, idf, np.concatenate(centroids), np.array(owner), np.array(reach))


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with lang_pred, score (cosine to the nearest centroid, 0 to 1) and rejected.

    Null texts and texts without letter are `und`, score 0, rejected; so is everything if nothing was learned. Other
    texts get a learned language; those too far from all centroids are rejected. Repeated rows and ties of centroids
    (the first wins) are rows like others; extra columns stay, columns of the three names are replaced.
    The model is a few hundred KB whatever the input; there is no shuffle.
    """
    new = ("lang_pred", "score", "rejected")
    kept = [f for f in docs.schema.fields if f.name not in new]
    names = [f.name for f in kept]
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, found, score, rejected in sent.value.predict(batch.column(names.index(text))):
                own = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(found, pa.string()), pa.array(score), pa.array(rejected)], names=[*names, *new])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "lang_pred string, score double, rejected boolean"])
    return docs.select(*[f"`{n}`" for n in names]).mapInArrow(lean(run), schema)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()))
    out = identify(docs.select("doc_id", "text"), model)
    # Text went in with the rows only to be read; the projection drops it.
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
