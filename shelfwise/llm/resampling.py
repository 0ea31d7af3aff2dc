"""Operator 12, importance resampling towards a target: documents drawn by hashed n-gram weights and exact ranks."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import Scratch, table
from shelfwise.llm.kernels import ALNUM, FOLD, pieces, word_spans

#: Words of the longest feature; buckets of features; words that a document needs; drawn documents in hundredths.
GRAMS, BUCKETS, LEAST, PERCENT, SEED = 1, 10_000, 20, 10, 2024
#: Rows of a range of ranks, on average; regular samples of a sorted run, at least.
RANGE, REGULAR = 1 << 18, 64
_FULL = np.uint32(0xFFFFFFFF)


def _crc_steps() -> np.ndarray:
    """What the low byte of a CRC-32 (reflected polynomial 0xEDB88320) turns into."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> np.uint32(1)) ^ np.uint32(0xEDB88320), out >> np.uint32(1)).astype(np.uint32)
    return out


_STEP = _crc_steps()


def _fed(state: np.ndarray, code: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC registers after the bytes from start to end."""
    state, size = state.copy(), end - start
    live = np.flatnonzero((size > 0) & (size <= 64))
    for k in range(64):
        if not len(live):
            break
        own = state[live]
        state[live] = _STEP[(own ^ code[start[live] + k]) & np.uint32(255)] ^ (own >> np.uint32(8))
        live = live[size[live] > k + 1]
    for i in np.flatnonzero(size > 64):
        state[i] = zlib.crc32(code[start[i] : end[i]].tobytes(), int(state[i] ^ _FULL)) ^ int(_FULL)
    return state


def features(texts: pa.Array | pa.ChunkedArray, grams: int = GRAMS, buckets: int = BUCKETS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, words of each row, row of each feature, its bucket): runs of up to `grams` words of whole texts."""
    for a, b, data, off in pieces(texts):
        code = FOLD[data]
        start, end, row = word_spans(code, off, ALNUM)
        words = np.bincount(row, minlength=b - a)
        state = np.full(len(start), _FULL, dtype=np.uint32)
        rows, found = [], []
        for n in range(grams):
            left = max(len(start) - n, 0)
            state = state[:left]
            if n:
                state = _STEP[(state ^ np.uint32(32)) & np.uint32(255)] ^ (state >> np.uint32(8))
            state = _fed(state, code, start[n:], end[n:])
            own = row[:left] == row[n:]
            rows.append(row[:left][own])
            found.append(((state[own] ^ _FULL) % np.uint32(buckets)).astype(np.int64))
        yield a, b, words, np.concatenate(rows), np.concatenate(found)


def bucket_counts(docs: DataFrame, text: str = "text", grams: int = GRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket: `buckets` numbers, summed by tasks and then by Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for *_, bucket in features(batch.column(0), grams, buckets):
                own += np.bincount(bucket, minlength=buckets)
        used = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(own[used])], names=["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in docs.select(F.col(text).cast("string")).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket, a thousand times the log ratio of its smoothed shares in target and raw text, rounded down."""
    size, all_raw, all_target = len(raw), int(raw.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (all_raw + size) / ((s + 1) * (all_target + size)))) for s, t in zip(raw.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, text: str = "text", grams: int = GRAMS) -> DataFrame:
    """`docs` without `text`, with n_words, n_features and weight, the sum of its features' gains. Null has no words."""
    kept = [f for f in docs.schema.fields if f.name not in (text, "n_words", "n_features", "weight")]
    names = [f.name for f in kept]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, words, row, bucket in features(batch.column(len(names)), grams, len(gain)):
                # Whole numbers, far below what doubles hold exactly.
                weight = np.bincount(row, weights=gain[bucket], minlength=b - a).astype(np.int64)
                own = [c.slice(a, b - a) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*own, pa.array(words), pa.array(np.bincount(row, minlength=b - a)), pa.array(weight)], names=[*names, "n_words", "n_features", "weight"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "n_words long, n_features long, weight long"])
    return docs.select(*[f"`{n}`" for n in names], F.col(text).cast("string")).mapInArrow(weigh, schema)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """A thousandfold Gumbel variate of a document, the same at every run, rounded down."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def _order(score: np.ndarray, doc: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """From the highest score on; of equal ones the smaller id, then the earlier row."""
    return np.lexsort((nth, doc, -score))


def _keys(of: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    doc = of.column("__doc").combine_chunks()
    return of.column("__score").to_numpy(), doc.to_numpy(), of.column("__nth").to_numpy()


def ranked(rows: DataFrame, score: str = "score", doc_id: str = "doc_id", per_range: int = RANGE) -> DataFrame:
    """`rows` with rank (1, 2, 3 ...) from the highest `score` (long) on, by parallel sorting by regular sampling.

    Ties go to the smaller id, rows without id last, and rows of one id in the order that they were staged in; a null
    score is the lowest. No two keys are equal, so no value is too common for its range. Each task sorts its rows and
    gives keys at regular places; the driver sorts those and keeps every n-th as a splitter (REGULAR a task or 8 a
    range: about 200 bytes for each `per_range` rows). Runs are cut at the splitters, the segments of a range merged in one
    task, and ranks are places plus the sizes of all ranges before. Empty input gives no rows; a column `rank` is replaced.
    """
    spark, scratch = rows.sparkSession, Scratch(rows.sparkSession, "ranks")
    names = [c for c in rows.columns if c != "rank"]
    low = F.lit(np.iinfo(np.int64).min + 1)
    key = [F.coalesce(F.col(score).cast("long"), low).alias("__score"), F.coalesce(F.col(doc_id).cast("long"), F.lit(2**63 - 1)).alias("__doc")]
    staged = scratch.put(rows.select(*[F.col(c) for c in names], *key).withColumn("__nth", F.monotonically_increasing_id()))
    total = staged.count()
    ranges = max(1, -(-total // per_range), min(int(spark.conf.get("spark.sql.shuffle.partitions")), total // 4096))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = [b for b in batches if b.num_rows]
        if run:
            of = _keys(pa.Table.from_batches(run))
            order = _order(*of)
            # As many a row as REGULAR of a run would be, and enough for all ranges.
            n = max(REGULAR, -(-8 * ranges * len(order) // max(total, 1)))
            at = order[np.unique(np.arange(n) * len(order) // n)]
            yield pa.RecordBatch.from_arrays([pa.array(c[at]) for c in of], names=["__score", "__doc", "__nth"])

    regular = staged.select("__score", "__doc", "__nth").mapInArrow(sample, "__score long, __doc long, __nth long").toPandas()
    picked = [regular[c].to_numpy(dtype=np.int64) for c in ("__score", "__doc", "__nth")]
    order = _order(*picked)
    order = order[(np.arange(1, ranges) * len(order)) // ranges] if len(order) else order
    splitters = [c[order] for c in picked]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = [b for b in batches if b.num_rows]
        if run:
            of = pa.Table.from_batches(run)
            both = [np.concatenate([mine, theirs]) for mine, theirs in zip(_keys(of), splitters, strict=True)]
            order = _order(*both)
            border = order >= of.num_rows
            part = np.cumsum(border)[~border]
            of = of.take(pa.array(order[~border])).append_column("__range", pa.array(part.astype(np.int32)))
            yield from of.to_batches(max_chunksize=1 << 16)

    def merge(segments: pa.Table) -> pa.Table:
        of = segments.take(pa.array(_order(*_keys(segments))))
        return of.append_column("__place", pa.array(np.arange(of.num_rows, dtype=np.int64)))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in staged.schema.fields)
    merged = staged.mapInArrow(cut, f"{fields}, __range int").groupBy("__range").applyInArrow(merge, f"{fields}, __range int, __place long")
    merged = scratch.put(merged)
    sizes = sorted((k, n) for k, n in merged.groupBy("__range").count().collect())
    before = np.concatenate([[0], np.cumsum([n for _, n in sizes])]).tolist()
    starts = spark.createDataFrame([(k, before[i]) for i, (k, _) in enumerate(sizes)], "__range int, __before long")
    return merged.join(starts, "__range").select(*names, (F.col("__before") + F.col("__place") + 1).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, least: int = LEAST, grams: int = GRAMS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """`docs` without `text`, with n_features, weight, score and rank; rank is null for what is not drawn.

    A document's weight is the sum of its features' gains (see `gains`), its score that plus a Gumbel variate of its
    id, so that the highest scores are a sample without replacement by importance. Of the documents with at least
    `least` words, the `percent` hundredths (rounded down) with the highest scores are drawn and ranked.

    Null and empty texts have no features and are never drawn. Rows of one id are rows each, with one variate. Columns
    of the four names are replaced, others stay. Without documents there are no rows; without target its counts are 0.
    """
    scratch = Scratch(docs.sparkSession, "resampling")
    gain = gains(bucket_counts(docs, text, grams, buckets), bucket_counts(target, text, grams, buckets))
    rows = docs.drop(*[c for c in ("n_words", "n_features", "weight", "score", "rank") if c in docs.columns])
    rows = weighted(rows, gain, text, grams).withColumn("score", F.col("weight") + noise(F.col(doc_id), seed))
    rows = scratch.put(rows)
    fit = rows.where(F.col("n_words") >= least)
    drawn = percent * fit.count() // 100
    first = ranked(fit, "score", doc_id).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = rows.where(F.col("n_words") < least).withColumn("rank", F.lit(None).cast("long"))
    return first.unionByName(rest).drop("n_words")


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample(docs, table(spark, sf_dir, "benchmark").select("text"))


def crc_sql(texts: str) -> str:
    """(name, crc): the CRC-32 of each distinct `name` of `texts` in DuckDB, byte after byte."""
    step = "CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END"
    return f"""
    SELECT name, xor(list_reduce(list_concat([4294967295], list_transform(range(length(hex(name)) // 2), lambda i: ('0x' || substr(hex(name), 2 * i + 1, 2))::BIGINT)),
           lambda c, x: xor(steps[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) AS crc
    FROM (SELECT DISTINCT name FROM {texts}),
         (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda c, k: {step})) AS steps)"""


def _words_sql(source: str) -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"SELECT *, unnest(regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS name FROM {source}"


SQL = f"""
WITH raw AS ({_words_sql("documents")}), goal AS ({_words_sql("benchmark")}),
crcs AS ({crc_sql("(SELECT name FROM raw UNION ALL SELECT name FROM goal)")}),
s AS (SELECT crc % {BUCKETS} AS bucket, count(*) AS s FROM raw JOIN crcs USING (name) GROUP BY 1),
t AS (SELECT crc % {BUCKETS} AS bucket, count(*) AS t FROM goal JOIN crcs USING (name) GROUP BY 1),
gain AS (
    SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * ((SELECT count(*) FROM raw) + {BUCKETS})::DOUBLE
           / ((s + 1) * ((SELECT count(*) FROM goal) + {BUCKETS})::DOUBLE)))::BIGINT AS gain
    FROM s LEFT JOIN t USING (bucket)
),
weights AS (
    SELECT doc_id, count(*) AS n, sum(gain)::BIGINT AS weight
    FROM raw JOIN crcs USING (name) JOIN gain ON bucket = crc % {BUCKETS} GROUP BY doc_id
),
scored AS (
    SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
           (('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM documents LEFT JOIN weights USING (doc_id)
),
fit AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_features >= {LEAST})
SELECT doc_id, n_features, weight, score, rank
FROM scored LEFT JOIN (SELECT * FROM fit WHERE rank <= (SELECT {PERCENT} * count(*) // 100 FROM fit)) USING (doc_id)"""
