"""Operator 3, benchmark decontamination: winnowed fingerprints of documents and test items, hits extended exactly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import Scratch, few, lower_ascii, table

#: Words of a window, of a fingerprint's gram. A winnowing window has WINDOW - GRAM + 1 grams, so every shared span of
#: WINDOW words holds a chosen one.
WINDOW, GRAM = 10, 5
#: Fixed pattern: what separates words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Null has no words."""
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BETWEEN, -1), lambda w: w != "")


def _grams(hashes: str, n: int) -> Column:
    """Hashes of all n-word grams of the array column, in order."""
    at = lambda i, j: F.get(F.col(hashes), i + j)
    every = F.sequence(F.lit(0), F.size(hashes) - n)
    hashed = F.transform(every, lambda i: F.xxhash64(*[at(i, j) for j in range(n)], F.lit(n)))
    return F.when(F.size(hashes) >= n, hashed).otherwise(F.array().cast("array<bigint>"))


def _winnow(grams: str) -> Column:
    """The smallest gram hash of each sliding window of an array column; of all grams if they are fewer."""
    width = WINDOW - GRAM + 1
    every = F.sequence(F.lit(0), F.greatest(F.size(grams) - width, F.lit(0)))
    lows = F.transform(every, lambda i: F.least(*[F.get(F.col(grams), i + j) for j in range(width)]))
    return F.when(F.size(grams) > 0, F.array_distinct(lows)).otherwise(F.array().cast("array<bigint>"))


def find_items(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """For each distinct (doc_id, key) that an item's window occurs in: spans (word offsets, end exclusive) and items.

    `key` is a hash of the document's row, by which documents with equal or null ids are told apart. An item of fewer
    than WINDOW words is one window; for each such length (nine at most) documents give the grams of that length
    too, so that no short item is missed. Null and empty texts have no words and no hits; items without words or id
    are never found; repeated items and ties only repeat a fact. Other columns are ignored.

    No text is shuffled but those of documents with a fingerprint in common with an item. Fingerprints of items are
    joined as rows; Spark broadcasts them only below its own size threshold.
    """
    scratch = Scratch(docs.sparkSession, "decon")
    item = items.select(F.col(item_id).alias("item"), words(F.col(item_text)).alias("w")).where((F.size("w") > 0) & F.col("item").isNotNull())
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - WINDOW + 1, F.lit(1)))
    windows = item.select("item", F.explode(F.transform(starts, lambda i: F.array_join(F.slice("w", i, WINDOW), " "))).alias("window"))
    windows = scratch.put(windows.distinct())
    distinct = windows.select("window").distinct().withColumn("w", F.split("window", " ")).withColumn("n", F.size("w"))
    short = sorted(r.n for r in distinct.where(F.col("n") < WINDOW).select("n").distinct().collect())
    prints = distinct.withColumn("h", F.transform("w", lambda x: F.xxhash64(x))).withColumn("g", _grams("h", GRAM))
    full = prints.where(F.col("n") == WINDOW).select(F.explode(_winnow("g")).alias("fp"))
    for n in short:
        full = full.unionByName(prints.where(F.col("n") == n).select(F.explode(_grams("h", n)).alias("fp")))
    known = scratch.put(full.distinct())

    key = F.xxhash64(F.col(doc_id), F.col(text)).alias("key")
    base = docs.select(F.col(doc_id).alias("doc"), key, F.col(text).alias("body"))
    base = base.withColumn("h", F.transform(words(F.col("body")), lambda x: F.xxhash64(x))).withColumn("g", _grams("h", GRAM))
    fps = F.concat(_winnow("g"), *[F.array_distinct(_grams("h", n)) for n in short])
    hit = base.select("doc", "key", F.explode(fps).alias("fp")).join(known, "fp").groupBy("doc", "key").agg(F.collect_set("fp").alias("fps"))
    hit = scratch.put(hit).select(F.col("doc").alias("d"), F.col("key").alias("k"), "fps")

    # Around each common fingerprint, every window of the document that holds it is compared word by word.
    same = F.expr("doc <=> d AND key = k")
    near = docs.select(F.col(doc_id).alias("doc"), key, F.col(text).alias("body")).join(few(hit.select("d", "k")), same, "left_semi")
    near = near.dropDuplicates(["doc", "key"]).join(hit, same).withColumn("w", words(F.col("body"))).drop("body", "d", "k")
    near = near.withColumn("h", F.transform("w", lambda x: F.xxhash64(x))).withColumn("g", _grams("h", GRAM))

    def marked(grams: str, back: int, n: int) -> Column:
        places = F.filter(F.sequence(F.lit(0), F.size(grams) - 1), lambda i: F.array_contains("fps", F.get(F.col(grams), i)))
        around = F.flatten(F.transform(places, lambda i: F.sequence(i - back, i)))
        inside = F.filter(F.array_distinct(around), lambda s: (s >= 0) & (s + n <= F.size("w")))
        cut = F.transform(inside, lambda s: F.struct(s.alias("s"), (s + n).alias("e"), F.array_join(F.slice("w", s + 1, n), " ").alias("window")))
        return F.when(F.size(grams) > 0, cut).otherwise(F.array().cast("array<struct<s:int,e:int,window:string>>"))

    spans = [marked("g", WINDOW - GRAM, WINDOW)]
    for n in short:
        near = near.withColumn(f"g{n}", _grams("h", n))
        spans.append(marked(f"g{n}", 0, n))
    found = near.select("doc", "key", F.explode(F.concat(*spans)).alias("x")).select("doc", "key", "x.*")
    found = scratch.put(found.join(distinct.select("window"), "window"))
    spans = found.groupBy("doc", "key").agg(F.array_sort(F.collect_set(F.struct("s", "e"))).alias("spans"))
    of = found.select("doc", "key", "window").distinct().join(windows, "window").groupBy("doc", "key").agg(F.collect_set("item").alias("items"))
    of = of.select(F.col("doc").alias("d"), F.col("key").alias("k"), "items")
    return spans.join(of, F.expr("doc <=> d AND key = k")).drop("d", "k")


def with_hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """`docs` (doc_id, text and others) with n_words, n_hit, n_items, items_sha256 and contaminated, one row a row."""
    scratch = Scratch(docs.sparkSession, "hits")
    found = find_items(docs, items)
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda a, x: F.struct(
            (a["n"] + F.greatest(x["e"] - F.greatest(x["s"], a["to"]), F.lit(0))).alias("n"), F.greatest(a["to"], x["e"]).alias("to")
        ),
    )["n"]
    listed = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    found = found.select(F.col("doc").alias("__d"), F.col("key").alias("__k"), covered.alias("__hit"), F.size("items").alias("__n"), listed.alias("__l"))
    found = scratch.put(found)
    n_words = F.size(words(F.col("text"))).cast("long")
    own = docs.drop("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    own = own.withColumn("__key", F.xxhash64(F.col("doc_id"), F.col("text")))
    # Texts stay where they are, as long as the ids of documents with hits are few enough to be sent to them.
    same, ids = F.expr("doc_id <=> __d AND __key = __k"), few(found.select("__d", "__k"))
    clean, hit = own.join(ids, same, "left_anti"), own.join(ids, same, "left_semi").join(found, same)
    none = F.lit(0).cast("long")
    return (
        hit.unionByName(clean, allowMissingColumns=True)
        .withColumn("n_words", n_words)
        .withColumn("n_hit", F.coalesce(F.col("__hit").cast("long"), none))
        .withColumn("n_items", F.coalesce(F.col("__n").cast("long"), none))
        .withColumn("items_sha256", F.sha2(F.coalesce("__l", F.lit("")), 256))
        .withColumn("contaminated", F.col("n_hit") > 0)
        .drop("__d", "__k", "__hit", "__n", "__l", "__key")
    )


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = with_hits(docs, table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def hits_sql(docs: str) -> str:
    """Per document of `docs` (doc_id, text), in DuckDB: every window of every length is joined, without fingerprints."""
    split = "list_filter(string_split_regex(translate(coalesce({0}, ''), '{1}', '{2}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
    w = split.format("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return f"""
    WITH dw AS MATERIALIZED (SELECT doc_id, {w} AS w FROM {docs}),
    iw AS (SELECT item_id, {w} AS w FROM benchmark),
    win AS (
        SELECT DISTINCT item_id, list_slice(w, i, i + least(len(w), {WINDOW}) - 1) AS win, least(len(w), {WINDOW}) AS n
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) AS i FROM iw WHERE len(w) > 0)
    ),
    pos AS (
        SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS win
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, (SELECT DISTINCT n FROM win))
    ),
    hit AS MATERIALIZED (SELECT doc_id, pos.n, i, item_id FROM pos JOIN win ON pos.win = win.win),
    word AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
    item AS (
        SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id
    )
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM dw LEFT JOIN word USING (doc_id) LEFT JOIN item USING (doc_id)"""


SQL = hits_sql("documents")
