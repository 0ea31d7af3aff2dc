"""Operator 10, line dedup: drop lines that too large a share of a site's pages carries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import Scratch, table

#: A line is boilerplate of its site beyond this share of the site's pages, and on at least so many of them.
RATIO, MIN_PAGES = 0.08, 5


def drop_site_lines(pages: DataFrame, text: str = "text", site: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """`pages` with `text` cleaned, and n_lines, n_dropped (struct column `line_dedup`).

    A page is a row; a line counts once a page, compared whole and exactly. Blank lines are kept and never counted.
    Null text stays null with no lines; an empty text is one blank line. Pages without site form one site of their
    own. Repeated rows are pages each. Extra columns are returned as they are; a column `line_dedup` is replaced.

    Counts combine before the shuffle, so a site or line with a third of all pages is a few partial rows a task. A
    site has at most (mean lines a page / ratio) boilerplate lines, so its list is short whatever the site's size.
    """
    scratch = Scratch(pages.sparkSession, "lines")
    # Two seeds: 128 bits name a line.
    two = lambda x: F.struct(F.xxhash64(x).alias("h"), F.xxhash64(F.lit("line"), x).alias("g"))
    lines = F.split(F.col(text), "\n", -1)
    filled = F.filter(lines, lambda x: F.trim(x) != "")
    seen = pages.select(F.col(site).alias("site"), F.explode(F.array_distinct(F.transform(filled, two))).alias("l"))
    counts = seen.groupBy("site", "l.h", "l.g").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    totals = pages.groupBy(F.col(site).alias("site")).agg(F.count("*").alias("total"))
    common = (
        counts.join(totals.withColumnRenamed("site", "of"), F.expr("site <=> of"))
        .where(F.col("n") > ratio * F.col("total"))
        .groupBy("site")
        .agg(F.collect_list(F.struct("h", "g")).alias("common"))
    )
    # Written first: Spark knows its true size, and broadcasts it only if that is below its own threshold.
    common = scratch.put(common).select(F.col("site").alias("__site"), F.col("common").alias("__common"))
    kept = F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains(F.col("__common"), two(x)))
    joined = pages.drop("line_dedup").join(common, F.col(site).eqNullSafe(F.col("__site")), "left")
    joined = joined.withColumn("__kept", F.when(F.col("__common").isNull(), lines).otherwise(kept))
    n = F.coalesce(F.size(lines), F.lit(0)).cast("long")
    n = F.when(F.col(text).isNull(), F.lit(0).cast("long")).otherwise(n)
    left = F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size("__kept"))
    return (
        joined.withColumn("line_dedup", F.struct(n.alias("n_lines"), (n - left).cast("long").alias("n_dropped")))
        .withColumn(text, F.array_join("__kept", "\n"))
        .drop("__site", "__common", "__kept")
    )


def query(spark, sf_dir: str) -> DataFrame:
    out = drop_site_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "line_dedup.n_lines", "line_dedup.n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


#: Cleaned documents in DuckDB, as the pipeline continues with them.
def cleaned_sql(source: str) -> str:
    return f"""
    SELECT d.doc_id, d.lang, d.source, d.text AS was, string_split(d.text, chr(10)) AS lines,
           list_filter(string_split(d.text, chr(10)), lambda x: trim(x, ' ') = '' OR NOT list_contains(coalesce(c.common, []), x)) AS kept
    FROM {source} d LEFT JOIN (
        SELECT site, list(line) AS common FROM (
            SELECT source AS site, line, count(*) AS n FROM (
                SELECT source, unnest(list_distinct(string_split(text, chr(10)))) AS line FROM {source}
            ) WHERE trim(line, ' ') <> '' GROUP BY source, line
        ) JOIN (SELECT source AS of_site, count(*) AS total FROM {source} GROUP BY source) ON site IS NOT DISTINCT FROM of_site
        WHERE n >= {MIN_PAGES} AND n > {RATIO} * total GROUP BY site
    ) c ON d.source IS NOT DISTINCT FROM c.site"""


SQL = f"""
SELECT doc_id, coalesce(len(lines), 0)::BIGINT AS n_lines, coalesce(len(lines) - len(kept), 0)::BIGINT AS n_dropped,
       sha256(array_to_string(kept, chr(10))) AS kept_sha256
FROM ({cleaned_sql("documents")})"""
