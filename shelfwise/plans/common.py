"""Ids and run columns shared by the published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.params import Params


def stamped(frame: DataFrame, params: Params) -> DataFrame:
    """Add the run columns. The stamp is an argument: a retry must write the same rows."""
    return frame.withColumns(
        {
            "snapshot_date": F.lit(params.snapshot_text),
            "generated_at": F.lit(params.generated_at),
        }
    )


def with_ids(frame: DataFrame) -> DataFrame:
    article = F.col("article_key")
    ids = {"articulo": article, "id_article": article}
    if "owner_key" in frame.columns:
        ids["id_owner_article"] = F.concat_ws("|", F.coalesce("owner_key", F.lit("None")), article)
    return frame.withColumns(ids)
