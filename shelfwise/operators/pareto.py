"""Pareto classification by movement lines.

Order: lines, then quantity, both descending, then the keys. A row is A while the rows before it hold under 80% of
the lines, B under 95%, else C. Rows without lines are D with share 0. Limits are compared in whole numbers: the class
does not depend on how a sum of fractions was rounded.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators.reuse import keep
from shelfwise.operators.running import running_total
from shelfwise.params import Params

_CELL = ["_measure", "_lines"]


@dataclass(frozen=True)
class Measure:
    """What rows are ranked by, and the columns that the ranking adds; ``cumulative`` may be left out."""

    lines: str
    quantity: str
    rotation: str
    share: str
    cumulative: str | None = None


def _class(before: Column, total: Column, params: Params) -> Column:
    return (
        F.when(before * 100 < total * params.limit_a, "A").when(before * 100 < total * params.limit_b, "B").otherwise("C")
    )


def _cells(rows: DataFrame, measures: list[Measure], keys: list[str], partition: list[str]) -> DataFrame:
    """A row for each measure in which a row has lines: keys, lines and quantity, and nothing else."""
    cells = [
        F.struct(F.lit(n).alias("_measure"), F.col(m.lines).alias("_lines"), F.col(m.quantity).alias("_quantity"))
        for n, m in enumerate(measures)
    ]
    names = [name for name in partition if name not in keys]
    return rows.select(*keys, *names, F.inline(F.array(*cells))).where(F.col("_lines") > 0)


def _histogram(cells: DataFrame, partition: list[str]) -> DataFrame:
    """Per measure, partition and number of lines: rows, the lines of all rows with more, and all lines.

    Distinct numbers of lines add up to the total at most, so there are under sqrt(2 x total) of them in a partition:
    the windows and the broadcasts of this table stay small, whatever the number of rows.
    """
    counts = cells.groupBy(*partition, *_CELL).agg(F.count("*").alias("_n"))
    whole = Window.partitionBy(*partition, "_measure")
    earlier = whole.orderBy(F.desc("_lines")).rowsBetween(Window.unboundedPreceding, -1)
    held = F.sum(F.col("_lines") * F.col("_n"))
    return counts.select(
        *partition, *_CELL, "_n", F.coalesce(held.over(earlier), F.lit(0)).alias("_from"), held.over(whole).alias("_total")
    )


def _pivoted(placed: DataFrame, measures: list[Measure], by: list[str], columns: list[str]) -> DataFrame:
    """One row a key: the columns of its cells, side by side."""
    picked = [F.max(F.when(F.col("_measure") == n, F.col(c))).alias(f"{c}_{n}") for n in range(len(measures)) for c in columns]
    return placed.groupBy(*by).agg(*picked)


def _ranked_by_one(rows: DataFrame, params: Params, order: list[Column], measure: Measure, partition: list[str]) -> DataFrame:
    """The ranking by one measure: rows that need a place are put in order whole, so nothing is joined back to them."""
    rows, lines = keep(rows), F.col(measure.lines)
    cells = rows.withColumns({"_lines": lines, "_quantity": F.col(measure.quantity)})
    moved = F.coalesce(lines > 0, F.lit(False))
    nowhere = {name: F.lit(None).cast("bigint") for name in ("_before", "_total")}
    if measure.cumulative:
        by_lines = [F.col("_lines").desc(), *order]
        placed = running_total(cells.where(moved), "_lines", by_lines, partition, "_before", "_total")
        found = placed.unionByName(cells.where(~moved).withColumns(nowhere))
    else:
        counted = cells.where(moved).withColumn("_measure", F.lit(0))
        last = F.col("_from") + (F.col("_n") - 1) * F.col("_lines")
        split = _class(F.col("_from"), F.col("_total"), params) != _class(last, F.col("_total"), params)
        histogram = _histogram(counted, partition).drop("_measure").withColumn("_split", split)
        known = cells.join(F.broadcast(histogram), [*partition, "_lines"], "left").drop("_n")
        cut = F.coalesce("_split", F.lit(False))
        inner = running_total(known.where(cut), "_lines", order, [*partition, "_lines"], "_inside", "_held").drop("_held")
        rest = known.where(~cut).withColumn("_inside", F.lit(0).cast("bigint"))
        found = inner.unionByName(rest).withColumn("_before", F.col("_from") + F.col("_inside"))
    return _with_classes(found, rows.columns, params, [(measure, F.col("_before"), F.col("_total"))])


def _with_classes(found: DataFrame, kept: list[str], params: Params, places: list[tuple[Measure, Column, Column]]) -> DataFrame:
    """The columns of every measure, from the lines before a row and the lines of all."""
    columns = {}
    for m, before, total in places:
        moved = F.col(m.lines) > 0
        columns[m.rotation] = F.when(~moved, "D").otherwise(_class(before, total, params))
        columns[m.share] = F.when(moved, F.col(m.lines) / total).otherwise(0.0)
        if m.cumulative:
            columns[m.cumulative] = F.when(moved, (before + F.col(m.lines)) / total).otherwise(0.0)
    return found.select(*kept, *[value.alias(name) for name, value in columns.items()])


def ranked(rows: DataFrame, params: Params, keys: list[str], measures: list[Measure], partition: list[str] | None = None) -> DataFrame:
    """Add the columns of every measure to ``rows``, which hold each key once per partition.

    Classes come from a histogram of lines: rows with one number of lines are of one class, but where a limit falls
    among them. Only those are put in order, and nothing of the others is shuffled: they meet the histogram where they
    are. A cumulative share depends on every row's place; a measure that asks for it has its keys, lines and
    quantities ordered whole, and only places come back. With one measure the rows themselves are ordered.
    """
    partition = partition or []
    by = list(dict.fromkeys([*keys, *partition]))
    order = [F.col("_quantity").desc(), *[F.col(key).asc() for key in keys]]
    if len(measures) == 1:
        return _ranked_by_one(rows, params, order, measures[0], partition)
    rows = keep(rows)
    cells = _cells(rows, measures, keys, partition)
    placed, exact = [], [n for n, m in enumerate(measures) if m.cumulative]
    if exact:
        some = cells.where(F.col("_measure").isin(exact))
        whole = running_total(some, "_lines", [F.col("_lines").desc(), *order], [*partition, "_measure"], "_before", "_total")
        placed.append(whole.select(*by, "_measure", "_before", "_total"))
    histogram = None
    if len(exact) < len(measures):
        some = cells.where(~F.col("_measure").isin(exact)) if exact else cells
        histogram = _histogram(some, partition)
        last = F.col("_from") + (F.col("_n") - 1) * F.col("_lines")
        split = _class(F.col("_from"), F.col("_total"), params) != _class(last, F.col("_total"), params)
        edges = some.join(F.broadcast(histogram.where(split)), [*partition, *_CELL])
        inner = running_total(edges, "_lines", order, [*partition, *_CELL], "_inside", "_held")
        placed.append(inner.select(*by, "_measure", (F.col("_from") + F.col("_inside")).alias("_before"), "_total"))

    found = rows
    for k, part in enumerate(placed):
        own = _pivoted(part, measures, by, ["_before", "_total"])
        found = found.join(own.select(*by, *[F.col(c).alias(f"{c}_{k}") for c in own.columns if c not in by]), by, "left")
    places = []
    for n, m in enumerate(measures):
        names = {c: [F.col(f"_{c}_{n}_{k}") for k in range(len(placed))] for c in ("before", "total")}
        if n not in exact:
            own = histogram.where(F.col("_measure") == n).select(
                *partition, F.col("_lines").alias(m.lines), F.col("_from").alias(f"_from_{n}"), F.col("_total").alias(f"_all_{n}")
            )
            found = found.join(F.broadcast(own), [*partition, m.lines], "left")
            names["before"].append(F.col(f"_from_{n}"))
            names["total"].append(F.col(f"_all_{n}"))
        places.append((m, F.coalesce(*names["before"]), F.coalesce(*names["total"])))
    return _with_classes(found, rows.columns, params, places)


def pareto(
    frame: DataFrame,
    params: Params,
    keys: list[str],
    lines: str,
    quantity: str,
    rotation: str,
    share: str,
    cumulative: str | None,
    partition: list[str] | None = None,
) -> DataFrame:
    """The ranking by one measure."""
    return ranked(frame, params, keys, [Measure(lines, quantity, rotation, share, cumulative)], partition)
