"""Operator 2, embedding near-dedup: NN-descent over vectors of equal label, links from a cosine threshold on."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.llm.common import Scratch, components, table

THRESHOLD = 0.93
#: Length of a neighbour list; rows of a starting block, and of a block of vectors with full lists.
LIST, BLOCK, SIDE = 8, 256, 512
#: Rounds of refinement; share of changed entries below which it ends; descents.
ROUNDS, STILL, ATTEMPTS = 5, 0.002, 2
#: The audit of a label draws about so many vectors with links, and as many without, and at least this share of either.
AUDIT, SHARE = 300, 1 / 16
#: Rows that meet in one task's call, about; meetings that are multiplied at a time.
MET, AT_ONCE = 16_384, 512


def _unit(group: pa.Table, column: str = "vec") -> np.ndarray:
    flat = group.column(column).combine_chunks()
    flat = flat if isinstance(flat, pa.Array) else pa.concat_arrays(flat.chunks)
    x = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _best(ids: np.ndarray, near: np.ndarray, k: int) -> pa.Table:
    """Of each row's others the k nearest."""
    near = near.copy()
    np.fill_diagonal(near, -2)
    k = min(k, len(ids) - 1)
    if k < 1:
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "s": pa.array([], pa.float64())})
    top = np.argpartition(-near, k - 1, axis=1)[:, :k]
    s = np.take_along_axis(near, top, axis=1)
    i, j = np.nonzero(s > -2)
    return pa.table({"a": ids[i], "b": ids[top[i, j]], "s": s[i, j]})


def _best_of_meetings(group: pa.Table) -> pa.Table:
    """The same for every meeting `a` of the group, padded to the largest, which has no more than 2 * LIST rows."""
    order = np.argsort(group.column("a").to_numpy(), kind="stable")
    a, ids, worst = (group.column(c).to_numpy()[order] for c in ("a", "id", "worst"))
    x = _unit(group)[order]
    first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    size = np.diff(np.append(first, len(a)))
    meeting, place, wide = np.repeat(np.arange(len(first)), size), np.arange(len(a)) - np.repeat(first, size), int(size.max())
    k, out = min(LIST, wide - 1), []
    for f in range(0, len(first) if k > 0 else 0, AT_ONCE):
        use = slice(*np.searchsorted(meeting, [f, f + AT_ONCE]))
        at, shape = (meeting[use] - f, place[use]), (min(AT_ONCE, len(first) - f), wide)
        vec, own, limit, there = np.zeros((*shape, x.shape[1])), np.zeros(shape, np.int64), np.zeros(shape), np.zeros(shape, bool)
        vec[at], own[at], limit[at], there[at] = x[use], ids[use], worst[use], True
        near = np.where(there[:, None, :] & ~np.eye(wide, dtype=bool), vec @ vec.transpose(0, 2, 1), -2)
        top = np.argpartition(-near, k - 1, axis=2)[:, :, :k]
        s = np.take_along_axis(near, top, axis=2)
        m, i, j = np.nonzero((s > limit[:, :, None]) & there[:, :, None])
        out.append((own[m, i], own[m, top[m, i, j]], s[m, i, j]))
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    return pa.table(dict(zip("abs", (np.concatenate(c) for c in zip(none, *out, strict=True)), strict=True)))


def _kept(edges: DataFrame) -> DataFrame:
    """The LIST nearest of each vector; ties go to the smaller id."""
    ordered = Window.partitionBy("a").orderBy(F.desc("s"), "b")
    return edges.groupBy("a", "b").agg(F.max("s").alias("s"), F.min("fresh").alias("fresh")).withColumn("place", F.row_number().over(ordered)).where(F.col("place") <= LIST)


class Graph:
    def __init__(self, vectors: DataFrame, scratch: Scratch, seed: int, threshold: float):
        """vectors: id, space (those compared with each other), vec."""
        self.vectors, self.scratch, self.threshold, self.round = vectors, scratch, threshold, 0
        self.total = vectors.count()
        self.edges = scratch.put(self._start(seed))

    def _start(self, seed: int) -> DataFrame:
        """Blocks of vectors on the same side of random planes, several times over; each gives its vectors' nearest.

        Planes are as many as leave about BLOCK vectors together, and repeated until a pair at the threshold has met
        with 99 percent. A large set on one side of all planes is dealt to blocks at random.
        """
        largest = self.vectors.groupBy("space").count().agg(F.max("count")).first()[0] or 0
        planes = max(0, int(np.ceil(np.log2(max(largest, 1) / (BLOCK / 2)))))
        together = (1 - np.arccos(self.threshold) / np.pi) ** planes
        times = 2 if planes == 0 else int(np.ceil(np.log(0.01) / np.log(1 - together)))

        def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                dims = [len(v) for v in batch.column(2)]
                for d in sorted(set(dims)):
                    some = batch.filter(pa.array(np.array(dims) == d))
                    x = _unit(pa.Table.from_batches([some]))
                    for t in range(times):
                        r = np.random.default_rng([seed, d, t]).standard_normal((d, max(planes, 1)))
                        code = ((x @ r > 0) << np.arange(max(planes, 1))).sum(axis=1) if planes else np.zeros(len(x), np.int64)
                        yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array([t] * len(x), pa.int32()), pa.array(code.astype(np.int64))], names=["id", "space", "t", "code"])

        dealt = self.vectors.select("id", "space", "vec").mapInArrow(sides, "id long, space long, t int, code long")
        dealt = self.scratch.put(dealt)
        size = dealt.groupBy("space", "t", "code").agg(F.count("*").alias("n"))
        salt = F.pmod(F.xxhash64("id", "t", F.lit(seed)), F.ceil(F.col("n") / BLOCK))
        dealt = dealt.join(size, ["space", "t", "code"]).select("id", F.xxhash64("space", "t", "code", salt).alias("block"))

        def nearest(group: pa.Table) -> pa.Table:
            x = _unit(group)
            return _best(group.column("id").to_numpy(), x @ x.T, LIST)

        found = dealt.join(self.vectors, "id").select("block", "id", "vec").groupBy("block").applyInArrow(nearest, "a long, b long, s double")
        return _kept(found.withColumn("fresh", F.lit(True)))

    def refine(self) -> int:
        """One round: each vector's neighbours, in both directions, are compared with one another; the entries changed."""
        both = self.edges.select("a", "b", "fresh").unionByName(self.edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "fresh"))
        # A vector may be near to very many: of those that list it, as many meet as of those that it lists, others each round.
        self.round += 1
        turn = F.lit(self.round)
        drawn = Window.partitionBy("a", "cell").orderBy(F.xxhash64("a", "b", turn))
        both = both.groupBy("a", "b").agg(F.max("fresh").alias("fresh"))
        few = both.withColumn("cell", F.pmod(F.xxhash64("b", turn), F.lit(2 * LIST))).withColumn("n", F.row_number().over(drawn)).where("n = 1")
        stirred = few.where("fresh").select("a").distinct()
        worst = self.edges.groupBy("a").agg(F.when(F.count("*") >= LIST, F.min("s")).otherwise(F.lit(-2.0)).alias("worst"))
        meeting = few.join(stirred, "a").select("a", F.col("b").alias("id")).join(self.vectors.select("id", "vec"), "id")
        meeting = meeting.join(worst.withColumnRenamed("a", "id"), "id")
        # Meetings go to tasks many at a time: a call for each would cost more than its products.
        buckets = F.pmod(F.xxhash64("a", F.lit("meeting")), F.lit(self.total * 2 * LIST // MET + 1))
        meeting = meeting.select("a", "id", "vec", "worst", buckets.alias("bucket"), F.size("vec").alias("dim"))
        found = meeting.groupBy("bucket", "dim").applyInArrow(_best_of_meetings, "a long, b long, s double")
        old = self.edges.select("a", "b", "s", F.lit(False).alias("fresh"))
        new = self.scratch.put(_kept(old.unionByName(found.withColumn("fresh", F.lit(True)))))
        self.scratch.drop(self.edges)
        self.edges = new
        return new.where("fresh").count()


def _compared(rows: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """(id, n, low): `rows` (id) compared with all vectors of their space, in blocks of SIDE by SIDE.

    n sums up, over the blocks, to all links of those in `rows` and, of the others, to their links with those in `rows`,
    copies of the other end included. low is the smallest id that id is joined with inside the block, so that the pairs
    (id, low) have the components of the links, with at most one pair a vector and block.
    """
    there = vectors.join(rows.select("id").withColumn("is_row", F.lit(True)), "id", "left").withColumn("is_row", F.coalesce("is_row", F.lit(False)))
    sides = there.groupBy("space").agg(F.ceil(F.count(F.when(F.col("is_row"), 1)) / SIDE).alias("rows"), F.ceil(F.count("*") / SIDE).alias("columns"))
    there = there.join(sides.where("rows > 0"), "space")
    row = F.pmod(F.xxhash64("id"), F.col("rows"))
    column = F.pmod(F.xxhash64("id", F.lit(1)), F.col("columns"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = there.where("is_row").select("space", "id", "vec", "weight", "is_row", row.alias("i"), every("columns").alias("j"), F.lit(True).alias("left"))
    right = there.select("space", "id", "vec", "weight", "is_row", every("rows").alias("i"), column.alias("j"), F.lit(False).alias("left"))

    def compare(group: pa.Table) -> pa.Table:
        side = group.column("left").to_numpy(zero_copy_only=False).astype(bool)
        x, ids, weight = _unit(group), group.column("id").to_numpy(), group.column("weight").to_numpy()
        own = group.column("is_row").to_numpy(zero_copy_only=False).astype(bool)[~side]
        a, b = ids[side], ids[~side]
        met = (x[side] @ x[~side].T >= threshold) & (a[:, None] != b)
        used, seen = met.any(axis=1), met.any(axis=0)
        met, a, b, own = met[used][:, seen], a[used], b[seen], own[seen]
        # Those in `rows` that are columns here are rows of other blocks, and counted there.
        n = [met @ weight[~side][seen], np.where(own, 0, weight[side][used] @ met)]
        low_a, low_b = a, b
        while len(a):
            far = np.iinfo(np.int64).max
            next_b = np.minimum(low_b, np.where(met, low_a[:, None], far).min(axis=0))
            next_a = np.minimum(low_a, np.where(met, next_b, far).min(axis=1))
            if (next_a == low_a).all() and (next_b == low_b).all():
                break
            low_a, low_b = next_a, next_b
        return pa.table({"id": np.concatenate([a, b]), "n": np.concatenate(n).astype(np.int64), "low": np.concatenate([low_a, low_b])})

    return left.unionByName(right).groupBy("space", "i", "j").applyInArrow(compare, "id long, n long, low long")


def link(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row a row of `rows`.

    Vectors of equal label and length link from a cosine of `threshold` on, in double precision. Null, empty and zero
    vectors, those with a null or non-finite component, rows without label and rows without id link with nothing.
    Equal vectors of a label are one node, which stands for all of them. Rows of one id are one vector, which does not
    link with itself; if they differ, the one with the smallest hash counts, for all of them. Other columns are ignored.

    Lists of the LIST nearest start from random blocks and are refined through neighbours of neighbours until few
    change. A vector whose list is full of links is compared with all of its label, in blocks. Each label has its own
    audit, which compares a sample of the others with all: if one of them lacks a link, the descent starts again for that
    label, from other blocks, and adds its links, and after ATTEMPTS all of the label's vectors are compared with all.
    The sample is SHARE of the label at least: of m vectors that lack a link, none is drawn with (1 - SHARE) ** m.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "vectors")
    given = rows.select(F.col(vec_id).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<float>").alias("vec"))
    finite = ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fit = given.where("id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL").where(finite & F.exists("vec", lambda x: x != 0))
    clean = F.transform("vec", lambda x: F.when(x == 0, F.lit(0.0).cast("float")).otherwise(x))
    fit = fit.select("id", F.xxhash64("label", F.size("vec")).alias("space"), clean.alias("vec"))
    fit = fit.withColumn("h", F.xxhash64("vec")).groupBy("id").agg(F.min(F.struct("space", "h", "vec")).alias("v"))
    named = scratch.put(fit.select("id", "v.space", "v.vec", "v.h"))
    vectors = scratch.put(named.groupBy("space", "h", "vec").agg(F.min("id").alias("rep"), F.count("*").alias("weight")))
    member = named.join(vectors.withColumnRenamed("vec", "v"), ["space", "h"]).where(F.col("vec") == F.col("v")).select("id", "rep", "weight")
    vectors = vectors.select(F.col("rep").alias("id"), "space", "vec", "weight")
    near, result, found, left = None, None, None, vectors
    for attempt in range(ATTEMPTS):
        graph = Graph(left, scratch, attempt, threshold)
        for _ in range(ROUNDS):
            if graph.refine() <= STILL * graph.total * LIST:
                break
        listed = graph.edges.where(F.col("s") >= threshold).select("a", "b")
        near = scratch.put(listed if near is None else listed.unionByName(near).distinct())
        full = scratch.put(near.groupBy(F.col("a").alias("id")).count().where(F.col("count") >= LIST).select("id"))
        result, found = _joined(near, full, vectors, threshold, scratch)
        lossy = scratch.put(_lossy(result, full, left, threshold, attempt))
        if lossy.isEmpty():
            break
        left = scratch.put(left.join(lossy, "space", "left_semi").select("id", "space", "vec", "weight"))
    else:
        full = scratch.put(full.unionByName(left.select("id")).distinct())
        result, found = _joined(near, full, vectors, threshold, scratch)

    of = member.join(result, member["rep"] == result["rid"], "left")
    of = of.join(found, of["rep"] == found["id"], "left").select(member["id"].alias("of"), (F.coalesce("n", F.lit(0)) + F.when(F.col("n").isNull(), F.col("weight") - 1).otherwise(0)).alias("n"), F.coalesce("component", "rep").alias("c"))
    of = of.groupBy("of").agg(F.max("n").alias("n"), F.min("c").alias("c"))
    out = given.select("id").join(of, F.col("id") == F.col("of"), "left")
    component = F.coalesce("c", "id")
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def _joined(near: DataFrame, full: DataFrame, vectors: DataFrame, threshold: float, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(rid, n), links of each linked vector, its copies included; (id, component) of the linked.

    `near` (a, b) are the entries of the lists that are links. Those in `full` (id) may have more links than their
    lists hold, with one another too: they are compared with all. Links between others are in the list of either end.
    """
    met = scratch.put(_compared(full, vectors, threshold))
    both = near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    loose = both.join(full, both["a"] == full["id"], "left_anti")
    loose = loose.join(full, loose["b"] == full["id"], "left_anti")
    weight = vectors.select("id", "weight")
    one = loose.join(weight.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.sum("weight").alias("n"))
    n = one.unionByName(met.select("id", "n")).groupBy("id").agg(F.sum("n").alias("n"))
    n = n.join(weight, "id").select(F.col("id").alias("rid"), (F.col("n") + F.col("weight") - 1).alias("n"))
    links = loose.unionByName(met.select(F.col("id").alias("a"), F.col("low").alias("b"))).where("a <> b")
    return scratch.put(n), scratch.put(components(links, scratch))


def _lossy(result: DataFrame, full: DataFrame, vectors: DataFrame, threshold: float, attempt: int) -> DataFrame:
    """(space) of audited vectors that lack a link. Those in `full` have all of theirs; of the others of a space a sample
    with links and one without are compared with the whole space, each vector counting as one whatever its links."""
    rest = vectors.join(full, "id", "left_anti").join(result.withColumnRenamed("rid", "id"), "id", "left")
    rest = rest.select("id", "space", F.coalesce(F.col("n") - F.col("weight") + 1, F.lit(0)).alias("found"))
    rest = rest.withColumn("linked", F.col("found") > 0)
    rate = rest.groupBy("space", "linked").agg(F.greatest(F.lit(AUDIT) / F.count("*"), F.lit(SHARE)).alias("rate"))
    draw = F.xxhash64("id", F.lit("audit"), F.lit(attempt)) / F.lit(2.0**64) + 0.5
    sample = rest.join(rate, ["space", "linked"]).where(draw < F.col("rate")).select("id", "space", "found")
    whole = _compared(sample.select("id"), vectors, threshold).groupBy("id").agg(F.sum("n").alias("whole"))
    return sample.join(whole, "id").where("whole > found").select("space").distinct()


def query(spark, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "embeddings"))
