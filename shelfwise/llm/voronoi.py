"""Operator 11, exact top-k search: a Voronoi join of queries and data by inner product of integer vectors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.llm.common import table

#: Results of a query; factor before rounding down.
TOP, SCALE = 20, 64
#: Pivots at most (a sample of the data, held by every task), and groups of queries at most.
PIVOTS, GROUPS = 512, 64
#: Queries and data rows that meet in one task, on average.
QUERIES, PIECE = 2048, 8192
#: Vectors up to this norm have scores that doubles hold exactly and that leave room for a tie-break in 64 bits.
EXACT = 2.0**22
_LONG = np.iinfo(np.int64)


def _batches(batch: pa.RecordBatch, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, whether queries, integer vectors as doubles) of the rows of a batch, one length of vectors at a time."""
    vec = batch.column(1)
    sizes = np.diff(np.frombuffer(vec.buffers()[1], np.int32)[vec.offset : vec.offset + len(vec) + 1])
    for size in np.unique(sizes).tolist():
        some = batch.filter(pa.array(sizes == size))
        with np.errstate(over="ignore"):
            x = np.floor(scale * some.column(1).flatten().to_numpy(zero_copy_only=False).reshape(some.num_rows, size)) + 0.0
        fit = np.isfinite(x).all(axis=1)
        yield some.column(0).to_numpy()[fit], some.column(2).to_numpy(zero_copy_only=False)[fit], x[fit]


def _norm(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.sqrt((x * x).sum(axis=1))


def _product(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products; a shorter vector counts as followed by zeros."""
    n = min(x.shape[1], y.shape[1])
    return x[:, :n] @ y[:, :n].T


@dataclass
class Pivots:
    """Points of the data that cells form around, and groups of cells: a cell is in the group of its nearest of the first pivots."""

    ids: np.ndarray
    at: np.ndarray
    group: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, at: np.ndarray, groups: int) -> Pivots:
        own = cls(ids, at, np.zeros(len(ids), dtype=np.int64))
        own.group = own.near(at, slice(0, groups))[0]
        return own

    def near(self, x: np.ndarray, among: slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each vector and its distance from the pivot. Squares and products are exact integers here."""
        p = self.at[among]
        square = (x * x).sum(axis=1)[:, None] + (p * p).sum(axis=1) - 2 * _product(x, p)
        cell = square.argmin(axis=1) if len(p) else np.zeros(len(x), np.int64)
        return cell, np.sqrt(np.maximum(square[np.arange(len(x)), cell], 0)) if len(p) else np.zeros(len(x))

    def reach(self, ids: np.ndarray, q: np.ndarray, k: int) -> np.ndarray:
        """For each query and cell, the distance from the pivot below which no vector of the cell is among the k best.

        The k-th best pivot bounds a query's k-th score from below; a vector of the cell at distance r scores at most
        |q| r more than the pivot.
        """
        score = _product(q, self.at)
        other = np.where(ids[:, None] == self.ids, -np.inf, score)
        least = np.partition(other, -k, axis=1)[:, -k] if len(self.ids) >= k else np.full(len(q), -np.inf)
        size = np.sqrt((q * q).sum(axis=1))
        out = (least[:, None] - score) / np.maximum(size, 1e-300)[:, None]
        out = np.where(size[:, None] > 0, out, -np.inf)
        return out - 1e-6 * (1 + np.abs(np.where(np.isfinite(out), out, 0)))


def _unlike(ids: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in order of their id; rows alike in id and vector once."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    again = np.concatenate([[False], ids[1:] == ids[:-1]])
    if again.any():
        keep, seen, was = np.ones(len(ids), dtype=bool), set(), None
        for i in np.flatnonzero(again | np.concatenate([again[1:], [False]])):
            if ids[i] != was:
                seen, was = set(), ids[i]
            keep[i] = (one := x[i].tobytes()) not in seen
            seen.add(one)
        ids, x = ids[keep], x[keep]
    return ids, x


def _best(qid: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(place of the query, id, score): of each query its k best in x, whose rows are in order of their ids."""
    n = len(ids)
    for at in range(0, len(q) if n else 0, 256):
        own = slice(at, at + 256)
        score = _product(q[own], x).astype(np.int64)
        # Of equal scores the smaller id comes first; the query's own rows are out.
        key = score * n + (n - 1 - np.arange(n))
        low, high = np.searchsorted(ids, qid[own], "left"), np.searchsorted(ids, qid[own], "right")
        for i in np.flatnonzero(high > low):
            key[i, low[i] : high[i]] = -_LONG.max
        top = np.argpartition(-key, min(k, n) - 1, axis=1)[:, :k] if n > k else np.broadcast_to(np.arange(n), key.shape)
        use = np.take_along_axis(key, top, axis=1) > -_LONG.max
        i, j = np.nonzero(use)
        j = top[i, j]
        yield i + at, ids[j], score[i, j]


def _large(qid: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The same for vectors whose products doubles do not hold: in whole numbers of any size, cut to 64 bits at the end."""
    whole = [[int(v) for v in row] for row in x]
    for i, row in enumerate(q):
        own = [int(v) for v in row]
        score = [min(max(sum(a * b for a, b in zip(own, other, strict=False)), _LONG.min), _LONG.max) for other in whole]
        best = sorted((-s, d) for s, d in zip(score, ids.tolist(), strict=True) if d != qid[i])[:k]
        yield np.full(len(best), i), np.array([d for _, d in best], dtype=np.int64), np.array([-s for s, _ in best], dtype=np.int64)


def _solve(group: pa.Table, k: int) -> pa.Table:
    """The k best of a group's data rows for each of its queries."""
    side = group.column("is_query").to_numpy(zero_copy_only=False).astype(bool)
    ids, raw = group.column("id").to_numpy(), group.column("ints").combine_chunks()
    sizes = np.array([len(v) // 8 for v in raw.to_pylist()], dtype=np.int64)

    def rows(of: bool) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids and vectors, one length of vectors at a time."""
        out = []
        for size in np.unique(sizes[side == of]).tolist():
            own = (side == of) & (sizes == size)
            vectors = b"".join(raw.filter(pa.array(own)).to_pylist())
            out.append(_unlike(ids[own], np.frombuffer(vectors, np.float64).reshape(int(own.sum()), size)))
        return out

    found: list[tuple[np.ndarray, ...]] = []
    data = rows(False)
    for qid, q in rows(True):
        name = np.array([int.from_bytes(hashlib.blake2b(v.tobytes(), digest_size=8).digest(), "little", signed=True) for v in q], dtype=np.int64)
        far = _norm(q) >= EXACT
        for xid, x in data:
            large = _norm(x) >= EXACT
            for of_q, of_x, method in ((~far, ~large, _best), (~far, large, _large), (far, np.ones(len(x), bool), _large)):
                if of_q.any() and of_x.any():
                    found += [(qid[of_q][i], name[of_q][i], d, s) for i, d, s in method(qid[of_q], q[of_q], xid[of_x], x[of_x], k)]
    columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 4
    return pa.table(dict(zip(("query_id", "name", "vec_id", "score"), columns, strict=True)))


def top_k(rows: DataFrame, queries: Column, k: int = TOP, vec_id: str = "vec_id", vector: str = "embedding", scale: float = SCALE, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score): of every row where `queries` holds, the k rows with the largest inner product.

    Vectors are rounded down to whole numbers after multiplication by `scale`. Candidates of a query are all rows of
    other ids; of equal scores the smaller id is first. Rows alike in id and whole numbers count once, as query and as
    candidate; rows of one id with unlike vectors are several candidates, and several queries, each with its own ranks.
    Null vectors, those with a null or non-finite component (also after scaling), and rows without id take no part.
    A shorter vector counts as followed by zeros, an empty one scores 0. A score beyond 64 bits is cut to them. An
    empty table gives no rows. Extra columns are ignored.

    Up to `pivots` rows, drawn by hash, are the centres of Voronoi cells. Summaries of cells and of groups of queries
    (tables of at most GROUPS by `pivots` numbers) say from which distance to its pivot on a row can be among the k best
    of any query of a group, and only such rows are sent to it. Groups are cut into blocks by hash, so that neither a
    very common vector nor a large cell is work for one task: each block of queries meets each piece of the group's data.
    """
    spark = rows.sparkSession
    # Rows of a null condition are no queries.
    given = rows.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec"), F.coalesce(queries, F.lit(False)).alias("is_query"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    given = given.where("id IS NOT NULL AND vec IS NOT NULL").where(~bad)

    # Vectors of ordinary length only: bounds need exact squares.
    ordinary = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x) < (EXACT / scale / 2) ** 2
    drawn = given.where(ordinary & (F.size("vec") > 0)).orderBy(F.xxhash64("id", "vec"), "id").limit(pivots).collect()
    drawn = list({r["id"]: r for r in drawn}.values())
    at = np.zeros((len(drawn), max((len(r["vec"]) for r in drawn), default=0)))
    for line, r in zip(at, drawn, strict=True):
        line[: len(r["vec"])] = np.floor(scale * np.array(r["vec"]))
    some = int(given.where("is_query").count())
    centres = Pivots.of(np.array([r["id"] for r in drawn], dtype=np.int64), at, max(1, min(GROUPS, -(-some // QUERIES), len(drawn))))
    n_groups = int(centres.group.max()) + 1 if len(drawn) else 1

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of the task's rows: those of each cell (group -1), the queries of each group (cell -1), and how near to a
        pivot a row is out of reach for all of a group's queries."""
        cells, members = np.zeros(len(centres.ids) + 1, np.int64), np.zeros(n_groups, np.int64)
        reach = np.full((n_groups, len(centres.ids)), np.inf)
        for batch in batches:
            for ids, is_query, x in _batches(batch, scale):
                near = _norm(x) < EXACT
                cell, _ = centres.near(x[near])
                cells[: len(centres.ids)] += np.bincount(cell, minlength=len(centres.ids))[: len(centres.ids)]
                cells[-1] += (~near).sum()
                g = _group(centres, x, near)
                members += np.bincount(g[is_query], minlength=n_groups)
                own = near & is_query
                np.minimum.at(reach, g[own], centres.reach(ids[own], x[own], k))
                reach[g[is_query & ~near]] = -np.inf
        of, cell = np.nonzero(reach < np.inf)
        g = np.concatenate([np.full(len(cells), -1), np.arange(n_groups), of])
        c = np.concatenate([np.arange(len(cells)), np.full(n_groups, -1), cell])
        n = np.concatenate([cells, members, np.zeros(len(of), np.int64)])
        r = np.concatenate([np.full(len(cells) + n_groups, np.inf), reach[of, cell]])
        yield pa.RecordBatch.from_arrays([pa.array(g, pa.int32()), pa.array(c, pa.int32()), pa.array(n), pa.array(r)], names=["g", "c", "n", "r"])

    said = given.mapInArrow(summarise, "g int, c int, n long, r double").groupBy("g", "c").agg(F.sum("n").alias("n"), F.min("r").alias("r")).collect()
    cells, members = np.zeros(len(drawn) + 1, np.int64), np.zeros(n_groups, np.int64)
    reach = np.full((n_groups, len(drawn)), np.inf)
    for g, c, n, r in said:
        if g < 0:
            cells[c if c < len(drawn) else -1] = n
        elif c < 0:
            members[g] = n
        else:
            reach[g, c] = r
    blocks = -(-members // QUERIES)
    # A row may be in reach only of cells that the summaries do not rule out whole; rows without cell always are.
    pieces = np.maximum(1, -(-((reach < np.inf) @ cells[:-1] + cells[-1]) // PIECE))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, is_query, x in _batches(batch, scale):
                near = _norm(x) < EXACT
                cell, far = np.zeros(len(x), np.int64), np.full(len(x), np.inf)
                cell[near], far[near] = centres.near(x[near])
                g = _group(centres, x, near)
                vectors = np.array([v.tobytes() for v in x] + [b""], dtype=object)[:-1]
                spread = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                for k_group in range(n_groups):
                    a, b = (spread % np.uint64(max(n, 1)) for n in (blocks[k_group], pieces[k_group]))
                    need = np.flatnonzero(far >= (reach[k_group][cell] if len(drawn) else -np.inf))
                    for block in range(blocks[k_group]):
                        yield _sent(k_group, np.full(len(need), block), b[need], False, ids[need], vectors[need])
                    ask = np.flatnonzero(is_query & (g == k_group))
                    for piece in range(pieces[k_group]) if len(ask) else ():
                        yield _sent(k_group, a[ask], np.full(len(ask), piece), True, ids[ask], vectors[ask])

    dealt = given.mapInArrow(deal, "g int, a int, b int, is_query boolean, id long, ints binary")
    met = dealt.groupBy("g", "a", "b").applyInArrow(lambda group: _solve(group, k), "query_id long, name long, vec_id long, score long")
    ranked = met.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "name").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _group(centres: Pivots, x: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Group of each vector as a query."""
    out = np.zeros(len(x), dtype=np.int64)
    if len(centres.ids):
        out[near] = centres.group[centres.near(x[near])[0]]
    return out


def _sent(g: int, a: np.ndarray, b: np.ndarray, is_query: bool, ids: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([g] * len(ids), pa.int32()), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array([is_query] * len(ids), pa.bool_()), pa.array(ids), pa.array(vectors, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["g", "a", "b", "is_query", "id", "ints"])


def query(spark, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


SQL = f"""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS ints FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.ints, c.ints), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= {TOP}"""
