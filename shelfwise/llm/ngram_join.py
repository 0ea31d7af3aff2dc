"""Operator 6, n-gram Jaccard join: blocked products of document by n-gram incidence, pruned by bounds on set sizes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import repeats
from shelfwise.llm.common import Scratch, components, few, table
from shelfwise.llm.kernels import FOLD, NOT_SPACE, chained, lean_cogroup, lean_group, mix, pieces, prefix, span_hash, word_spans

#: Words of an n-gram; similarity in hundredths.
WORDS, PERCENT = 5, 80
#: Documents up to which a column of the incidence is multiplied with itself outright.
NARROW = 32
#: Rounds, at most, in which every class meets one pivot, and the side of the blocks of all products.
ROUNDS, SIDE = 4, 512


def ngram_sets(texts: pa.Array | pa.ChunkedArray, n: int = WORDS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, row of each element, hashes): each text's distinct n-grams, ordered by row and hash.

    A text of fewer words is one n-gram of all of them; without words it has none.
    """
    for a, b, data, off in pieces(texts, 1 << 19, 30_000):
        code = FOLD[data]
        start, end, row = word_spans(code, off, NOT_SPACE)
        h = span_hash(prefix(code), start, end)
        rows, grams = [], []
        if len(h) >= n:
            own = np.flatnonzero(row[: len(row) - n + 1] == row[n - 1 :])
            rows.append(row[own])
            grams.append(chained(h, n)[own])
        first, count = np.unique(row, return_index=True)[1], np.bincount(row, minlength=b - a)
        some = count[row[first]] if len(first) else np.zeros(0, int)
        for k in range(1, n):
            at = first[some == k]
            if len(at):
                rows.append(row[at])
                grams.append(mix(chained(h, k)[at] + np.uint64(k)))
        row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        gram = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(row.astype(np.uint64) << np.uint64(48) | gram >> np.uint64(16), kind="stable")
        row, gram = row[order], gram[order]
        keep = np.ones(len(row), dtype=bool)
        keep[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
        yield a, b, row[keep], gram[keep]


def _lists(values: np.ndarray, row: np.ndarray, use: np.ndarray) -> pa.Array:
    """A list a row in use, of that row's values; null for the others."""
    size = np.where(use, np.bincount(row, minlength=len(use)), 0)
    off = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    flat = pa.array(values[use[row]].view(np.int64))
    return pa.ListArray.from_arrays(pa.array(off), flat, mask=pa.array(~use))


def incidence(docs: DataFrame, doc_id: str, text: str, scratch: Scratch, percent: int = PERCENT) -> DataFrame:
    """(doc, n, s1, s2, centre, probe, grams), a row a document: size and digest of its set; how common its n-grams are
    on average; those that other documents have too, and those of them that a partner must share one of. Both are
    null where too few are shared for any partner.

    The order behind `probe` puts rare n-grams first, by the level of their document count over the whole corpus, then
    goes by hash. Of n elements, a partner at
    80 percent shares at least 80 in 100, hence one of the first n - need + 1.
    """
    of_blocks, n_blocks = repeats.blocks(docs, doc_id, text)
    bits = repeats.shared(of_blocks, n_blocks, lambda texts: (g for *_, g in ngram_sets(texts)))

    def mark(group: pa.Table, found: pa.Table) -> pa.Table:
        levels = repeats.read_levels(found)
        u, _ = repeats.distinct(g for *_, g in ngram_sets(group.column("text")))
        out = []
        for a, b, row, gram in ngram_sets(group.column("text")):
            level = levels[np.searchsorted(u, gram)]
            twice = level > 0
            n, dup = np.bincount(row, minlength=b - a), np.bincount(row[twice], minlength=b - a)
            need = -(-percent * n // 100)
            use = (n > 0) & (dup >= need)
            order = np.lexsort((gram[twice], level[twice], row[twice]))
            row2, gram2 = row[twice][order], gram[twice][order]
            centre = np.bincount(row, weights=level, minlength=b - a) / np.maximum(n, 1)
            place = np.arange(len(row2)) - np.searchsorted(row2, np.arange(b - a))[row2]
            first = place < (n - need + 1 - (n - dup))[row2]
            sums = [np.zeros(b - a, np.uint64) for _ in range(2)]
            for s, x in zip(sums, (gram, mix(gram + np.uint64(1))), strict=True):
                np.add.at(s, row, x)
            doc = group.column("doc").slice(a, b - a).combine_chunks()
            doc = doc if isinstance(doc, pa.Array) else pa.concat_arrays(doc.chunks)
            out.append(
                pa.table(
                    {"doc": doc, "n": pa.array(n.astype(np.int64)), "s1": pa.array(sums[0].view(np.int64)), "s2": pa.array(sums[1].view(np.int64))}
                    | {"centre": pa.array(centre), "probe": _lists(gram2[first], row2[first], use), "grams": _lists(gram2, row2, use)}
                )
            )
        return pa.concat_tables(out)

    schema = "doc long, n long, s1 long, s2 long, centre double, probe array<long>, grams array<long>"
    joined = of_blocks.groupBy("block").cogroup(bits.groupBy("block"))
    return scratch.put(joined.applyInArrow(lean_cogroup(mark), schema))


def _overlaps(lists: pa.Table, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(overlap, size of a, size of b) of pairs of classes: rows of their n-grams (rep, n, grams), multiplied.

    The incidence of the block is held as sorted cells of class and n-gram. For each pair the smaller class's cells
    are looked up among the other's, and what is found is added up, some million cells at a time.
    """
    rep, n = lists.column("rep").to_numpy(), lists.column("n").to_numpy()
    grams = lists.column("grams").combine_chunks()
    grams = grams if isinstance(grams, pa.Array) else pa.concat_arrays(grams.chunks)
    size = np.diff(grams.offsets.to_numpy())
    order = np.argsort(rep)
    a, b = order[np.searchsorted(rep[order], a)], order[np.searchsorted(rep[order], b)]
    _, token = np.unique(grams.flatten().to_numpy(), return_inverse=True)
    width = int(token.max()) + 1 if len(token) else 1
    cells = np.sort(np.repeat(np.arange(len(rep)), size) * width + token)
    start = np.cumsum(size) - size
    small, other = np.where(size[a] <= size[b], a, b), np.where(size[a] <= size[b], b, a)
    over, ends, at = np.zeros(len(a), dtype=np.int64), np.cumsum(size[small]), 0
    while at < len(a):
        to = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 2_000_000, "right")), at + 1)
        each = size[small[at:to]]
        pair = np.repeat(np.arange(at, to), each)
        place = start[small[pair]] + np.arange(len(pair)) - np.repeat(np.cumsum(each) - each, each)
        wanted = cells[place] % width + other[pair] * width
        found = np.searchsorted(cells, wanted)
        over += np.bincount(pair[cells[np.minimum(found, len(cells) - 1)] == wanted], minlength=len(a))
        at = to
    return over, n[a], n[b]


def _verified(pairs: DataFrame, sets: DataFrame, percent: int, scratch: Scratch, by: str = "a") -> DataFrame:
    """Of `pairs` (a, b), those whose sets are similar: the product of the incidence with itself at those places.

    Pairs are dealt to blocks of about SIDE by the class in column `by`, which is cut where it has more partners; a
    block gets each of its classes' n-grams once and adds up all overlaps.
    """
    other = "b" if by == "a" else "a"
    degree = pairs.groupBy(by).agg(F.count("*").alias("degree"))
    total = F.lit(max(1, -(-pairs.count() // SIDE)))
    salt = F.pmod(F.xxhash64(other), F.ceil(F.col("degree") / SIDE))
    dealt = scratch.put(pairs.join(degree, by).select("a", "b", F.xxhash64(F.pmod(F.xxhash64(by), total), salt).alias("block")))
    ends = dealt.select(F.col("block").alias("lot"), F.explode(F.array("a", "b")).alias("rep")).distinct()
    lists = ends.join(sets.select("rep", "n", "grams"), "rep")

    def multiply(pairs: pa.Table, lists: pa.Table) -> pa.Table:
        a, b = pairs.column("a").to_numpy(), pairs.column("b").to_numpy()
        if not len(a):
            return pa.table({"a": a, "b": b})
        over, n, m = _overlaps(lists, a, b)
        link = 100 * over >= percent * (n + m - over)
        return pa.table({"a": a[link], "b": b[link]})

    return dealt.groupBy("block").cogroup(lists.groupBy("lot")).applyInArrow(lean_cogroup(multiply), "a long, b long")


def _mixed(cells: DataFrame, found: DataFrame) -> DataFrame:
    """The cells of columns that hold more than one component, with the component `c`."""
    placed = cells.join(found.withColumnRenamed("id", "rep"), "rep", "left").withColumn("c", F.coalesce("component", "rep")).drop("component")
    return placed.join(placed.groupBy("gram").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("gram"), "gram")


def _merged(found: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """Components after further links. Those so far are the nodes; a root is not among the ids of `found`."""
    if links.isEmpty():
        return found
    root = lambda x: found.select(F.col("id").alias(x), F.col("component").alias(f"c{x}"))
    over = links.join(root("a"), "a", "left").join(root("b"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    merged = scratch.put(components(over, scratch))
    to = merged.select(F.col("id").alias("component"), F.col("component").alias("to"))
    moved = found.join(to, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    return scratch.put(moved.unionByName(merged))


def _products(cells: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): edges that connect what is linked, from products of blocks of columns.

    Of each column the classes outside its largest component are multiplied with all of it, in blocks of SIDE by SIDE,
    whose links leave the task as one edge a class to the smallest class connected within the block.
    """
    largest = cells.groupBy("gram", "c").count().groupBy("gram").agg(F.max(F.struct("count", "c")).alias("l"), F.sum("count").alias("all"))
    sides = largest.select("gram", "l.c", F.ceil((F.col("all") - F.col("l.count")) / SIDE).alias("rows"), F.ceil(F.col("all") / SIDE).alias("columns"))
    there = cells.select("gram", "rep", F.col("c").alias("own")).join(sides, "gram")
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    row, column = F.pmod(F.xxhash64("rep"), F.col("rows")), F.pmod(F.xxhash64("rep", F.lit(1)), F.col("columns"))
    left = there.where("own <> c").select("gram", "rep", row.alias("i"), upto("columns").alias("j"), F.lit(True).alias("is_row"))
    right = there.select("gram", "rep", upto("rows").alias("i"), column.alias("j"), F.lit(False).alias("is_row"))

    def multiply(group: pa.Table) -> pa.Table:
        rep, n = group.column("rep").to_numpy(), group.column("n").to_numpy()
        is_row = group.column("is_row").to_numpy(zero_copy_only=False).astype(bool)
        lists = group.column("grams").to_pylist()
        owner = np.repeat(np.arange(len(rep)), [len(x) for x in lists])
        _, token, count = np.unique(np.concatenate([np.array(x, dtype=np.int64) for x in lists]), return_inverse=True, return_counts=True)
        owner, token = owner[count[token] > 1], (np.cumsum(count > 1) - 1)[token[count[token] > 1]]
        order = np.argsort(token, kind="stable")
        owner, token = owner[order], token[order]
        over = np.zeros((int(is_row.sum()), int((~is_row).sum())), dtype=np.float32)
        for at in range(0, int(token[-1]) + 1 if len(token) else 0, 4096):
            x, y = np.searchsorted(token, [at, at + 4096])
            part = np.zeros((len(rep), 4096), dtype=np.float32)
            part[owner[x:y], token[x:y] - at] = 1
            over += part[is_row] @ part[~is_row].T
        over = over.astype(np.float64)
        link = 100 * over >= percent * (n[is_row][:, None] + n[~is_row] - over)
        far = np.iinfo(np.int64).max
        rows, columns, before = rep[is_row].copy(), rep[~is_row].copy(), None
        while before is None or (rows != before).any():
            before = rows.copy()
            columns = np.minimum(columns, np.where(link, rows[:, None], far).min(axis=0, initial=far))
            rows = np.minimum(rows, np.where(link, columns, far).min(axis=1, initial=far))
        ids, to = np.concatenate([rep[is_row], rep[~is_row]]), np.concatenate([rows, columns])
        return pa.table({"a": ids[ids > to], "b": to[ids > to]})

    blocks = left.unionByName(right).join(sets.select("rep", "n", "grams"), "rep")
    return blocks.groupBy("gram", "i", "j").applyInArrow(lean_group(multiply), "a long, b long").distinct()


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc, n_shingles, component_id), one row a row of `docs`.

    Documents link if their sets of 5-word n-grams have a Jaccard similarity of `percent` hundredths or more; equal
    sets are one class, of which the smallest id stands for all. component_id is the smallest id reachable.

    Null and empty texts, and those of white space, have no n-grams and link with nothing. Rows of one id count as
    one document; a row without id links with nothing and has no component. Other columns are ignored.

    Columns of the incidence (n-grams) with up to NARROW classes are multiplied outright: their pairs of like size open
    a place in the product, where overlaps are added up in blocks. In wider ones, such as a large group of near copies
    has, each class first meets one pivot a round; classes that stay outside the column's largest component are then
    multiplied with all of it, in blocks. Pairs within that component need no comparison, so a group that its pivots
    join costs in proportion to its size.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngrams")
    rows = incidence(docs, doc_id, text, scratch, percent)
    known = rows.where("grams IS NOT NULL AND doc IS NOT NULL")
    classes = scratch.put(known.groupBy("n", "s1", "s2").agg(F.min("doc").alias("rep")))
    # Lists of n-grams stay where they are, as long as the ids that stand for classes are few enough to be sent to them.
    reps = few(classes.select(F.col("rep").alias("doc"), "n", "s1", "s2"))
    sets = scratch.put(known.join(reps, ["doc", "n", "s1", "s2"]).select(F.col("doc").alias("rep"), "n", "centre", "probe", "grams"))
    if sets.count() > classes.count():  # rows of one id
        sets = scratch.put(sets.dropDuplicates(["rep", "n"]))
    cells = sets.select(F.explode("probe").alias("gram"), "rep", "n", "centre")
    width = cells.groupBy("gram").agg(F.count("*").alias("width")).where("width > 1")
    cells = scratch.put(cells.join(width, "gram"))
    near = (F.least("n", "m") * 100 >= F.greatest("n", "m") * percent) & (F.col("a") != F.col("b"))

    narrow = cells.where(F.col("width") <= NARROW)
    left = narrow.select("gram", F.col("rep").alias("a"), "n")
    right = narrow.select("gram", F.col("rep").alias("b"), F.col("n").alias("m"))
    # NARROW bounds what a column makes of each of its classes.
    pairs = scratch.put(left.join(right, "gram").where(near & (F.col("a") < F.col("b"))).select("a", "b").distinct())
    links = scratch.put(_verified(pairs, sets, percent, scratch))

    wide = scratch.put(cells.where(F.col("width") > NARROW).select("gram", "rep", "n", "centre", "width"))
    found = scratch.put(components(links, scratch))
    for turn in range(ROUNDS):
        # Each class meets the middle of one column that it shares with another component: the class whose n-grams are
        # the commonest, which is closest to what a group was copied from. A round has as many rows as classes, at most.
        mixed = scratch.put(_mixed(wide, found))
        pivots = mixed.groupBy("gram").agg(F.max(F.struct("centre", "rep", "n", "c")).alias("p"))
        pivots = pivots.select("gram", F.col("p.rep").alias("b"), F.col("p.n").alias("m"), F.col("p.c").alias("cb"))
        order = F.struct("width" if turn % 2 == 0 else -F.col("width"), F.xxhash64("gram", F.lit(turn)), "gram", "n", "c")
        one = mixed.groupBy(F.col("rep").alias("a")).agg(F.min(order).alias("x")).select("a", "x.gram", "x.n", "x.c")
        star = scratch.put(one.join(pivots, "gram").where(near & (F.col("c") != F.col("cb"))).select("a", "b").distinct())
        new = scratch.put(_verified(star, sets, percent, scratch, "b"))
        if new.isEmpty():
            break
        found = _merged(found, new, scratch)
    if not wide.isEmpty():
        # What the pivots left apart is multiplied with its whole columns, block by block.
        found = _merged(found, scratch.put(_products(scratch.put(_mixed(wide, found)), sets, percent)), scratch)

    member = known.join(classes, ["n", "s1", "s2"]).select("doc", "rep").join(found.withColumnRenamed("id", "rep"), "rep", "left")
    member = member.groupBy("doc").agg(F.min(F.coalesce("component", "rep")).alias("c"))
    return rows.select("doc", F.col("n").alias("n_shingles")).join(member, "doc", "left").select("doc", "n_shingles", F.coalesce("c", "doc").alias("component_id"))


def query(spark, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents")).withColumnRenamed("doc", "doc_id")
