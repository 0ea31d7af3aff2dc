"""Operator 13, conversation prefix trie: sorted conversations, and a sparse table over the prefixes that neighbours share."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import Scratch, table
from shelfwise.llm.resampling import crc_sql

#: Bytes of a turn in a key: digest of role and text, and its number of code points.
TURN = 20
#: Distinct conversations of a block, a power of 2; ids of a chunk that is hashed at once.
BLOCK_BITS, CHUNK = 13, 256
#: Conversations of one run start with up to this many turns less one of the run's first.
RUN, HEADS = 100, 6
_SCHEMA = (
    "block long, open boolean, id binary, parent binary, depth long, conv long, parent_conv long, "
    "n_convs long, n_children long, n_leaves long, saved long, ends string"
)


def turns(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turns): of each conversation the turns in order, each as TURN bytes in hexadecimal.

    Turns go by number, null first, equal ones by digest. Null role and text are empty. Rows without id are left out;
    repeated rows are turns each. Texts stay where they are: only digests are shuffled.
    """
    of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.octet_length(of(role)).cast("string"), F.lit(":"), of(role), of(text)).cast("binary"))
    one = F.concat(digest, F.lpad(F.hex(F.length(of(text))), 8, "0"))
    number = F.col(turn).cast("long")
    row = F.struct(number.isNotNull().alias("is"), F.coalesce(number, F.lit(0)).alias("n"), one.alias("turn"))
    given = rows.where(F.col(conv_id).isNotNull()).select(F.col(conv_id).cast("long").alias("conv"), row.alias("row"))
    return given.groupBy("conv").agg(F.sort_array(F.collect_list("row"))["turn"].alias("turns"))


def branched(convs: DataFrame, run: int = RUN, heads: int = HEADS) -> DataFrame:
    """Conversations whose first h turns are those of their run's first conversation (id less id % run), h = crc32(id) % heads.

    All turns of a shorter one, and none if there is no such conversation. A run has at most 2 x run - 1 conversations.
    """
    first = convs.where(F.col("conv") % run == 0).select(F.col("conv").alias("first"), F.slice("turns", 1, heads - 1).alias("head"))
    own = convs.withColumn("h", (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).cast("int")).withColumn("first", F.col("conv") - F.col("conv") % run)
    head = F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return own.join(first, "first", "left").select("conv", F.when(F.size("turns") == 0, head).otherwise(F.concat(head, rest)).alias("turns"))


def _digests(classes: DataFrame) -> DataFrame:
    """(class, ends): SHA-256 of the ids of each class, in order, joined by commas.

    Ids are range-partitioned by class and id, so that a class of any size is chunked by many tasks; one task a class
    then hashes its chunks in order, holding one batch of them at a time.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            name, conv = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = [i for i in range(len(name)) if not i or name[i] != name[i - 1]] + [len(name)]
            cuts = [(a, min(a + CHUNK, z)) for first, z in zip(at, at[1:], strict=False) for a in range(first, z, CHUNK)]
            data = [",".join(map(str, conv[a:z])) for a, z in cuts]
            yield pa.RecordBatch.from_arrays([pa.array([name[a] for a, _ in cuts], pa.binary()), pa.array([conv[a] for a, _ in cuts], pa.int64()), pa.array(data, pa.string())], names=["class", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        was, state = None, None
        row = lambda: pa.RecordBatch.from_arrays([pa.array([was], pa.binary()), pa.array([state.hexdigest()])], names=["class", "ends"])
        for batch in batches:
            for name, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if name == was:
                    state.update(b"," + ids.encode())
                    continue
                if was is not None:
                    yield row()
                was, state = name, hashlib.sha256(ids.encode())
        if was is not None:
            yield row()

    ordered = classes.repartitionByRange("class", "conv").sortWithinPartitions("class", "conv")
    parts = ordered.mapInArrow(chunks, "class binary, first long, ids string")
    return parts.repartition("class").sortWithinPartitions("class", "first").mapInArrow(hashed, "class binary, ends string")


def _neighbours(keys: DataFrame, scratch: Scratch) -> DataFrame:
    """(block, side, at, key, conv, w, ends): sorted keys in blocks, each with the last key before it (side -1) and the next (1)."""
    ordered = keys.repartitionByRange("key").sortWithinPartitions("key")
    staged = scratch.put(ordered.withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    # As many rows as Spark has shuffle partitions.
    parts = sorted((r["part"], r["n"]) for r in staged.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    around = [(p, n, parts[i - 1][0] if i else None, parts[i - 1][1] if i else None, parts[i + 1][0] if i + 1 < len(parts) else None) for i, (p, n) in enumerate(parts)]
    known = staged.sparkSession.createDataFrame(around, "part long, n long, before long, n_before long, after long")
    rows = staged.withColumn("part", part).join(known, "part")
    place = F.col("at") - F.shiftleft("part", 33)
    block = lambda at: F.shiftright(at, BLOCK_BITS)
    size = 1 << BLOCK_BITS
    to_last = F.when(place % size == 0, F.when(place > 0, block(F.col("at")) - 1).otherwise(block(F.shiftleft("before", 33) + F.col("n_before") - 1)))
    to_next = F.when(place == F.col("n") - 1, block(F.shiftleft("after", 33))).when(place % size == size - 1, block(F.col("at")) + 1)
    sent = [F.struct(b.alias("block"), F.lit(s).alias("side")) for b, s in ((block(F.col("at")), 0), (to_last, 1), (to_next, -1))]
    sent = F.filter(F.array(*sent), lambda x: x["block"].isNotNull())
    return rows.select(F.explode(sent).alias("to"), "at", "key", "conv", "w", "ends").select("to.*", "at", "key", "conv", "w", "ends")


def _table(values: np.ndarray) -> list[np.ndarray]:
    """Sparse table: level k has the minimum of every 2 ** k neighbours."""
    out = [values]
    while 2 ** len(out) <= len(values):
        half = 2 ** (len(out) - 1)
        out.append(np.minimum(out[-1][:-half], out[-1][half:]))
    return out


def _extents(levels: list[np.ndarray], at: np.ndarray, depth: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last row that shares `depth` turns with row `at`, by binary search on both sides.

    Level 0 of `levels` has at i what rows i - 1 and i share.
    """
    left, right = at.copy(), at.copy()
    for k in reversed(range(len(levels))):
        step, low = 1 << k, levels[k]
        ok = left >= step
        ok[ok] = low[left[ok] - step + 1] >= depth[ok]
        left[ok] -= step
        ok = right + step <= n - 1
        ok[ok] = low[right[ok] + 1] >= depth[ok]
        right[ok] += step
    return left, right


def _shared(turn: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Turns that each row but the first has in common with the one before."""
    least = np.minimum(size[1:], size[:-1])
    pair = np.repeat(np.arange(len(least)), least)
    nth = np.arange(len(pair)) - np.repeat(np.cumsum(least) - least, least)
    unlike = np.flatnonzero((turn[start[1:][pair] + nth] != turn[start[:-1][pair] + nth]).any(axis=1))
    out = least.copy()
    np.minimum.at(out, pair[unlike], nth[unlike])
    return out


def _nodes(group: pa.Table) -> pa.Table:
    """Nodes of a block's conversations; those that go on in a neighbouring block are `open`, and counted as far as this block goes."""
    side = group.column("side").to_numpy()
    order = np.lexsort((group.column("at").to_numpy(), side))
    group, side = group.take(pa.array(order)), side[order]
    keys = group.column("key").to_pylist()
    size = np.array([len(k) // TURN for k in keys], dtype=np.int64)
    start = np.cumsum(size) - size
    turn = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, TURN)
    chars = np.ascontiguousarray(turn[:, 16:]).view(">u4").ravel().astype(np.int64)
    both = _shared(np.ascontiguousarray(turn).view("<u4"), start, size)
    own = np.flatnonzero(side == 0)
    first, n = int(own[0]), len(own)
    # What rows i - 1 and i share; -1 where there is no neighbour.
    lcp = np.full(n + 1, -1, dtype=np.int64)
    lcp[1:n] = both[first : first + n - 1]
    lcp[0] = both[0] if first else -1
    lcp[n] = both[-1] if len(side) > first + n else -1
    size, start = size[own], start[own]
    conv, w = group.column("conv").to_numpy()[own], group.column("w").to_numpy()[own]
    ends = group.column("ends").combine_chunks().take(pa.array(own))

    # Candidates: all prefixes of all rows, from the root on.
    at = np.repeat(np.arange(n), size + 1)
    base = np.cumsum(size + 1) - (size + 1)
    depth = np.arange(len(at)) - base[at]
    inner = lcp[:n].copy()
    inner[0] = -1
    left, right = _extents(_table(inner), at, depth, n)
    # A prefix is a node, where it is its first member's.
    node = np.flatnonzero(left == at)
    l, r, d = at[node], right[node], depth[node]
    goes_left, goes_right = (left == 0) & (lcp[0] >= depth), (right == n - 1) & (lcp[n] >= depth)
    is_open = goes_left | goes_right
    up = np.maximum(node - 1, 0)
    whole = ~goes_left[node]

    lows = _table(conv)
    level = np.floor(np.log2(right - left + 1)).astype(np.int64)
    low = np.zeros(len(at), dtype=np.int64)
    for k in np.unique(level):
        use = level == k
        low[use] = np.minimum(lows[k][left[use]], lows[k][right[use] - (1 << int(k)) + 1])
    total = lambda x: (lambda c: c[r + 1] - c[l])(np.concatenate([[0], np.cumsum(x)]))
    n_convs, n_leaves = total(w), total(lcp[1:] < size)
    # Code points before each candidate's end, and in rows behind what they share with the one before.
    along = np.concatenate([[0], np.cumsum(np.concatenate([chars[s : s + k] for s, k in zip(start.tolist(), size.tolist(), strict=True)] or [np.zeros(0, np.int64)]))])
    row_start = np.cumsum(size) - size
    upto = along[row_start[at] + depth] - along[row_start[at]]
    full = upto[base + size]
    fresh = full - upto[base + np.maximum(lcp[:n], 0)]
    before = np.where(d > 0, upto[up], 0)
    saved = total(w * full) - n_convs * before - total(fresh) + np.where(whole, before - upto[base[l] + np.maximum(np.minimum(lcp[l], d), 0)], 0)
    # Children begin at the first member that goes on, and where neighbours share just the node's turns.
    codes = np.sort(lcp[:n] * (n + 1) + np.arange(n))
    n_children = np.searchsorted(codes, d * (n + 1) + r, "right") - np.searchsorted(codes, d * (n + 1) + l + whole, "left") + (whole & (size[l] > d))

    digest = lambda i, k: hashlib.md5(keys[first + i][: TURN * k]).digest()
    own_open, up_open = is_open[node], is_open[up] & (d > 0)
    names = [digest(i, k) if o else None for i, k, o in zip(l.tolist(), d.tolist(), own_open.tolist(), strict=True)]
    parents = [digest(i, k - 1) if o else None for i, k, o in zip(l.tolist(), d.tolist(), up_open.tolist(), strict=True)]
    ended = pa.array(np.where(whole & (size[l] == d), l, 0)), pa.array(~(whole & (size[l] == d)))
    found = ends.take(pa.array(ended[0].to_numpy(), mask=ended[1].to_numpy(zero_copy_only=False)))
    return pa.table(
        {
            "block": pa.array(np.full(len(node), group.column("block")[0].as_py())),
            "open": pa.array(own_open),
            "id": pa.array(names, pa.binary()),
            "parent": pa.array(parents, pa.binary()),
            "depth": pa.array(d),
            "conv": pa.array(low[node]),
            "parent_conv": pa.array(low[up], mask=up_open | (d == 0)),
            "n_convs": pa.array(n_convs),
            "n_children": pa.array(n_children.astype(np.int64)),
            "n_leaves": pa.array(n_leaves.astype(np.int64)),
            "saved": pa.array(saved),
            "ends": found.cast(pa.string()),
        }
    )


def trie(convs: DataFrame) -> DataFrame:
    """A row a distinct prefix of the conversations (conv, turns) of distinct ids: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Equal conversations are one class. Classes are sorted by their turns' digests in range partitions and dealt to blocks
    of neighbours. In a block every prefix of every row finds its first and last member by binary search on a sparse
    table of what neighbours share; sums over members are differences of running sums. Prefixes that go on in the next
    block, at most two conversations' a block, are summed over blocks by their digest. A first turn or a whole
    conversation that a third of all have is thus many full blocks, or one class.

    Conversations without turns are members of the root. Without conversations there is no row. A conversation's
    turns, 20 bytes each, have to fit into a task.
    """
    scratch = Scratch(convs.sparkSession, "trie")
    key = F.unhex(F.array_join("turns", ""))
    keyed = scratch.put(convs.select("conv", key.alias("key")).withColumn("class", F.unhex(F.md5("key"))))
    classes = scratch.put(keyed.groupBy("class", "key").agg(F.min("conv").alias("conv"), F.count("*").alias("w")))
    many = classes.where("w > 1").select("class")
    ends = _digests(keyed.select("class", "conv").join(many, "class", "left_semi"))
    alone = F.sha2(F.col("conv").cast("string").cast("binary"), 256)
    named = classes.join(ends, "class", "left").select("key", "conv", "w", F.coalesce("ends", alone).alias("ends"))
    found = scratch.put(_neighbours(named, scratch).groupBy("block").applyInArrow(_nodes, _SCHEMA))

    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")]
    spread = scratch.put(found.where("open").groupBy("id", "parent", "depth").agg(F.min("conv").alias("conv"), *sums, F.max("ends").alias("ends")))
    name = spread.select(F.col("id").alias("parent"), F.col("conv").alias("of"))
    # Named block by block, so that a parent of very many children is no key that they all meet at.
    here = found.where("open").select("block", F.col("id").alias("parent")).join(name, "parent")
    closed = found.where("NOT open").join(here, ["block", "parent"], "left")
    columns = [
        F.col("conv").alias("conv_id"), F.col("depth"), F.coalesce("of", "parent_conv").alias("parent_conv_id"), F.col("n_convs"), F.col("n_children"),
        F.col("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    ]
    over = spread.withColumn("parent_conv", F.lit(None).cast("long")).join(name, "parent", "left")
    return closed.select(*columns).unionByName(over.select(*columns))


def query(spark, sf_dir: str) -> DataFrame:
    return trie(branched(turns(table(spark, sf_dir, "conversations"))))


SQL = f"""
WITH own AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), length(text)) AS n
    FROM conversations WHERE conv_id IS NOT NULL
),
crcs AS ({crc_sql("(SELECT conv_id::VARCHAR AS name FROM own)")}),
convs AS (SELECT DISTINCT conv_id, crc % {HEADS} AS h FROM own JOIN crcs ON name = conv_id::VARCHAR),
rebuilt AS (
    SELECT c.conv_id, n, role, text FROM convs c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % {RUN} AND n <= h
    UNION ALL SELECT conv_id, n, role, text FROM convs JOIN own USING (conv_id) WHERE n > h
),
whole AS (
    SELECT conv_id, coalesce(turns, []) AS turns
    FROM convs LEFT JOIN (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY n) AS turns FROM rebuilt GROUP BY conv_id) USING (conv_id)
),
prefixes AS (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS depth FROM whole),
nodes AS (
    SELECT turns[1:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(turns) = depth), '')) AS ends_sha256
    FROM prefixes GROUP BY 1, 2
),
children AS (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(n.node[depth].text) END AS saved
    FROM nodes n LEFT JOIN children c ON n.node = c.node
),
tops AS (SELECT *, unnest(range(depth + 1)) AS top FROM counted),
below AS (SELECT node[1:top] AS node, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM tops GROUP BY 1)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens, c.ends_sha256
FROM counted c JOIN below b ON c.node = b.node LEFT JOIN nodes p ON c.depth > 0 AND p.node = c.node[1:c.depth - 1]"""
