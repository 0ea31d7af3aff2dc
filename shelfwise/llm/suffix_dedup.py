"""Operator 4, suffix-array dedup: repeated byte strings, found by sorting suffixes within ranges of their leading bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import repeats
from shelfwise.llm.common import Scratch, table
from shelfwise.llm.kernels import every_hash, pieces, prefix, span_hash

#: Bytes of a repeated string; of the gram that anchors its suffix.
LENGTH, GRAM = 50, 20
#: Suffix starts that may share an anchor, at most 32 (a bit each).
SPREAD = LENGTH - GRAM + 1
#: Logarithm (base 2) of the occurrences beyond which a gram is frequent.
FREQUENT = 11
#: One text in so many gives leads for the splitters.
SAMPLED = 50
#: Bytes of text that are hashed at once: few enough for what comes of them to stay in a core's cache.
PIECE = 1 << 18


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, little-endian, without a copy."""
    return np.ndarray((max(len(data) - 7, 0),), np.uint64, np.ascontiguousarray(data), strides=(1,))


def _lead(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each place as a number that sorts like them."""
    return _words(data)[at].byteswap()


def anchored(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first start, last start, anchor, gram hash) of runs of LENGTH-byte strings that share an anchor, in order.

    A string's anchor is the gram with the smallest hash in it, the leftmost of equals, so equal strings have theirs
    at the same offset. Strings with one anchor start side by side and travel as one stretch of bytes.
    """
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none, none, none.astype(np.uint64)
    run = prefix(data)
    at = np.arange(n - GRAM + 1)
    h = every_hash(run, GRAM)
    low = (h & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    width = 1
    while width * 2 <= SPREAD:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[: len(low) - (SPREAD - width)], low[SPREAD - width :])
    ends = np.repeat(off[1:], np.diff(off))
    start = np.flatnonzero(at[: len(low)] + LENGTH <= ends[: len(low)])
    anchor = (low[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    if not len(start):
        return none, none, none, none.astype(np.uint64)
    cut = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)]))
    last = start[np.concatenate([cut[1:], [len(start)]]) - 1]
    return start[cut], last, anchor[cut], h[anchor[cut]]


def _hashes(texts: pa.ChunkedArray) -> Iterator[np.ndarray]:
    for _, _, data, off in pieces(texts, PIECE):
        yield anchored(data, off)[3]


class Units:
    """Stretches of a block whose strings may occur elsewhere; distinct ones, in the order of their leads."""

    def __init__(self, group: pa.Table, found: pa.Table, frequent: int):
        texts = group.column("text")
        u, _ = repeats.distinct(_hashes(texts))
        level = repeats.read_levels(found)
        again, often = level > 0, level > frequent
        doc = group.column("doc").to_numpy().astype(np.int64)
        self.data, lo, hi, anchor, row, base = [], [], [], [], [], 0
        for a, b, data, off in pieces(texts, PIECE):
            first, last, at, h = anchored(data, off)
            k = np.searchsorted(u, h)
            # Strings of a frequent anchor go one by one, led by their own bytes: those alike are one in each block.
            for some, single in ((again[k] & ~often[k], False), (again[k] & often[k], True)):
                f, z, p = first[some], last[some], at[some]
                if single:
                    size = z - f + 1
                    f = np.repeat(f, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                    z = p = f
                lo.append(f + base), hi.append(z + base), anchor.append(p + base)
                row.append(np.searchsorted(off, f, "right") - 1 + a)
            self.data.append(data)
            base += len(data)
        self.data = np.concatenate(self.data) if self.data else np.zeros(0, np.uint8)
        lo, hi, anchor, row = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (lo, hi, anchor, row))
        self.doc = doc[row] if len(row) else np.zeros(0, np.int64)
        # Equal stretches are one unit: by hash, then by content.
        run = prefix(self.data)
        same = span_hash(run, lo, hi + LENGTH) + (anchor - lo).astype(np.uint64)
        lead = _lead(self.data, anchor) if len(lo) else np.zeros(0, np.uint64)
        order = np.lexsort((self.doc, same, lead))
        lo, hi, anchor, row, same, lead, self.doc = (x[order] for x in (lo, hi, anchor, row, same, lead, self.doc))
        new = np.ones(len(lo), dtype=bool)
        new[1:] = (same[1:] != same[:-1]) | (hi[1:] - lo[1:] != hi[:-1] - lo[:-1]) | (lead[1:] != lead[:-1])
        words = _words(self.data)
        for k in range(0, LENGTH + SPREAD, 8):
            tied = np.flatnonzero(~new & (lo + k < hi + LENGTH))
            at = np.minimum(k, hi[tied] - lo[tied] + LENGTH - 8)
            new[tied] = words[lo[tied] + at] != words[lo[tied - 1] + at]
        self.lo, self.hi, self.anchor, self.row, self.unit = lo, hi, anchor, row, np.cumsum(new) - 1
        self.head = np.flatnonzero(new)
        self.lead = lead[self.head]


def multikey(data: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """Label of each suffix's first `length` bytes, in their order: equal labels, equal bytes.

    Multikey quicksort with keys of eight bytes: suffixes are sorted by a key, and only those still tied by the next.
    """
    label = np.zeros(len(start), dtype=np.int64)
    tied = np.arange(len(start))
    for depth in range(0, length, 8):
        key = _lead(data, start[tied] + min(depth, length - 8))
        order = np.lexsort((key, label[tied]))
        member, k, was = tied[order], key[order], label[tied][order]
        change = np.concatenate([[True], (k[1:] != k[:-1]) | (was[1:] != was[:-1])]) if len(k) else np.zeros(0, bool)
        first = np.concatenate([[True], was[1:] != was[:-1]]) if len(was) else np.zeros(0, bool)
        # A tied group's labels start at its old one; each group is followed by as many unused labels as it has members.
        place = np.arange(len(k))
        begin = np.maximum.accumulate(np.where(first, place, 0)) if len(k) else place
        head = np.maximum.accumulate(np.where(change, place, 0)) if len(k) else place
        label[member] = was + head - begin
        size = np.bincount(np.cumsum(change) - 1) if len(k) else place
        tied = member[np.repeat(size > 1, size)] if len(k) else member
        if not len(tied):
            break
    return label


def _smallest(label: np.ndarray, value: np.ndarray) -> np.ndarray:
    """For each element the smallest value of its label."""
    order = np.argsort(label, kind="stable")
    new = np.flatnonzero(np.concatenate([[True], label[order][1:] != label[order][:-1]]))
    out = np.zeros_like(value)
    out[order] = np.repeat(np.minimum.reduceat(value[order], new), np.diff([*new, len(label)]))
    return out


def _resolve(parts: list[bytes]) -> list[bytes]:
    """For the units of each part, a bit a string: whether it also starts in a document before the unit's own first."""
    lo, size, rel, doc, data, sizes, base = [], [], [], [], [], [], 0
    for part in parts:
        raw = zstandard.decompress(part)
        n = int.from_bytes(raw[:8], "little")
        doc.append(np.frombuffer(raw, np.int64, n, 8))
        size.append(np.frombuffer(raw, np.uint8, n, 8 + 8 * n).astype(np.int64))
        rel.append(np.frombuffer(raw, np.uint8, n, 8 + 9 * n).astype(np.int64))
        own = np.frombuffer(raw, np.uint8, offset=8 + 10 * n)
        each = size[-1] + LENGTH - 1
        lo.append(base + np.cumsum(each) - each)
        data.append(own)
        sizes.append(n)
        base += len(own)
    lo, size, rel, doc, data = map(np.concatenate, (lo, size, rel, doc, data))
    gram = multikey(data, lo + rel, GRAM)
    # Where one document is the first of all units with a gram, and the units are one stretch, there is nothing to compare.
    run = prefix(data)
    whole = span_hash(run, lo, lo + size + LENGTH - 1)
    order = np.lexsort((whole, gram))
    several = np.zeros(len(lo), dtype=bool)
    differ = order[1:][(gram[order][1:] == gram[order][:-1]) & (whole[order][1:] != whole[order][:-1])]
    mixed = np.zeros(int(gram.max()) + 1, dtype=bool)
    mixed[gram[differ]] = True
    several = mixed[gram]
    mask = np.zeros(len(lo), dtype=np.uint32)

    # One stretch: every string has the same documents.
    one = np.flatnonzero(~several)
    if len(one):
        later = doc[one] > _smallest(gram[one], doc[one])
        mask[one] = np.where(later, (np.uint64(1) << size[one].astype(np.uint64)) - np.uint64(1), 0).astype(np.uint32)
    # Several: all their strings are sorted as suffixes, and neighbours compared, a few million at a time.
    many = np.flatnonzero(several)
    many = many[np.argsort(gram[many], kind="stable")]
    ends = np.cumsum(size[many])
    a = 0
    while a < len(many):
        b = int(np.searchsorted(ends, (ends[a - 1] if a else 0) + 2_000_000, "right"))
        b = max(b, a + 1)
        while b < len(many) and gram[many[b]] == gram[many[b - 1]]:
            b += 1
        own = many[a:b]
        unit = np.repeat(own, size[own])
        nth = np.arange(len(unit)) - np.repeat(np.cumsum(size[own]) - size[own], size[own])
        label = multikey(data, lo[unit] + nth, LENGTH)
        later = _smallest(label, doc[unit]) < doc[unit]
        np.bitwise_or.at(mask, unit[later], (np.uint32(1) << nth[later].astype(np.uint32)))
        a = b
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    return [zstandard.compress(mask[x:y].tobytes(), 1) for x, y in zip(cuts, cuts[1:], strict=False)]


def covered(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """(doc, n_bytes, n_removed, n_spans, kept): for each row of `docs`, its UTF-8 bytes without the repeated ones.

    A byte is removed if a LENGTH-byte string over it also starts in a document with a smaller id, as the input has
    it. Null and empty texts have no bytes; texts shorter than LENGTH keep theirs; repeats within one document, or in
    rows of one id, stay. A row without id comes after all others. Other columns are ignored.

    Only suffixes at anchors are sorted, which every string has one of; those whose gram occurs once are left out. The
    others, with all the bytes that any of their strings has, go to ranges of their leading bytes, cut at sampled
    splitters. Equal leads are never cut, so equal strings meet in one range and no border runs between them. There,
    multikey quicksort labels equal suffixes, and each string learns whether a smaller document has it. Equal
    stretches of a block are one entry, and strings of very frequent grams are led by their own bytes, so that a
    passage or group of copies of any size is a few entries a block.
    """
    scratch = Scratch(docs.sparkSession, "suffixes")
    numbered = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(2**63 - 1)).alias("doc"), F.col(doc_id).isNull().alias("none"), F.col(text).alias("text"))
    of_blocks, n_blocks = repeats.blocks(numbered, "doc", "text", "none")
    bits = scratch.put(repeats.shared(of_blocks, n_blocks, _hashes))
    splitters = _splitters(numbered, n_blocks)

    def send(group: pa.Table, found: pa.Table) -> pa.Table:
        units = Units(group, found, frequent)
        cuts = np.concatenate([[0], np.searchsorted(units.lead, splitters, "right"), [len(units.lead)]])
        rows, block = [], group.column("block")[0].as_py()
        for k in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            at = units.head[cuts[k] : cuts[k + 1]]
            lo, size = units.lo[at], units.hi[at] - units.lo[at] + 1
            each = size + LENGTH - 1
            flat = np.repeat(lo - (np.cumsum(each) - each), each) + np.arange(each.sum())
            raw = len(at).to_bytes(8, "little") + units.doc[at].tobytes() + size.astype(np.uint8).tobytes()
            raw += (units.anchor[at] - lo).astype(np.uint8).tobytes() + units.data[flat].tobytes()
            rows.append((k, block, zstandard.compress(raw, 3)))
        return pa.table({"part": pa.array([r[0] for r in rows], pa.int32()), "block": pa.array([r[1] for r in rows], pa.int64()), "data": pa.array([r[2] for r in rows], pa.binary())})

    def compare(group: pa.Table) -> pa.Table:
        masks = _resolve(group.column("data").to_pylist())
        n = len(masks)
        return pa.table({"block": group.column("block"), "bucket": pa.array([0] * n, pa.int32()), "n": group.column("part"), "data": pa.array(masks, pa.binary()), "mask": pa.array([True] * n)})

    sent = of_blocks.groupBy("block").cogroup(bits.groupBy("block")).applyInArrow(send, "part int, block long, data binary")
    schema = "block long, bucket int, n int, data binary, mask boolean"
    masks = scratch.put(sent.groupBy("part").applyInArrow(compare, schema))

    def cut(group: pa.Table, known: pa.Table) -> pa.Table:
        is_mask = known.column("mask").to_numpy(zero_copy_only=False).astype(bool)
        units = Units(group, known.filter(pa.array(~is_mask)), frequent)
        got = known.filter(pa.array(is_mask))
        got = sorted(zip(got.column("n").to_pylist(), got.column("data").to_pylist(), strict=True))
        mask = np.frombuffer(b"".join(zstandard.decompress(d) for _, d in got), np.uint32)
        starting = np.zeros(len(units.data), dtype=bool)
        if len(units.unit):
            size = units.hi - units.lo + 1
            first = units.doc[units.head][units.unit]
            # Later documents of the block have the first one before them.
            full = ((np.uint64(1) << size.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)
            starts = np.where(units.doc > first, full, mask[units.unit])
            for k in range(SPREAD):
                starting[units.lo[(starts >> np.uint32(k)) & np.uint32(1) == 1] + k] = True
        # A byte goes if a string that goes starts there or up to LENGTH - 1 bytes before; none leaves its document.
        begun = np.cumsum(starting, dtype=np.int32)
        gone = begun > 0
        gone[LENGTH:] = begun[LENGTH:] > begun[:-LENGTH]
        size = np.concatenate([np.diff(off) for *_, off in pieces(group.column("text"))])
        off = np.concatenate([[0], np.cumsum(size)])
        run = np.concatenate([[0], np.cumsum(gone)])
        head = gone.copy()
        head[1:] &= ~gone[:-1]
        full = off[:-1] < off[1:]
        head[off[:-1][full]] = gone[off[:-1][full]]
        heads = np.concatenate([[0], np.cumsum(head)])
        kept, to = units.data[~gone], off - run[off]
        cells = pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(to.astype(np.int32)), pa.py_buffer(kept)])
        return pa.table(
            {
                "doc": group.column("doc"),
                "none": group.column("none"),
                "n_bytes": pa.array(size),
                "n_removed": pa.array(run[off[1:]] - run[off[:-1]]),
                "n_spans": pa.array(heads[off[1:]] - heads[off[:-1]]),
                "kept": cells,
            }
        )

    known = bits.withColumn("mask", F.lit(False)).unionByName(masks)
    schema = "doc long, none boolean, n_bytes long, n_removed long, n_spans long, kept binary"
    out = of_blocks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(cut, schema)
    return out.select(F.when(~F.col("none"), F.col("doc")).alias("doc"), "n_bytes", "n_removed", "n_spans", "kept")


def _splitters(docs: DataFrame, ranges: int) -> np.ndarray:
    """Leads that cut the suffixes of a sample of texts into ranges of about equal size: quantiles of a sketch that tasks
    merge, so that the driver gets one number a range."""
    if ranges < 2:
        return np.zeros(0, np.uint64)
    top = np.uint64(1 << 63)  # signed numbers in the order of unsigned ones

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, off in pieces(batch.column(0), PIECE):
                at = anchored(data, off)[2]
                lead = _lead(data, at)[:: max(1, SAMPLED // 2)] ^ top
                yield pa.RecordBatch.from_arrays([pa.array(lead.view(np.int64))], names=["lead"])

    picked = docs.where((F.octet_length("text") >= LENGTH) & (F.pmod(F.xxhash64("doc", "text"), F.lit(SAMPLED)) == 0)).select("text")
    places = [k / ranges for k in range(1, ranges)]
    leads = picked.mapInArrow(sample, "lead long").agg(F.percentile_approx("lead", places, max(10_000, 20 * ranges))).first()[0]
    return np.unique(np.array(leads or [], dtype=np.int64).view(np.uint64) ^ top)


def query(spark, sf_dir: str) -> DataFrame:
    out = covered(table(spark, sf_dir, "documents"))
    return out.select(F.col("doc").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
