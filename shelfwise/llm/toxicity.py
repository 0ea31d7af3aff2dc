"""Operator 1, toxicity: two class-conditional Kneser-Ney models of words, compared by length-normalised likelihood."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.llm.common import Scratch, few, table
from shelfwise.llm.kernels import ALNUM, FOLD, lean, mix, pieces, prefix, span_hash, word_spans

#: Bytes of a word that a step looks back on.
DEPTH = 10
#: Words that stand out: log-likelihood ratios beyond these.
MARKS = (1.5, 4.0, 8.0)
#: Rows that the last step, a few weights, is fitted on at most.
FIT_ROWS = 6_000
THRESHOLD = 0.7
#: Bytes of text that share a dictionary; log-likelihood ratios are summed as whole numbers of 1 / UNIT.
PIECE, UNIT = 1 << 22, 1 << 20
#: Bytes of text whose words share a bucket, and rows of a model that share a range, on average.
BUCKET, RANGE_ROWS = 1 << 24, 1 << 18
#: Stands for a ratio that is not there.
UNSEEN = np.iinfo(np.int32).min
#: Discount of the lower order; weight of byte pairs never seen.
LOW_DISCOUNT, RARE = 0.75, 0.1
#: Stands for a byte beyond either end of a word.
EDGE = 256
#: Models by the folds they count: both, and each alone.
MODELS = {"r": (0, 1), "r0": (0,), "r1": (1,)}
_END = np.uint64(0xA0761D6478BD642F)
_ROOT = 0


def _dictionaries(texts: pa.Array) -> Iterator[tuple[int, int, pa.Array, np.ndarray, np.ndarray]]:
    """(first row, end row, distinct words, row and word of each that occurs in a row, once, in order)."""
    for a, b, data, off in pieces(texts, PIECE):
        code = FOLD[data]
        start, end, row = word_spans(code, off, ALNUM)
        _, first, back = np.unique(span_hash(prefix(code), start, end), return_index=True, return_inverse=True)
        # A text's words count once each, so that one repeated a thousand times is no thousand witnesses.
        cell = np.unique(row * max(len(first), 1) + back)
        row, back = cell // max(len(first), 1), cell % max(len(first), 1)
        # Words of many rows come first: the words of a row are then near to each other, and packed in few bytes.
        order = np.argsort(-np.bincount(back, minlength=len(first)), kind="stable")
        place = np.empty(len(first), np.int64)
        place[order] = np.arange(len(first))
        cell = np.sort(row * max(len(first), 1) + place[back])
        first = first[order]
        words = _cut_out(code, start[first], end[first])
        yield a, b, words, cell // max(len(first), 1), cell % max(len(first), 1)


def _beginnings(run: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(words concerned, step, what it looks back on, place of its byte or -1 for an end); the first looks back on _ROOT.

    Up to DEPTH bytes a step is told apart by all of the word before it, further on by the last DEPTH bytes. The bytes
    beyond DEPTH of all words come together, so there a word may occur several times, and so do the ends of longer words.
    """
    size = end - start
    before = np.full(len(start), _ROOT, dtype=np.uint64)
    for k in range(1, DEPTH + 1):
        longer = np.flatnonzero(size >= k)
        stop = np.flatnonzero(size == k - 1)
        own = span_hash(run, start[longer], start[longer] + k)
        if len(stop):
            yield stop, mix(span_hash(run, start[stop], end[stop]) ^ _END), before[stop], np.full(len(stop), -1)
        if len(longer):
            yield longer, own, before[longer], start[longer] + k - 1
        before[longer] = own
    long = np.flatnonzero(size >= DEPTH)
    if len(long):
        back = span_hash(run, end[long] - DEPTH, end[long])
        yield long, mix(back ^ _END), back, np.full(len(long), -1)
        more = size[long] - DEPTH
        at = np.repeat(long, more)
        place = start[at] + DEPTH + np.arange(len(at)) - np.repeat(np.cumsum(more) - more, more)
        if len(at):
            yield at, span_hash(run, place - DEPTH, place + 1), span_hash(run, place - DEPTH, place), place


def _steps(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word, step, what it looks back on, its byte after the two before) of all steps of some words."""
    off = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    code = np.frombuffer(words.buffers()[2], np.uint8)[off[0] : off[-1]]
    start, end = off[:-1] - off[0], off[1:] - off[0]
    out = [[np.zeros(0, np.int64)] * 4]
    for at, own, back, last in _beginnings(prefix(code), start, end):
        place = np.where(last < 0, end[at], last)
        tail = np.where(last < 0, EDGE, code[np.maximum(last, 0)])
        for k in (1, 2):
            tail = tail + (np.where(place - k >= start[at], code[np.maximum(place - k, 0)], EDGE).astype(np.int64) << 9 * k)
        out.append([at, own.view(np.int64), back.view(np.int64), tail])
    return tuple(np.concatenate(column) for column in zip(*out, strict=True))


def _counted(rows: DataFrame) -> DataFrame:
    """(word, c0 .. c3): texts that hold a word, by 2 x fold + class; `rows` has text, label, fold."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = 2 * batch.column(2).to_numpy() + batch.column(1).to_numpy()
            for a, b, words, row, word in _dictionaries(batch.column(0)):
                n = np.bincount(word * 4 + group[a:b][row], minlength=4 * len(words)).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays([words, *(pa.array(c) for c in n.T.copy())], names=["word", "c0", "c1", "c2", "c3"])

    counted = rows.select("text", "label", "fold").mapInArrow(count, "word binary, c0 long, c1 long, c2 long, c3 long")
    return _in_order(counted.groupBy("word").agg(*(F.sum(f"c{g}").alias(f"c{g}") for g in range(4))))


def _in_order(words: DataFrame) -> DataFrame:
    """Neighbours begin alike, so that a batch of them has few different steps. Words are distinct: ranges can be even."""
    return words.repartitionByRange("word").sortWithinPartitions("word")


def _step_counts(counted: DataFrame) -> DataFrame:
    """(h, back, tail, c0 .. c3): the counts of words summed by step."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, own, back, tail = _steps(batch.column(0))
            _, first, same = np.unique(own, return_index=True, return_inverse=True)
            n = []
            for g in range(4):
                total = np.zeros(len(first), np.int64)
                np.add.at(total, same, batch.column(1 + g).to_numpy()[at])
                n.append(pa.array(total))
            yield pa.RecordBatch.from_arrays([pa.array(own[first]), pa.array(back[first]), pa.array(tail[first]), *n], names=["h", "back", "tail", "c0", "c1", "c2", "c3"])

    some = counted.mapInArrow(spread, "h long, back long, tail long, c0 long, c1 long, c2 long, c3 long")
    return some.groupBy("h").agg(F.max("back").alias("back"), F.max("tail").alias("tail"), *(F.sum(f"c{g}").alias(f"c{g}") for g in range(4)))


def _lower(steps: DataFrame) -> DataFrame:
    """(tail, low): the lower order, shared by both classes. A byte after the two before it, interpolated with the
    byte after one; both count in how many different steps it stands, not how often."""
    kinds = steps.groupBy("tail").agg(F.count("*").alias("n"))
    two, one, own = F.shiftright("tail", 9), F.shiftright("tail", 9).bitwiseAND(511), F.col("tail").bitwiseAND(511)
    kinds = kinds.select("tail", "n", two.alias("two"), one.alias("one"), own.alias("own"))
    total = lambda value, *by: value.over(Window.partitionBy(*by))
    pair = (total(F.sum("n"), "one", "own") + RARE) / (total(F.sum("n"), "one") + RARE * (EDGE + 1))
    held = total(F.sum("n"), "two")
    low = (F.col("n") - LOW_DISCOUNT) / held + LOW_DISCOUNT * total(F.count("*"), "two") / held * pair
    return kinds.select("tail", low.alias("low"))


@dataclass
class Model:
    """(h, r, r0, r1, u, u0, u1), a table in shared storage, as long as what was counted: log-likelihood ratios of toxic to
    ordinary, in 1 / UNIT, of a step, and of one never seen that looks back on h. Null where h was not seen as such."""

    table: DataFrame

    @classmethod
    def of(cls, steps: DataFrame, scratch: Scratch) -> Model:
        """Interpolated Kneser-Ney; both classes share the lower order."""
        n = {(m, c): sum((F.col(f"c{2 * f + c}") for f in folds), F.lit(0)) for m, folds in MODELS.items() for c in (0, 1)}
        rare = steps.agg(*(F.count(F.when(n[key] == k, 1)).alias(f"{key[0]}{key[1]}_{k}") for key in n for k in (1, 2))).first()
        discount = {}
        for m, c in n:
            one, two = rare[f"{m}{c}_1"], rare[f"{m}{c}_2"]
            discount[m, c] = one / (one + 2 * two) if one else 0.5
        sums = [F.sum(n[m, c]).alias(f"{m}{c}_all") for m, c in n]
        kinds = [F.count(F.when(n[m, c] > 0, 1)).alias(f"{m}{c}_kinds") for m, c in n]
        context = scratch.put(steps.groupBy("back").agg(*sums, *kinds))

        def backs(m: str, c: int) -> Column:
            weight = discount[m, c] * F.col(f"{m}{c}_kinds") / F.col(f"{m}{c}_all")
            return F.when(F.col(f"{m}{c}_all") > 0, F.greatest(F.least(weight, F.lit(1.0)), F.lit(1e-6))).otherwise(1.0)

        def likely(m: str, c: int) -> Column:
            own = F.when(F.col(f"{m}{c}_all") > 0, F.greatest(n[m, c] - discount[m, c], F.lit(0.0)) / F.col(f"{m}{c}_all")).otherwise(0.0)
            return own + backs(m, c) * F.col("low")

        def ratio(p, m: str, name: str) -> Column:
            return F.round((F.log(p(m, 1)) - F.log(p(m, 0))) * UNIT).cast("long").alias(name)

        low = scratch.put(_lower(steps))
        seen = scratch.put(steps.join(context, "back").join(few(low), "tail").select("h", *(ratio(likely, m, m) for m in MODELS)))
        unseen = context.select(F.col("back").alias("h"), *(ratio(backs, m, _away(m)) for m in MODELS))
        joined = scratch.put(seen.join(unseen, "h", "full"))
        for done in (context, low, seen):
            scratch.drop(done)
        return cls(joined)

    def ratios(self, words: DataFrame, names: list[str], scratch: Scratch) -> DataFrame:
        """(w, *names): the sum over a word's steps. `words` (w, word) are distinct; w, a hash, tells them apart.

        Words in order are cut into blocks; a block looks up each of its steps once. It sends its steps, in order and
        packed, to ranges of the table, which send packed ratios back.
        """
        away = [_away(m) for m in names]
        bits = _bits(self.table.count() / RANGE_ROWS)

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = TaskContext.get().partitionId() << 32
            for batch in batches:
                if not batch.num_rows:
                    continue
                one = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in (batch.column(0), batch.column(1))]
                yield pa.RecordBatch.from_arrays([pa.array([block]), *one], names=["block", "w", "words"])
                block += 1

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, words in zip(batch.column(0), batch.column(1), strict=True):
                    keys = _keys(*_steps(words.values)[1:3])
                    to, cuts = _cuts(keys, bits)
                    data = [_pack(keys[a:b]) for a, b in cuts]
                    yield pa.RecordBatch.from_arrays([pa.array([block.as_py()] * len(to), pa.int64()), pa.array(to, pa.int32()), pa.array(data, pa.binary())], names=["of", "range", "data"])

        def tell(left: pa.Table, right: pa.Table) -> pa.Table:
            h = right.column("h").to_numpy().view(np.uint64)
            order, out = np.argsort(h), []
            h = np.append(h[order], np.uint64(0))
            values = [right.column(c).fill_null(UNSEEN if c in names else 0).to_numpy()[order] for c in (*names, *away)]
            values = [np.append(v, 0).astype(np.int32) for v in values]
            for data in left.column("data").to_pylist():
                keys = _unpack(data, np.uint64)
                at = np.searchsorted(h[:-1], keys)
                hit = (h[at] == keys) & (at < len(order))
                out.append(_pack(np.concatenate([np.where(hit, v[at], UNSEEN if i < len(names) else 0).astype(np.int32) for i, v in enumerate(values)])))
            return pa.table({"of": left.column("of"), "range": left.column("range"), "data": pa.array(out, pa.binary())})

        blocks = scratch.put(_in_order(words.select("w", "word")).mapInArrow(cut, "block long, w array<long>, words array<binary>"))
        asked = blocks.select("block", "words").mapInArrow(ask, "of long, range int, data binary")
        ranges = self.table.select(_top("h", bits).alias("range"), "h", *names, *away)
        told = scratch.put(asked.groupBy("range").cogroup(ranges.groupBy("range")).applyInArrow(tell, "of long, range int, data binary"))

        def add(left: pa.Table, right: pa.Table) -> pa.Table:
            words = left.column("words").combine_chunks().flatten()
            at, own, back, _ = _steps(words)
            keys = _keys(own, back)
            own, back = np.searchsorted(keys, own.view(np.uint64)), np.searchsorted(keys, back.view(np.uint64))
            values = [_unpack(data, np.int32).reshape(2 * len(names), -1) for _, data in _by(right, "range")]
            values = np.concatenate([np.zeros((2 * len(names), 0), np.int32), *values], axis=1).astype(np.int64)
            out = {"w": left.column("w").combine_chunks().flatten()}
            for i, m in enumerate(names):
                step, new = values[i], values[len(names) + i]
                total = np.zeros(len(words), np.int64)
                np.add.at(total, at, np.where(step[own] != UNSEEN, step[own], new[back]))
                out[m] = pa.array(total)
            return pa.table(out)

        ddl = ", ".join(["w long", *(f"{m} long" for m in names)])
        out = scratch.put(blocks.groupBy("block").cogroup(told.groupBy("of")).applyInArrow(add, ddl))
        scratch.drop(blocks)
        scratch.drop(told)
        return out

    def apply(self, docs: DataFrame, text: str, names: list[str], finish: Callable[[np.ndarray], dict[str, np.ndarray]], schema: str, scratch: Scratch) -> DataFrame:
        """The columns of `docs` but the text, and those that `finish` makes of the features by each of `names`.

        Documents are cut into pieces with a dictionary each. A piece sends the words of its dictionary, in order and
        packed, to buckets of words; there distinct words of all pieces get their ratios once, and each piece gets those
        of its own words back. No text is shuffled, only which words of its dictionary it has.
        """
        fields = [f for f in docs.schema.fields if f.name != text]
        rest = [f"c{i}" for i in range(len(fields))]
        given = docs.select(F.col(f"`{text}`").alias("text"), *(F.col(f"`{f.name}`").alias(c) for f, c in zip(fields, rest, strict=True)))
        bits = _bits((given.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0) / BUCKET)

        def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            piece = TaskContext.get().partitionId() << 32
            for batch in batches:
                for a, b, words, row, word in _dictionaries(batch.column(0)):
                    gap = np.diff(word, prepend=0)
                    starts = np.flatnonzero(np.diff(row, prepend=-1))
                    gap[starts] = word[starts]
                    place, sent = _sent(words, bits)
                    held = [_pack(np.bincount(row, minlength=b - a).astype(np.int32)), _pack(gap.astype(_width(len(words)))), _pack(place.astype(_width(len(words))))]
                    own, sink = batch.slice(a, b - a).select(rest), pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, own.schema) as out:
                        out.write_batch(own)
                    row_of = [pa.array([piece]), *(pa.array([x]) for x in held), pa.array([zstandard.compress(sink.getvalue().to_pybytes(), 3)]), pa.array([sent], pa.list_(pa.binary()))]
                    yield pa.RecordBatch.from_arrays(row_of, names=["piece", "n", "gap", "place", "rest", "sent"])
                    piece += 1

        indexed = scratch.put(given.mapInArrow(lean(index), "piece long, n binary, gap binary, place binary, rest binary, sent array<binary>"))
        sent = indexed.select("piece", F.posexplode("sent").alias("bucket", "data")).where("length(data) > 0")

        def unite(group: pa.Table) -> pa.Table:
            code, start, end, w, _ = _received(group.column("data").to_pylist())
            w, first = np.unique(w, return_index=True)
            return pa.table({"w": pa.array(w.view(np.int64)), "word": _cut_out(code, start[first], end[first])})

        def reply(left: pa.Table, right: pa.Table) -> pa.Table:
            *_, w, cuts = _received(left.column("data").to_pylist())
            order = np.argsort(right.column("w").to_numpy().view(np.uint64))
            at = np.searchsorted(right.column("w").to_numpy().view(np.uint64)[order], w)
            values = np.stack([right.column(m).to_numpy()[order][at] for m in names])
            data = [_pack(values[:, a:b].ravel()) for a, b in zip(cuts, cuts[1:], strict=False)]
            return pa.table({"of": left.column("piece"), "bucket": left.column("bucket"), "data": pa.array(data, pa.binary())})

        ratios = self.ratios(sent.groupBy("bucket").applyInArrow(unite, "w long, word binary"), names, scratch)
        valued = ratios.select(_top("w", bits).alias("bucket"), "w", *names)
        valued = scratch.put(sent.groupBy("bucket").cogroup(valued.groupBy("bucket")).applyInArrow(reply, "of long, bucket int, data binary"))
        scratch.drop(ratios)

        def put_together(left: pa.Table, right: pa.Table) -> pa.Table:
            n = _unpack(left.column("n")[0].as_py(), np.int32).astype(np.int64)
            values = [_unpack(data, np.int64).reshape(len(names), -1) for _, data in _by(right, "bucket")]
            values = np.concatenate([np.zeros((len(names), 0), np.int64), *values], axis=1)
            width = _width(values.shape[1])
            gap, place = (_unpack(left.column(c)[0].as_py(), width).astype(np.int64) for c in ("gap", "place"))
            row, word = np.repeat(np.arange(len(n)), n), np.cumsum(gap)
            first = (np.cumsum(n) - n)[n > 0]
            word -= np.repeat(word[first] - gap[first], n[n > 0])
            x = []
            for own in values:
                ratio = np.zeros(len(own), np.int64)
                ratio[place] = own
                x += _features(n, row, ratio[word])
            own = pa.ipc.open_stream(zstandard.decompress(left.column("rest")[0].as_py())).read_all()
            for name, found in finish(np.stack(x, axis=1)).items():
                own = own.append_column(name, pa.array(found))
            return own

        sides = indexed.select("piece", "n", "gap", "place", "rest").groupBy("piece").cogroup(valued.groupBy("of"))
        ddl = ", ".join([*(f"{c} {f.dataType.simpleString()}" for f, c in zip(fields, rest, strict=True)), schema])
        out = sides.applyInArrow(put_together, ddl)
        return out.select(*(F.col(c).alias(f.name) for f, c in zip(fields, rest, strict=True)), *out.columns[len(rest):])


def _pack(x: np.ndarray) -> bytes:
    """Numbers by the place of their bytes, compressed: the high bytes of what is sorted or small are alike."""
    return zstandard.compress(np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes(), 3)


def _unpack(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(size, -1).T).view(kind).ravel()


def _bits(parts: float) -> int:
    """Of a hash, so that its ranges are at least so many; one at least."""
    return max(1, (int(np.ceil(parts)) - 1).bit_length())


def _top(h: str, bits: int) -> Column:
    return F.shiftrightunsigned(h, 64 - bits).cast("int")


def _cuts(sorted_hashes: np.ndarray, bits: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Ranges that have hashes, and where those of each begin and end."""
    top = sorted_hashes >> np.uint64(64 - bits)
    start = np.flatnonzero(np.concatenate([np.ones(min(len(top), 1), bool), top[1:] != top[:-1]]))
    return top[start].astype(np.int32), list(zip(start.tolist(), [*start[1:].tolist(), len(top)], strict=False))


def _by(rows: pa.Table, place: str) -> list[tuple[int, bytes]]:
    return sorted(zip(rows.column(place).to_pylist(), rows.column("data").to_pylist(), strict=True))


def _cut_out(code: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The bytes from start to end, an element each."""
    size = end - start
    stop = np.cumsum(size)
    flat = code[np.repeat(start - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)]
    offsets = np.concatenate([[0], stop]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])


def _sent(words: pa.Array, bits: int) -> tuple[np.ndarray, list[bytes]]:
    """(places of the words in the order they are sent in, what each bucket gets): words in order, with spaces between."""
    bucket = (_word_hashes(words) >> np.uint64(64 - bits)).astype(np.int32)
    place = pc.sort_indices(pa.table({"bucket": bucket, "word": words}), sort_keys=[("bucket", "ascending"), ("word", "ascending")]).to_numpy()
    cuts = np.searchsorted(bucket[place], np.arange((1 << bits) + 1)).astype(np.int32)
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), words.take(pa.array(place))), b" ")
    return place.astype(np.int64), [zstandard.compress(x, 3) if x else b"" for x in joined.to_pylist()]


def _word_hashes(words: pa.Array) -> np.ndarray:
    off = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    return span_hash(prefix(np.frombuffer(words.buffers()[2], np.uint8)), off[:-1], off[1:])


def _received(sent: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start and end of each word, its hash, where the words of each sender begin and end)."""
    parts = [zstandard.decompress(x) for x in sent]
    code, off = np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
    start, end, of = word_spans(code, off, ALNUM)
    return code, start, end, span_hash(prefix(code), start, end), np.searchsorted(of, np.arange(len(parts) + 1))


def _keys(own: np.ndarray, back: np.ndarray) -> np.ndarray:
    return np.unique(np.concatenate([own, back]).view(np.uint64))


def _away(model: str) -> str:
    return "u" + model[1:]


def _width(words: int) -> type:
    return np.uint16 if words < 1 << 16 else np.int32


def _features(n: np.ndarray, row: np.ndarray, word: np.ndarray) -> list[np.ndarray]:
    """What the weights apply to, from the number of a text's distinct words and their ratios."""
    total = np.bincount(row, weights=word, minlength=len(n)) / UNIT
    out = [np.clip(total / np.maximum(n, 1), -2, 2), np.log1p(n)]
    for mark in MARKS:
        k = np.bincount(row[word > mark * UNIT], minlength=len(n))
        out += [np.log((k + 0.05) / (n + 10)), np.log1p(k)]
    return out


@dataclass
class Scorer:
    model: Model
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return _weighted(x, self.mean, self.scale, self.weight)


def _weighted(x: np.ndarray, mean: np.ndarray, scale: np.ndarray, weight: np.ndarray) -> np.ndarray:
    # Even odds, as the rows were fitted, come out as the threshold.
    z = np.full(len(x), weight[0])
    for column, own in zip(((x - mean) / scale).T, weight[1:], strict=True):
        z += column * own  # one after another: a product of matrices rounds by the number of rows
    z = np.log(THRESHOLD / (1 - THRESHOLD)) + np.clip(z, -30, 30)
    return 1 / (1 + np.exp(-z))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
    w = np.zeros(x.shape[1])
    keep = ridge * np.eye(len(w))
    keep[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (p - y) + keep @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Scorer:
    """From rows with text and label 0 or 1; others are left out.

    All words of all rows are counted, in two folds, and their steps in turn; the counts are tables in shared storage that
    grow with the input, and the driver gets none of them. A few weights turn a text's mean log-likelihood ratio and its
    outstanding words into a score; they are fitted on up to about FIT_ROWS rows, each scored by the other fold's model.
    """
    scratch = Scratch(labelled.sparkSession, "toxicity")
    rows = labelled.where(F.col(text).isNotNull() & F.col(label).isin(0, 1))
    fold = F.pmod(F.xxhash64(F.col(doc_id), F.lit("fold")), F.lit(2)).cast("int").alias("fold")
    rows = rows.select(F.col(text).alias("text"), F.col(label).cast("int").alias("label"), fold, F.xxhash64(F.col(doc_id), F.col(text)).alias("key"))
    words = scratch.put(_counted(rows))
    steps = scratch.put(_step_counts(words))
    scratch.drop(words)
    model = Model.of(steps, scratch)
    scratch.drop(steps)

    size = 2 + 2 * len(MARKS)
    rate = min(1.0, FIT_ROWS / max(rows.count(), 1))
    picked = rows.where(F.xxhash64("key") / F.lit(2.0**64) + 0.5 < rate).select("text", "label", "fold")
    pack = lambda x: {"x": [v.tobytes() for v in x]}
    looked = Scratch(labelled.sparkSession, "toxicity-fit")
    got = [(r["label"], np.frombuffer(r["x"]).reshape(2, size)[1 - r["fold"]]) for r in model.apply(picked, "text", ["r0", "r1"], pack, "x binary", looked).collect()]
    looked.clear()
    got.sort(key=lambda r: (r[0], r[1].tobytes()))
    x = np.array([v for _, v in got]).reshape(-1, size)
    y = np.array([k for k, _ in got], dtype=float)
    if not len(y):
        return Scorer(model, np.zeros(size), np.ones(size), np.array([-1.0, *np.zeros(size)]))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    return Scorer(model, mean, scale, _logistic((x - mean) / scale, y))


def score(docs: DataFrame, scorer: Scorer, text: str = "text") -> DataFrame:
    """The columns of `docs` but the text, with score (0 to 1) and predicted (1 from THRESHOLD on).

    Null and empty texts have no words and get the score of such. Without training rows all scores are the same, below
    the threshold. Repeated rows score alike; extra columns stay, columns of the two names are replaced.
    """
    mean, scale, weight = scorer.mean, scorer.scale, scorer.weight

    def finish(x: np.ndarray) -> dict[str, np.ndarray]:
        p = _weighted(x, mean, scale, weight)
        return {"score": p, "predicted": (p >= THRESHOLD).astype(np.int32)}

    docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in ("score", "predicted")))
    return scorer.model.apply(docs, text, ["r"], finish, "score double, predicted int", Scratch(docs.sparkSession, "toxicity"))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(F.col("toxic").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # Labels grow with the documents: they are merged with them, not broadcast while they happen to be few.
    scorer = fit(docs.where(~held_out()).join(labels.hint("merge"), "doc_id"))
    return score(docs, scorer).select("doc_id", held_out().alias("held_out"), "score", "predicted")
