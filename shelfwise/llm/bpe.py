"""Operator 9, BPE encoding and decoding: longest matches are proposed, checked pair by pair, and merged only where they fail."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from shelfwise.llm.common import small_batches, table
from shelfwise.llm.kernels import lean, pieces

#: Words a task remembers: beyond that it keeps the half that most pieces of text used. Longer ones than LONG characters go
#: with their piece. What it has forgotten is worked out again, which costs time only.
REMEMBERED, LONG = 200_000, 64
#: Bytes of text that are cut into words at a time; a longer text is taken alone.
PIECE = 1 << 19
#: Bytes up to which words are merged side by side.
SHORT = 64
NEVER = np.int64(1) << 40
#: Capitals that the vocabulary's library folds and Python's older character tables do not know.
NEWER = {0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x019B}
NEWER |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)} | {ord("Σ"): ord("σ")}
_NEWER = re.compile("[" + "".join(map(chr, NEWER)) + "]")
#: Ranges (first, last) of letters and numbers of the regex module's tables that the vocabulary's library
#: takes for neither. It knows Unicode 15; these were assigned later, or are kept free within blocks of letters.
LATER = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F),
    (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1),
    (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A),
    (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686),
    (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF3), (0x16FF4, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA),
    (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168),
    (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE),
    (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F),
    (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
]
_LATER = "[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in LATER) + "]"


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself, or one beyond 255."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in shown}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(shown))
    return [out[b] for b in range(256)]


def _runs(flat: np.ndarray, cuts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of `flat` from cuts[r] to cuts[r + 1] for each r of `rows`, one after the other, and their own cuts."""
    size = cuts[rows + 1] - cuts[rows]
    own = np.concatenate([[0], np.cumsum(size)])
    return flat[np.repeat(cuts[rows] - own[:-1], size) + np.arange(own[-1])], own


class WordBpe:
    """Byte-level BPE with an end-of-word mark, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.mark = model["end_of_word_suffix"]
        n = max(max(vocab.values()), *self.special.values(), 0) + 1
        text = [""] * n
        for t, i in [*vocab.items(), *self.special.items()]:
            text[i] = t
        self.texts = pa.array(text, pa.string())
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.piece = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        #: The same for words with characters of LATER, which are rare.
        self.later = re.compile(_LATER)
        letter, number = rf"(?:(?!{_LATER})\p{{L}})", rf"(?:(?!{_LATER})\p{{N}})"
        self.later_piece = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|{letter}+|{number}|(?:{_LATER}|[^\s\p{{L}}\p{{N}}])+")
        letters = _byte_letters()
        #: Symbols 0 to 255: bytes; 256 more: bytes that end a word.
        self.base = np.array([vocab[c] for c in letters] + [vocab[c + self.mark] for c in letters], dtype=np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        #: The rank of a merge by its pair, as one number, and the token that the merge of each rank makes.
        self.rank = {vocab[a] << 20 | vocab[b]: r for r, (a, b) in enumerate(merges)}
        self.made = np.array([vocab[a + b] for _, (a, b) in zip(self.rank, merges, strict=True)], dtype=np.int64)
        self._tables(n, vocab, letters)
        self.forget()

    # What the checks look up, as arrays.

    def _tables(self, n: int, vocab: dict[str, int], letters: list[str]) -> None:
        pairs, made = np.fromiter(self.rank, np.int64, len(self.rank)), self.made
        left, right = pairs >> 20, pairs & 0xFFFFF
        self.born = np.full(n, -1, dtype=np.int64)
        self.born[made] = np.arange(len(made))
        parts = {int(t): (int(a), int(b)) for t, a, b in zip(made, left, right, strict=True)}
        # A merge comes after those that make its parts, and each token is made by one merge: else pairs prove nothing.
        self.provable = len(set(made)) == len(made) and bool((self.born[made] > np.maximum(self.born[left], self.born[right])).all())
        self.key = np.sort(pairs)
        self.key_rank = np.argsort(pairs)

        def spine(side: int) -> np.ndarray:
            """Column by token: the pieces at its edge from the whole down to a symbol (-1 beyond); each is merged away when the one above is born."""
            rows = []
            for t in range(n):
                row = [t]
                while row[-1] in parts:
                    row.append(parts[row[-1]][side])
                rows.append(row)
            out = np.full((max(map(len, rows)), n), -1, dtype=np.int32)
            for t, row in enumerate(rows):
                out[: len(row), t] = row
            return out

        self.right_edge, self.left_edge = spine(1), spine(0)
        stable = np.zeros(n, dtype=bool)
        stable[self.base] = True
        fine = self._compatible(left, right, skip_top=True)
        for t, a, b, ok in zip(made, left, right, fine, strict=True):
            stable[t] = ok and stable[a] and stable[b]
        self.stable = stable
        # Vocabulary by the hash of its symbols.
        back = {c: b for b, c in enumerate(letters)}
        known: dict[int, int] = {}
        self.longest = 1
        for t, i in vocab.items():
            ends = t.endswith(self.mark)
            symbols = [back[c] for c in (t[: -len(self.mark)] if ends else t)]
            if symbols:
                symbols[-1] += 256 * ends
                self.longest = max(self.longest, len(symbols))
                known[self._hash_one(symbols)] = i
        order = sorted(known)
        self.hashes, self.ids = np.array(order, dtype=np.uint64), np.array([known[h] for h in order], dtype=np.int64)

    @staticmethod
    def _hash_one(symbols: list[int]) -> int:
        h = 0
        for s in symbols:
            h = (h * 0x9E3779B97F4A7C15 + s * 0xD6E8FEB86659FD93 + 0x632BE59BD9B4E019) % (1 << 64)
        return h

    def _rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        want = a.astype(np.int64) << 20 | b
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return np.where((a >= 0) & (b >= 0) & (self.key[at] == want), self.key_rank[at], NEVER)

    def _compatible(self, a: np.ndarray, b: np.ndarray, skip_top: bool = False) -> np.ndarray:
        """Whether no merge across the border of tokens a and b would come before one within them.

        Pieces x at a's right edge and y at b's left edge meet if both last until rank(x, y). The leftmost of equal
        pairs merges first, so a tie goes to a's own merge and against b's.
        """
        ok = np.ones(len(a), dtype=bool)
        redge, ledge = self.right_edge, self.left_edge
        gone = lambda edge, i, t: self.born[edge[i - 1][t]] if i else NEVER
        for i in range(len(redge)):
            some = np.flatnonzero(redge[i][a] >= 0)
            for j in range(len(ledge)):
                if skip_top and i == j == 0:
                    continue
                at = some[(ledge[j][b[some]] >= 0) & ok[some]]
                if len(at):
                    r = self._rank_of(redge[i][a[at]], ledge[j][b[at]])
                    ok[at[(r < NEVER) & (r < gone(redge, i, a[at])) & (r <= gone(ledge, j, b[at]))]] = False
        return ok

    # Words.

    def _propose(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Greedy longest matches: tokens, the word of each, in order; and the words that have none somewhere."""
        size = np.array([len(w) for w in words])
        off = np.concatenate([[0], np.cumsum(size)])
        sym = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int64)
        sym[off[1:] - 1] += 256
        value = sym.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(0x632BE59BD9B4E019)
        at, live = off[:-1].copy(), np.arange(len(words))
        tokens, owner, order, step = [], [], [], 0
        lost = np.zeros(len(words), dtype=bool)
        while len(live):
            best, length = np.full(len(live), -1), np.zeros(len(live), dtype=np.int64)
            h, p, end = np.zeros(len(live), dtype=np.uint64), at[live], off[live + 1]
            for n in range(1, self.longest + 1):
                on = np.flatnonzero(p + n <= end)
                if not len(on):
                    break
                h[on] = h[on] * np.uint64(0x9E3779B97F4A7C15) + value[p[on] + n - 1]
                k = np.minimum(np.searchsorted(self.hashes, h[on]), len(self.hashes) - 1)
                hit = self.hashes[k] == h[on]
                best[on[hit]], length[on[hit]] = self.ids[k[hit]], n
            none = best < 0
            lost[live[none]] = True
            tokens.append(best[~none]), owner.append(live[~none]), order.append(np.full((~none).sum(), step))
            at[live] += length
            live, step = live[~none & (p + length < end)], step + 1
        tokens, owner, order = map(np.concatenate, (tokens, owner, order))
        by = np.lexsort((order, owner))
        return tokens[by], owner[by], lost

    def _merge_long(self, word: bytes) -> list[int]:
        """Exact merging of one word: the leftmost pair of the lowest rank, again and again, from a heap."""
        ids = self.base[np.frombuffer(word, dtype=np.uint8)].tolist()
        ids[-1] = int(self.base[256 + word[-1]])
        n = len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := self.rank.get(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.made[r]), -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (r := self.rank.get(ids[x] << 20 | ids[y])) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return [i for i in ids if i >= 0]

    def _merge(self, words: list[bytes]) -> list[list[int]]:
        """Exact merging of many short words side by side, a merge of each at a time."""
        size = np.array([len(w) for w in words])
        deep = int(size.max())
        ids = np.full((len(words), deep), -1, dtype=np.int64)
        ids[np.arange(deep) < size[:, None]] = np.frombuffer(b"".join(words), dtype=np.uint8)
        row = np.arange(len(words))
        ids[row, size - 1] += 256
        ids = np.where(ids >= 0, self.base[ids], -1)
        # One more column, without symbol, is where links beyond either end lead.
        ids = np.concatenate([ids, np.full((len(words), 1), -1)], axis=1)
        after = np.tile(np.minimum(np.arange(1, deep + 2), deep), (len(words), 1))
        before = np.tile(np.where(np.arange(deep + 1) > 0, np.arange(deep + 1) - 1, deep), (len(words), 1))
        rank = np.full(ids.shape, NEVER)
        rank[:, :-1] = self._rank_of(ids[:, :-1], ids[:, 1:])
        live = row
        while len(live):
            i = rank[live].argmin(axis=1)
            r = rank[live, i]
            go = r < NEVER
            live, i, r = live[go], i[go], r[go]
            j = after[live, i]
            k = after[live, j]
            ids[live, i], ids[live, j] = self.made[r], -1
            after[live, i], rank[live, j] = k, NEVER
            before[live, k] = i
            h = before[live, i]
            rank[live, i] = self._rank_of(ids[live, i], ids[live, k])
            rank[live, h] = self._rank_of(ids[live, h], ids[live, i])
            rank[live, deep] = NEVER
        return [[x for x in line if x >= 0] for line in ids.tolist()]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of each distinct non-empty word."""
        if not words:
            return []
        failed = np.ones(len(words), dtype=bool)
        tokens, owner = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if self.provable:
            tokens, owner, failed = self._propose(words)
            failed[owner[~self.stable[tokens]]] = True
            beside = np.flatnonzero(owner[1:] == owner[:-1])
            pair, back = np.unique(tokens[beside] << 20 | tokens[beside + 1], return_inverse=True)
            failed[owner[beside[~self._compatible(pair >> 20, pair & 0xFFFFF)[back]]]] = True
        cuts = np.searchsorted(owner, np.arange(len(words) + 1)).tolist()
        tokens = tokens.tolist()
        out = [[] if bad else tokens[a:b] for bad, a, b in zip(failed.tolist(), cuts, cuts[1:], strict=False)]
        again = sorted(np.flatnonzero(failed).tolist(), key=lambda i: len(words[i]))
        for at in range(0, len(again), 4096):
            some = again[at : at + 4096]
            short = [i for i in some if len(words[i]) <= SHORT]
            if short:
                for i, ids in zip(short, self._merge([words[i] for i in short]), strict=True):
                    out[i] = ids
            for i in some[len(short) :]:
                out[i] = self._merge_long(words[i])
        return out

    # Texts.

    def _normal(self, part: str) -> str:
        if not part.isascii():
            part = unicodedata.normalize("NFC", part)
            part = part.translate(NEWER) if _NEWER.search(part) else part
        return part.lower()

    def forget(self) -> None:
        """Ends a task: the worker keeps the tables, but not the words, which take several times as much memory.

        Words are numbered: the ids of word r stand in `flat` from cuts[r] to cuts[r + 1], and `uses` counts the pieces
        of text it was in. The first numbers are the special tokens'.
        """
        self.words: dict[str, int] = {}
        self.flat = np.array(list(self.special.values()), dtype="<u4")
        self.cuts = np.arange(len(self.special) + 1)
        self.uses = np.zeros(len(self.special), dtype=np.int64)

    def _learn(self, chunks: dict[str, int]) -> None:
        """Remember ids of chunks, which hold no white space; no piece crosses white space."""
        new = [c for c in chunks if c not in self.words]
        if not new:
            return
        distinct: dict[str, int] = {}
        parts, size = [], []
        for c in new:
            found = (self.later_piece if not c.isascii() and self.later.search(c) else self.piece).findall(c)
            parts += [distinct.setdefault(p, len(distinct)) for p in found]
            size.append(len(found))
        ids = self.encode_words([p.encode() for p in distinct])
        cuts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))])
        flat, own = _runs(np.fromiter(chain.from_iterable(ids), np.dtype("<u4"), cuts[-1]), cuts, np.array(parts, dtype=np.int64))
        self.words.update(zip(new, range(len(self.uses), len(self.uses) + len(new)), strict=True))
        self.cuts = np.concatenate([self.cuts, len(self.flat) + own[np.cumsum(size)]])
        self.flat = np.concatenate([self.flat, flat])
        self.uses = np.concatenate([self.uses, np.zeros(len(new), dtype=np.int64)])

    def _trim(self) -> None:
        """Of too many words keeps the half that most pieces used, late ones rather than early ones; old uses count half."""
        if len(self.uses) <= REMEMBERED and len(self.flat) <= 16 * REMEMBERED:
            return
        words, rows = list(self.words), np.fromiter(self.words.values(), np.int64, len(self.words))
        best = np.sort(np.lexsort((rows, self.uses[rows]))[len(rows) - min(len(rows), REMEMBERED // 2) :])
        kept = np.concatenate([np.arange(len(self.special)), rows[best]])
        self.words = dict(zip([words[i] for i in best.tolist()], range(len(self.special), len(kept)), strict=True))
        self.flat, self.cuts = _runs(self.flat, self.cuts, kept)
        self.uses = self.uses[kept] >> 1

    def encode_runs(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one text after the other, and the cuts between texts; null is empty."""
        place = {t: i for i, t in enumerate(self.special)}
        first: dict[str, int] = {}  # where each chunk stands first
        stands, size, specials, n = [], [], [], 0
        for text in texts:
            was = n
            for i, part in enumerate(self.split.split(text or "") if self.split else [text or ""]):
                if i % 2:
                    stands.append(np.array([n]))
                    specials.append((n, place[part]))
                    n += 1
                else:
                    own = self.chunks(self._normal(part))
                    stands.append(np.fromiter(map(first.setdefault, own, range(n, n + len(own))), np.int64, len(own)))
                    n += len(own)
            size.append(n - was)
        self._learn(first)
        rows = np.fromiter(map(self.words.__getitem__, first), np.int64, len(first))
        self.uses[rows] += 1
        number = np.zeros(n, dtype=np.int64)
        number[np.fromiter(first.values(), np.int64, len(first))] = rows
        for at, r in specials:
            number[at] = r
        ids, cuts = _runs(self.flat, self.cuts, number[np.concatenate(stands)] if stands else number)
        for c in [c for c in first if len(c) > LONG]:
            del self.words[c]
        self._trim()
        return ids, cuts[np.concatenate([[0], np.cumsum(size, dtype=np.int64)])]

    def decode(self, ids: np.ndarray, cuts: np.ndarray) -> pa.Array:
        """The texts that runs of ids decode to."""
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), self.texts.take(pa.array(ids))), " ")

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, str]]:
        """For each text its ids as little-endian 32-bit integers, and the decoded text."""
        ids, cuts = self.encode_runs(texts)
        return [(ids[a:b].tobytes(), t) for a, b, t in zip(cuts[:-1].tolist(), cuts[1:].tolist(), self.decode(ids, cuts).to_pylist(), strict=True)]

    #: White space as the vocabulary's patterns mean it; str.split also splits at four control characters.
    _plain = re.compile("[\x1c-\x1f]")

    def chunks(self, text: str) -> list[str]:
        if self._plain.search(text):
            return [c for c in regex.split(r"\s+", text) if c]
        return text.split()


_models: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    if path not in _models:
        _models[path] = WordBpe(path)
    return _models[path]


def vocabulary() -> str:
    """The public vocabulary's file, on whichever machine asks."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode(docs: DataFrame, text: str = "text", path: str | None = None, batch_bytes: int = PIECE) -> DataFrame:
    """`docs` with n_tokens, ids (32-bit integers) and decoded. Each task reads the vocabulary file where it runs.

    Null and empty texts have no ids and decode to the empty text. Repeated rows and extra columns stay; columns named
    n_tokens, ids or decoded are replaced. There is no shuffle; long texts are taken one at a time.
    """
    kept = [f for f in docs.schema.fields if f.name not in ("n_tokens", "ids", "decoded")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "n_tokens long, ids binary, decoded string"])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path or vocabulary())
        for batch in batches:
            for part, ids, cuts in encoded_parts(batch, text, model, batch_bytes):
                packed = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer((cuts * 4).astype(np.int32)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.diff(cuts)), packed, model.decode(ids, cuts)], names=[*names, "n_tokens", "ids", "decoded"])
        model.forget()

    small_batches(docs.sparkSession)
    return docs.select(*[f"`{n}`" for n in names]).mapInArrow(lean(run), schema)


def encoded_parts(batch: pa.RecordBatch, text: str, model: WordBpe, limit: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    column = batch.column(batch.schema.get_field_index(text))
    for a, b, _, _ in pieces(column, limit):
        yield batch.slice(a, b - a), *model.encode_runs(column.slice(a, b - a).to_pylist())


def query(spark, sf_dir: str) -> DataFrame:
    """Digests are taken in the task, so that ids and decoded texts don't travel."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(vocabulary())
        for batch in batches:
            for part, ids, cuts in encoded_parts(batch, "text", model, PIECE):
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(np.diff(cuts)),
                        pa.array([hashlib.sha256(ids[a:b]).hexdigest() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)], pa.string()),
                        pa.array([hashlib.sha256(t.as_buffer()).hexdigest() for t in model.decode(ids, cuts)], pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )
        model.forget()

    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.mapInArrow(lean(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
