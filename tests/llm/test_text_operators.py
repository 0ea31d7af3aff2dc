"""Each operator against a plain program or the library it must equal, and on odd rows and empty tables."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from compare import connect, differences
from conftest import SMALL
from pyspark.sql import functions as F

from shelfwise.llm import bpe, decontaminate, kernels, langid, licences, line_dedup, near_vectors, ngram_join, sharding, suffix_dedup, toxicity
from shelfwise.llm.common import Scratch, components, table
from shelfwise.llm.queries import QUERIES, SQL

MEDIUM = "/root/testdata/sf0.1"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, n string, h string, block string, spans string"
PASSAGE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"


def odd_rows():
    """Nulls, blanks, repeats, ties, one long text, and columns named like the operators' own."""
    more = ("x", "y", "z", "w", "v")
    long = " ".join(f"word{i % 997}" for i in range(30_000))
    rows = [
        (1, PASSAGE + " tail", "en", "a", 1), (1, PASSAGE + " tail", "en", "a", 1), (2, None, "en", "a", None), (3, "", None, None, 0),
        (4, "  \n\t ", "de", "a", 3), (None, PASSAGE, "en", None, 3), (5, long, "en", "a", 9), (6, "ünï " + PASSAGE, None, "b", 2),
        (7, PASSAGE, "en", "b", 2), (8, "123 !!", "en", "b", 2), (9, "Short words", "fr", None, 2), (None, None, None, None, None),
        (10, "a\n\nb\na", "en", "a", 1),
    ]
    return [r + more for r in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="module")
def small_docs(spark):
    return [(r.doc_id, r.text) for r in table(spark, SMALL, "documents").orderBy("doc_id").collect()]


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL).toPandas(), connect(SMALL).execute(SQL[name]).df()) is None


def test_components(spark):
    random.seed(3)
    pairs = [(random.randrange(300), random.randrange(300)) for _ in range(160)] + [(i, i + 1) for i in range(1000, 1040)]
    found = {r.id: r.component for r in components(spark.createDataFrame(pairs, "a long, b long"), Scratch(spark, "t")).collect()}
    near = defaultdict(set)
    for a, b in pairs:
        near[a].add(b), near[b].add(a)
    for start in near:
        seen, todo = {start}, [start]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x), todo.append(x)
        assert found.get(start, start) == min(seen)
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t")).count() == 0


# --- line dedup, licences ---------------------------------------------------------------------------


def test_line_dedup(spark, odd):
    rows = [(i, f"menu\nown {i}\n\nmenu\nfoot{i % 40}", "s" if i < 60 else None) for i in range(80)] + [(100, "menu", "t")]
    out = line_dedup.drop_site_lines(spark.createDataFrame(rows, "id int, text string, source string")).collect()
    for r in out:
        if r.id == 100:
            assert r.text == "menu"
        else:
            assert r.text == f"own {r.id}\n\nfoot{r.id % 40}" and r.line_dedup.n_lines == 5 and r.line_dedup.n_dropped == 2
    got = line_dedup.drop_site_lines(odd)
    assert got.columns == [*odd.columns, "line_dedup"] and got.count() == 13
    by = {r.doc_id: r for r in got.where("doc_id IN (2, 3)").collect()}
    assert by[2].text is None and by[2].line_dedup.n_lines == 0 and by[3].text == "" and by[3].line_dedup.n_lines == 1
    assert line_dedup.drop_site_lines(odd.limit(0)).count() == 0


def test_licences(spark, odd):
    mit = dict(licences.KNOWN[:1])["MIT"]
    texts = {
        1: mit, 2: "Copyright 2020 A. Person\n" + mit.replace("license", "licence").upper(), 3: "# Released under the MIT  Licence\nother",
        4: "this is Released under the MIT License, they say", 5: "(c) someone", 6: None, 7: "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.",
    }
    got = {r.doc_id: r for r in licences.scan(spark.createDataFrame(list(texts.items()), "doc_id int, text string")).collect()}
    assert [got[k].whole_license for k in texts] == ["MIT", "MIT", None, None, None, None, None]
    assert [got[k].licenses for k in texts] == ["MIT", "MIT", "MIT", "", "", "", "CC-BY-NC-4.0,MIT"]
    assert got[7].n_notices == 2 and got[5].n_lines == 0
    assert licences.scan(odd).count() == 13 and licences.scan(odd.limit(0)).count() == 0


# --- decontamination ---------------------------------------------------------------------------------


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def plain_hits(docs, items):
    out = []
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - 9, 1)) if w and item is not None else ():
            windows[tuple(w[i : i + 10])].add(item)
    sizes = {len(k) for k in windows}
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[k]
        ids = ",".join(sorted(map(str, found)))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_decontamination_with_short_and_odd_items(spark, odd):
    items = [(1, PASSAGE), (2, PASSAGE), (3, "Short, WORDS"), (4, None), (5, ""), (None, "tail"), (6, "word1 word2 word3"), (7, "nine ten"), (8, "ünï")]
    frame = spark.createDataFrame(items, "item_id int, text string")
    got = decontaminate.with_hits(odd, frame)
    assert set(odd.columns) < set(got.columns)
    rows = [tuple(r) for r in got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()]
    assert sorted(rows, key=str) == plain_hits([(r[0], r[1]) for r in odd_rows()], items)
    assert decontaminate.with_hits(odd.limit(0), frame).count() == 0
    assert decontaminate.with_hits(odd, frame.limit(0)).where("contaminated").count() == 0


# --- near copies --------------------------------------------------------------------------------------


def gram_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])


def plain_join(docs):
    sets = {d: gram_set(t) for d, t in docs}
    top = {d: d for d in sets}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                k = len(sets[a] & sets[b])
                if 100 * k >= 80 * (len(sets[a]) + len(sets[b]) - k) and root(a) != root(b):
                    top[max(root(a), root(b))] = min(root(a), root(b))
    return {d: (len(s), root(d)) for d, s in sets.items()}


@pytest.mark.parametrize("narrow", [32, 1])
def test_ngram_join(spark, small_docs, monkeypatch, narrow):
    monkeypatch.setattr(ngram_join, "NARROW", narrow)
    monkeypatch.setattr(ngram_join, "SIDE", 8)
    random.seed(5)
    base = [f"w{random.randrange(10**6)}" for _ in range(120)]
    copies = [(10_000 + i, " ".join(w if random.random() > 0.004 * (i % 9) else "edit" for w in base)) for i in range(40)]
    docs = small_docs + copies + [(20_000, " ".join(base[:4])), (20_001, " ".join(base[:4])), (20_002, "solo"), (20_003, None)]
    got = {r.doc: (r.n_shingles, r.component_id) for r in ngram_join.join(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == plain_join(docs)


def test_ngram_join_of_odd_rows(odd):
    got = ngram_join.join(odd).collect()
    assert len(got) == 13 and {r.component_id for r in got if r.doc == 1} == {1} and {r.component_id for r in got if r.doc == 7} == {1}
    assert {(r.n_shingles, r.component_id) for r in got if r.doc in (2, 3, 4)} == {(0, 2), (0, 3), (0, 4)}
    assert all(r.component_id is None for r in got if r.doc is None)
    assert ngram_join.join(odd.limit(0)).count() == 0


# --- suffixes -----------------------------------------------------------------------------------------


def plain_suffixes(docs, n=50):
    first, out = {}, {}
    for d, text in sorted(docs):
        b = (text or "").encode()
        for i in range(len(b) - n + 1):
            first.setdefault(b[i : i + n], d)
    for d, text in docs:
        b = (text or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - n + 1):
            if first[b[i : i + n]] < d:
                gone[i : i + n] = [True] * n
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[d] = (len(b), sum(gone), runs, bytes(c for c, g in zip(b, gone, strict=True) if not g))
    return out


@pytest.mark.parametrize("frequent", [11, 1])
def test_suffixes(spark, small_docs, frequent):
    random.seed(8)
    passage = "".join(random.choice("abcdé ") for _ in range(200))
    mixed = [(1000 + i, "".join(random.choice("xyzü") for _ in range(random.randrange(60))) + passage[i : i + 48 + 7 * i] + "q" * (i % 60)) for i in range(30)]
    docs = small_docs[:80] + mixed + [(2000, "a" * 300), (2001, "a" * 49), (2002, "a" * 120), (2003, None), (2004, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.covered(frame, frequent=frequent).collect()}
    assert got == plain_suffixes(docs)


def test_suffixes_of_odd_rows(odd):
    rows = suffix_dedup.covered(odd).collect()
    assert len(rows) == 13
    assert [r.n_removed for r in rows if r.doc == 1] == [0, 0]
    assert all(r.n_removed == r.n_bytes for r in rows if r.doc is None or r.doc == 7)
    assert suffix_dedup.covered(odd.limit(0)).count() == 0


def test_multikey_labels():
    random.seed(1)
    data = np.array([random.choice([97, 98]) for _ in range(3000)], dtype=np.uint8)
    start = np.arange(2900)
    label = suffix_dedup.multikey(data, start, 50)
    text = [bytes(data[i : i + 50]) for i in start]
    assert [text[i] for i in np.argsort(label, kind="stable")] == sorted(text)
    assert len({(x, y) for x, y in zip(label, text, strict=True)}) == len(set(label)) == len(set(text))


# --- vectors ------------------------------------------------------------------------------------------


def test_vectors(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "SIDE", 16)
    base = table(spark, MEDIUM, "embeddings").where("label < 4").orderBy("vec_id").limit(500).collect()
    r = np.random.default_rng(2)
    rows = [(v.vec_id, v.embedding, v.label) for v in base]
    centre = np.array(base[0].embedding)
    spread = [0.02 if i < 70 else 0.045 for i in range(110)]
    rows += [(10_000 + i, (centre + s * r.standard_normal(64)).astype(np.float32).tolist(), base[0].label) for i, s in enumerate(spread)]
    rows += [(20_000 + i, base[5 + i % 3].embedding, base[5 + i % 3].label) for i in range(30)]
    rows += [(30_000 + i, (0.5 * np.array(base[9 + i].embedding)).tolist(), base[9 + i].label) for i in range(5)]
    bad = [(40_000, None, 1), (40_001, [0.0] * 64, 1), (40_002, [float("nan")] * 64, 1), (40_003, base[0].embedding, None), (40_004, [], 1)]
    bad += [(40_005, [None, *base[0].embedding[1:]], base[0].label), (40_006, base[0].embedding[:63], base[0].label), (40_007, [float("inf")] * 64, 1)]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, label int").withColumn("n", F.lit("x"))
    got = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in near_vectors.link(frame).collect()}
    x = np.array([v for _, v, _ in rows], dtype=np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids, label = np.array([i for i, *_ in rows]), np.array([k for *_, k in rows])
    link = (x @ x.T >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(link, False)
    found = sum(got[i][0] for i in ids)
    assert found >= 0.95 * link.sum() and all(got[i][0] <= n for i, n in zip(ids, link.sum(axis=1), strict=True))
    for i in [10_000, 20_000, 30_000]:
        assert got[i][1] < i and not got[i][2]
    assert all(got[i] == (0, i, True) for i, *_ in bad)
    assert len(got) == len(rows) + len(bad)
    assert near_vectors.link(frame.limit(0)).count() == 0


def brute_links(x, label, threshold=0.93):
    x = x.astype(np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = (x @ x.T >= threshold) & (label[:, None] == label)
    np.fill_diagonal(link, False)
    return link


def brute_components(link):
    low = np.arange(len(link))
    for _ in range(len(link)):
        low = np.minimum(low, np.where(link, low, len(low)).min(axis=1))
    return low


def test_vectors_of_two_families_that_meet(spark):
    """Two vectors link across families although each has more than LIST nearer ones in its own."""
    r = np.random.default_rng(11)
    around = lambda degrees: np.eye(64)[0] * np.cos(np.radians(degrees)) + np.eye(64)[1] * np.sin(np.radians(degrees))
    x = np.array([around(0)] * 12 + [around(4)] + [around(26)] * 12 + [around(22)])
    x[:, 2:] += 0.002 * r.standard_normal((26, 62))
    link = brute_links(x, np.zeros(26))
    assert link[12, 25] and link[:13, 13:].sum() == 1
    frame = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    got = {g.vec_id: (g.n_links, g.component_id) for g in near_vectors.link(frame).collect()}
    assert got == {i: (n, 0) for i, n in enumerate(link.sum(axis=1))}


def test_vectors_that_the_descent_loses(spark, monkeypatch):
    """Lost pairs beside two vectors with a thousand copies each: no descent finds them, the comparison of all does."""
    start = near_vectors.Graph._start
    monkeypatch.setattr(near_vectors.Graph, "_start", lambda self, seed: start(self, seed).where("a < 10000 AND b < 10000"))
    monkeypatch.setattr(near_vectors.Graph, "refine", lambda self: 0)
    r = np.random.default_rng(12)
    base = r.standard_normal((11, 64))
    x = np.repeat(base, 2, axis=0) + 0.05 * r.standard_normal((22, 64))
    link = brute_links(x, np.zeros(22))
    assert link.sum() == 22
    rows = [(1000 * k + i, x[k].tolist(), 0) for k in range(2) for i in range(1000)] + [(10_000 + k, x[k].tolist(), 0) for k in range(2, 22)]
    got = {g.vec_id: (g.n_links, g.component_id) for g in near_vectors.link(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    assert all(got[i] == (1999, 0) for i in range(2000))
    assert all(got[10_000 + k] == (1, 10_000 + k - k % 2) for k in range(2, 22))


def test_vectors_are_audited_by_label(spark, monkeypatch):
    """Only the label whose descent lost its links is descended again and then compared whole."""
    start, compared, descended, met = near_vectors.Graph._start, near_vectors._compared, [], []

    def lossy_start(self, seed):
        descended.append(self.total)
        return start(self, seed).where("a < 10000 AND b < 10000")

    def seen(rows, vectors, threshold):
        met.append(rows.count())
        return compared(rows, vectors, threshold)

    monkeypatch.setattr(near_vectors.Graph, "_start", lossy_start)
    monkeypatch.setattr(near_vectors.Graph, "refine", lambda self: 0)
    monkeypatch.setattr(near_vectors, "_compared", seen)
    r = np.random.default_rng(14)
    x = np.repeat(r.standard_normal((30, 64)), 2, axis=0) + 0.05 * r.standard_normal((60, 64))
    ids, label = np.array([*range(40), *range(10_000, 10_020)]), np.array([0] * 40 + [1] * 20)
    link = brute_links(x, label)
    assert link.sum() == 60
    frame = spark.createDataFrame([(int(i), v.tolist(), int(k)) for i, v, k in zip(ids, x, label, strict=True)], "vec_id long, embedding array<float>, label int")
    got = {g.vec_id: (g.n_links, g.component_id) for g in near_vectors.link(frame).collect()}
    assert got == {int(i): (1, int(i) - int(i) % 2) for i in ids}
    # All vectors, then those of label 1; nothing is full at first, both are audited, then label 1, which is whole at last.
    assert descended == [60, 20] and met == [0, 60, 0, 20, 20]


def test_meetings_of_many_at_once():
    r = np.random.default_rng(15)
    sizes = [1, 2, 16, 9, *r.integers(1, 17, 1200)]
    a = np.repeat(np.arange(len(sizes)) * 3 - 50, sizes)
    ids, x, worst = r.permutation(len(a)) - 40, r.standard_normal((len(a), 8)), r.choice([-2.0, 0.1], len(a))
    mixed = r.permutation(len(a))
    table = pa.table({"a": a[mixed], "id": ids[mixed], "vec": pa.array(list(x[mixed])), "worst": worst[mixed]})
    got = near_vectors._best_of_meetings(table).to_pylist()
    unit, want = x / np.linalg.norm(x, axis=1, keepdims=True), set()
    for m in np.unique(a):
        own = np.flatnonzero(a == m)
        for i in own:
            nearest = sorted((j for j in own if j != i), key=lambda j: -(unit[i] @ unit[j]))[: near_vectors.LIST]
            want |= {(ids[i], ids[j]) for j in nearest if unit[i] @ unit[j] > worst[i]}
    assert {(g["a"], g["b"]) for g in got} == want and len(got) == len(want)
    assert near_vectors._best_of_meetings(table.filter(pa.array(a[mixed] == -50))).num_rows == 0


def test_vectors_of_one_id(spark):
    """Rows of one id are one vector: repeated, it does not link with itself; of different ones one counts, for all rows."""
    one, near, other = [1.0, 0.0, 0.0], [1.0, 0.1, 0.0], [0.0, 0.0, 1.0]
    rows = [(1, one, 0), (1, one, 0), (2, near, 0), (3, other, 0), (3, other, 0), (4, one, 0), (4, other, 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(tuple(g) for parts in (1, 5) for g in near_vectors.link(frame.repartition(parts)).collect())
    with_one = [(1, 2, 1, True)] * 2 + [(2, 2, 1, False)] + [(3, 0, 3, True)] * 2 + [(4, 2, 1, False)] * 2
    with_other = [(1, 1, 1, True)] * 2 + [(2, 1, 1, False)] + [(3, 1, 3, True)] * 2 + [(4, 1, 3, False)] * 2
    assert got in (sorted(2 * with_one), sorted(2 * with_other))


# --- sharding -----------------------------------------------------------------------------------------


def test_sharding(spark, odd):
    frame = spark.range(20_000).repartition(7).union(spark.range(50)).withColumn("shard", F.lit("old"))
    out = sharding.uniform_shards(frame, 16, run=300).toPandas()
    sizes = out.groupby("shard").size()
    assert len(out) == 20_050 and sizes.max() - sizes.min() <= 1
    assert all(sorted(g["slot"]) == list(range(len(g))) for _, g in out.groupby("shard"))
    assert sorted(out["id"]) == sorted([*range(20_000), *range(50)])
    # Uniform: neighbours part, and every shard gets its share of every stretch.
    stretch = out[out["id"] < 20_000].groupby([out["id"] // 2000, "shard"]).size()
    assert stretch.min() > 70 and stretch.max() < 190
    other = sharding.uniform_shards(frame, 16, seed=9, run=300).toPandas()
    assert not other.sort_values("id")["shard"].reset_index(drop=True).equals(out.sort_values("id")["shard"].reset_index(drop=True))
    assert sharding.uniform_shards(odd, 4).count() == 13 and sharding.uniform_shards(odd.limit(0), 4).count() == 0


# --- tokens -------------------------------------------------------------------------------------------


def test_bpe_equals_the_library(spark, odd, small_docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.vocabulary())
    random.seed(4)
    texts = [t for _, t in small_docs] + [r[1] or "" for r in odd_rows()]
    texts += ["", "a<|endoftext|>b", " <|startoftext|>", "<|ENDOFTEXT|>", "hahahahahahaha", "x" * 3000, "it's they'LL", "ΟΔΟΣ İ", "a\x1cb\x85c　d"]
    letters = "aabcdeinorstéüß' \n!?1🙂Σ́"
    texts += ["".join(random.choice(letters) for _ in range(random.randrange(80))) for _ in range(3000)]
    for text, (ids, decoded) in zip(texts, bpe.load(bpe.vocabulary()).encode(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want and decoded == library.decode(want, skip_special_tokens=False)
    got = bpe.encode(odd)
    assert got.count() == 13 and set(odd.columns) < set(got.columns)
    assert [r.n_tokens for r in got.where("doc_id IN (2, 3, 4)").collect()] == [0, 0, 0]
    assert bpe.encode(odd.limit(0)).count() == 0
    one = QUERIES["op9_bpe_encoding_and_decoding"](spark, SMALL).where("doc_id = 0").first()
    want = library.encode(small_docs[0][1], add_special_tokens=False).ids
    assert one.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()


def test_bpe_workers_forget_their_words(spark):
    """Workers are handed on to the next stage, whose tasks need the memory."""
    texts = spark.range(4000, numPartitions=8).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 40), i -> concat('word', id * 40 + i))) AS text")
    assert bpe.encode(texts).where("n_tokens > 40").count() == 4000

    def remembered(batches):
        from shelfwise.llm import bpe as there  # the worker's own, not a copy of this process's

        list(batches)
        yield pa.RecordBatch.from_arrays([pa.array([len(m.words) for m in there._models.values()], pa.int64())], names=["n"])

    found = [r.n for r in spark.range(8, numPartitions=8).mapInArrow(remembered, "n long").collect()]
    assert found and not any(found)


def test_bpe_remembers_words_in_little_memory():
    """Beyond REMEMBERED words go, seldom used ones first, and long ones at once; what is left takes little memory."""
    model = bpe.WordBpe(bpe.vocabulary())
    piece = lambda k: [" ".join([*(f"often{i}" for i in range(50)), *(f"w{k}x{i}" for i in range(n, n + 2500)), "long" * 40]) for n in range(0, 25_000, 2500)]
    first = model.encode(piece(0))
    tracemalloc.start()
    try:
        for k in range(1, 12):
            model.encode(piece(k))
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert held < 50e6 and len(model.words) <= bpe.REMEMBERED
    assert all(f"often{i}" in model.words for i in range(50)) and "long" * 40 not in model.words
    assert "w0x0" not in model.words and model.encode(piece(0)) == first


def test_bpe_s_tables_take_little_memory():
    """Each worker has them."""
    tracemalloc.start()
    try:
        model = bpe.WordBpe(bpe.vocabulary())
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert held < 42e6
    assert model.encode(["The cat's 12 hats"]) == bpe.load(bpe.vocabulary()).encode(["The cat's 12 hats"])


@pytest.mark.parametrize("operator", ["bpe", "langid"])
def test_workers_get_texts_in_small_batches(spark, operator):
    """A batch of 10,000 texts would be held by the JVM, in buffers of twice its size, and by the worker."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    texts = spark.range(4000, numPartitions=1).selectExpr("id AS doc_id", "repeat('many words ', 500) AS text", "'en' AS lang")

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    spark.conf.unset(setting)
    try:
        bpe.encode(texts) if operator == "bpe" else langid.fit(texts.limit(8))
        got = [r.n for r in texts.mapInArrow(sizes, "n long").collect()]
        assert sum(got) > 20e6 and max(got) < 5e6
        spark.conf.set(setting, "1m")
        bpe.encode(texts) if operator == "bpe" else langid.fit(texts.limit(8))
        assert spark.conf.get(setting) == "1m"
    finally:
        spark.conf.unset(setting)


def test_workers_give_back_what_a_group_took(monkeypatch):
    calls = []
    monkeypatch.setattr(kernels, "give_back", lambda: calls.append(1))
    table = pa.table({"a": [1]})
    assert kernels.lean_group(lambda x: x)(table) is table and kernels.lean_cogroup(lambda x, y: y)(None, table) is table and len(calls) == 2
    run = kernels.lean(lambda batches: batches)(iter([1, 2]))
    assert next(run) == 1 and len(calls) == 3
    assert list(run) == [2] and len(calls) == 4


def test_bpe_knows_the_library_s_letters():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.vocabulary())
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{chr(c)}b{chr(c)}{chr(c)}" for c in points[a : a + 2000]) for a in range(0, len(points), 2000)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = [np.frombuffer(ids, "<u4").tolist() for ids, _ in bpe.load(bpe.vocabulary()).encode(texts)]
    assert got == want


def test_bpe_merges_side_by_side_and_one_by_one_alike():
    model = bpe.load(bpe.vocabulary())
    random.seed(6)
    words = ["".join(random.choice("abehinorst") for _ in range(random.randrange(1, 40))).encode() for _ in range(500)]
    assert model._merge(words) == [model._merge_long(w) for w in words] == model.encode_words(words)


# --- classifiers --------------------------------------------------------------------------------------


def test_language(spark, odd):
    truth = {r.doc_id: r.lang for r in table(spark, MEDIUM, "documents").select("doc_id", "lang").collect()}
    rows = QUERIES["op5_language_id"](spark, MEDIUM).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) > 0.99 * len(held) and sum(r.rejected for r in rows) < 0.001 * len(rows)
    model = langid.fit(table(spark, SMALL, "documents"))
    got = langid.identify(odd, model).collect()
    assert len(got) == 13 and all(0 <= r.score <= 1 for r in got)
    assert all((r.lang_pred == "und") == (not re.search(r"[^\W\d_]", r.text or "")) for r in got)
    assert all(r.rejected for r in got if r.lang_pred == "und")
    assert langid.identify(odd.limit(0), model).count() == 0
    assert {r.lang_pred for r in langid.identify(odd, langid.fit(odd.limit(0))).collect()} == {"und"}
    far = spark.createDataFrame([(1, "Быстрая лиса прыгает через ленивую собаку много раз подряд")], "doc_id int, text string")
    assert langid.identify(far, model).first().rejected


def test_toxicity(spark, odd):
    truth = {r.doc_id: r.toxic for r in table(spark, MEDIUM, "labels").collect()}
    rows = QUERIES["op1_toxicity"](spark, MEDIUM).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) for r in rows)
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    bad, good = [s for s, y in held if y], [s for s, y in held if not y]
    wins = sum((a > b) + 0.5 * (a == b) for a in bad for b in good)
    assert wins > 0.94 * len(bad) * len(good)
    small = table(spark, SMALL, "documents").join(table(spark, SMALL, "labels"), "doc_id")
    scorer = toxicity.fit(small)
    got = toxicity.score(odd, scorer).collect()
    assert len(got) == 13 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(odd.limit(0), scorer).count() == 0
    assert {r.predicted for r in toxicity.score(odd, toxicity.fit(small.limit(0))).collect()} == {0}


def test_toxicity_does_not_depend_on_partitions(spark):
    """Sums are of whole numbers, so the order in which rows and words come is of no matter."""
    rows = table(spark, SMALL, "documents").join(table(spark, SMALL, "labels"), "doc_id").select("doc_id", "text", "toxic")
    scores = []
    for n in (3, 13):
        frame = rows.repartition(n)
        scores.append({r.doc_id: r.score for r in toxicity.score(frame, toxicity.fit(frame)).collect()})
    assert len(scores[0]) > 50 and scores[0] == scores[1]


def test_toxicity_reads_words_to_their_end(spark):
    """Classes that differ only after the tenth byte of a word, and texts of a script without spaces."""
    tails = (("grund", "boden", "stein"), ("feind", "hasser", "luder"))
    rows = [(100 * c + i, f"gemeinsamer gemeinsame{tails[c][i % 3]} und", c) for c in (0, 1) for i in range(60)]
    rows += [(1000 + 100 * c + i, "\u4eca\u65e5\u5929\u6c14\u5f88" + ("\u597d\u770b" if c else "\u7cdf\u7cd5") + "\u5462", c) for c in (0, 1) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    truth = {i: c for i, _, c in rows}
    got = toxicity.score(frame.drop("toxic"), toxicity.fit(frame)).collect()
    assert len(got) == len(rows)
    for script in (False, True):
        own = [r for r in got if (r.doc_id >= 1000) == script]
        assert min(r.score for r in own if truth[r.doc_id]) > max(r.score for r in own if not truth[r.doc_id])


def test_toxicity_sends_packed_words(spark):
    """What is written last needs no row a word and piece: pieces and buckets of words exchange packed lists."""
    rows = table(spark, SMALL, "documents").join(table(spark, SMALL, "labels"), "doc_id").select("doc_id", "text", "toxic")
    plan = toxicity.score(rows.drop("toxic"), toxicity.fit(rows))._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" in plan and "Join" not in plan and "Generate" not in plan


@pytest.mark.parametrize("bits", [1, 4])
def test_toxicity_words_come_back_to_their_place(bits):
    texts = pa.array(["b\u00fcro word word longer", None, "", "word zz " + "x" * 70_000, "a b c d e f g h"])
    ((_, _, words, _, _),) = toxicity._dictionaries(texts)
    place, sent = toxicity._sent(words, bits)
    code, start, end, w, cuts = toxicity._received([x for x in sent if x])
    assert toxicity._cut_out(code, start, end).to_pylist() == words.take(pa.array(place)).to_pylist()
    assert len(sent) == 1 << bits and cuts[-1] == len(words) == len(set(w.tolist())) and (np.diff(w >> np.uint64(64 - bits)).view(np.int64) >= 0).all()
    for x in (w, place.astype(np.uint16), np.zeros(0, np.int32)):
        assert (toxicity._unpack(toxicity._pack(x), x.dtype) == x).all()
