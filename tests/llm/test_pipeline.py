"""The corpus pipeline's rows, against a plain program's on the same table, and on odd rows."""

from collections import Counter

import corpus_pipeline as pipeline
import numpy as np
from conftest import SMALL
from pyspark.sql import functions as F
from test_text_operators import SCHEMA, odd_rows, plain_hits, plain_join

from shelfwise.llm import bpe, langid, line_dedup
from shelfwise.llm.common import table


def test_stages():
    assert [k for k, _ in pipeline.STAGES] == ["language_id", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "bpe_encoding"]
    assert pipeline.ORACLE_SQL is None


def test_run_equals_a_plain_program(spark):
    from tokenizers import Tokenizer

    docs = table(spark, SMALL, "documents")
    pred = {r.doc_id: (r.lang_pred, r.rejected) for r in langid.identify(docs, langid.fit(docs)).collect()}
    left = [(r.doc_id, r.text, pred[r.doc_id][0], r.source) for r in docs.collect() if not pred[r.doc_id][1]]
    total, seen = Counter(s for *_, s in left), Counter()
    for _, text, _, s in left:
        seen.update({(s, x) for x in text.split("\n") if x.strip(" ")})
    drop = {k for k, n in seen.items() if n >= line_dedup.MIN_PAGES and n > line_dedup.RATIO * total[k[0]]}
    left = [(d, "\n".join(x for x in t.split("\n") if (s, x) not in drop), k, s) for d, t, k, s in left]
    groups = plain_join([(d, t) for d, t, *_ in left])
    left = [r for r in left if groups[r[0]][1] == r[0]]
    items = [(r.item_id, r.text) for r in table(spark, SMALL, "benchmark").collect()]
    hit = {r[0] for r in plain_hits([(d, t) for d, t, *_ in left], items) if r[5]}
    library = Tokenizer.from_file(bpe.vocabulary())
    want = {d: (t, k, s, len(t), library.encode(t, add_special_tokens=False).ids) for d, t, k, s in left if d not in hit}
    got = {r.doc_id: (r.text, r.lang, r.source, r.n_chars, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in pipeline.run(spark, SMALL).collect()}
    assert got == want


def test_odd_rows_go_through_every_stage(spark):
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    for frame in (docs, docs.limit(0)):
        for name, stage in pipeline.STAGES:
            frame = stage(spark, frame, SMALL).cache()
            assert frame.columns[:5] == pipeline.COLUMNS, name
            assert name == "bpe_encoding" or frame.columns == pipeline.COLUMNS
    kept = pipeline.near_copies(spark, docs, SMALL).where(F.col("doc_id") == 1)
    assert kept.count() == 1
