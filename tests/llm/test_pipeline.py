"""The corpus pipeline against a brute-force version, stage by stage and whole."""

import collections
import hashlib
import re

import sentencepiece

import corpus_pipeline
from tidemark.llm import language, mixing, pieces
from tidemark.llm.common import table

from samples import SF001, awkward, words
from test_native import poisson_cdf
from test_near_ops import brute_classes


def brute(rows, model):
    """{(doc_id, ids): times} by plain loops; rows are (doc_id, text, lang, source)."""
    langs, score = language.scores([t for _, t, *_ in rows], model)
    rows = [r for r, name, s in zip(rows, langs, score) if name != "und" and s >= language.MIN_SCORE]
    first = {}
    for r in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or ""), r)
    rows = list(first.values())
    rows = [min((rows[k] for k in group), key=lambda r: (r[0] is None, r[0])) for group in brute_classes(rows)]
    chars = collections.Counter()
    for _, t, _, source in rows:
        chars[source] += len(t)
    weight = {s: c**mixing.ALPHA for s, c in chars.items()}
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_PATH)
    out = collections.Counter()
    for i, t, _, source in rows:
        rate = weight[source] / sum(weight.values()) * sum(chars.values()) / chars[source]
        h = hashlib.md5("|".join([mixing.SEED, "" if i is None else str(i), hashlib.md5(t.encode()).hexdigest()]).encode()).hexdigest()
        u, n = int(h[:13], 16) / 2**52, 0
        while poisson_cdf(rate, n) <= u:
            n += 1
        out[i, tuple(library.encode(t))] += n
    return +out


def as_rows(d):
    return [(r.doc_id, r.text, r.lang, r.source) for r in d.collect()]


def test_run_equals_brute_force(spark):
    d = table(spark, SF001, "documents")
    got = collections.Counter((r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, SF001).collect())
    assert got == brute(as_rows(d), language.train(d))


def test_stages_keep_the_columns_and_cope_with_awkward_rows(spark, docs):
    rows = awkward() + [(300 + k, words(60, k), "en", f"s{k % 3}") for k in range(60)] + [(400 + k, words(60, k) + " tail", "en", "s0") for k in range(60)]
    d = docs(rows)
    want = brute(rows, language.train(d))
    columns = d.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        d = corpus_pipeline.materialise(stage(spark, d, SF001), "test")
        if k + 1 < len(corpus_pipeline.STAGES):
            assert d.columns == columns, name
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in d.collect()) == want


def test_an_empty_table_goes_through(spark, docs):
    d = docs([(1, "a", "en", "s")]).filter("false")
    for name, stage in corpus_pipeline.STAGES:
        d = corpus_pipeline.materialise(stage(spark, d, SF001), "test")
    assert d.count() == 0
