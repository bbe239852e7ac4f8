"""Positional index and decontamination against plain loops."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tidemark.llm import decontamination, postings, registry
from tidemark.llm.common import table

from samples import SF001, awkward, words


def cut(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(rows, items, slop=0, window=10):
    """[(doc_id, n_words, n_hit, item ids)]"""
    out = []
    for i, text, *_ in rows:
        w = cut(text)
        at = {}
        for k, x in enumerate(w):
            at.setdefault(x, []).append(k)
        hit, found = set(), set()
        for item, body in items:
            b = cut(body)
            width = min(window, len(b))
            for p in range(len(b) - width + 1 if b else 0):
                phrase = b[p : p + width]
                rare = min(range(width), key=lambda k: len(at.get(phrase[k], ())))
                starts = {x + d - rare for x in at.get(phrase[rare], ()) for d in range(-slop, slop + 1)}
                for s in starts:
                    if 0 <= s and s + width <= len(w) and all(any(abs(x - s - k) <= slop for x in at.get(phrase[k], ())) for k in range(width)):
                        hit.update(range(s, s + width))
                        if item is not None:
                            found.add(str(item))
        out.append((i, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


def got(frame):
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r.items)) for r in frame.collect()), key=str)


def items_of(spark, rows, clashing=False):
    if clashing:
        return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], "item_id bigint, text string, block string, words string, piece int")
    return spark.createDataFrame(rows, "item_id bigint, text string")


def test_query_equals_plain_loops(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF001, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF001, "benchmark").collect()]
    want, near = brute(rows, items), {i: len(x) for i, _, _, x in brute(rows, items, decontamination.NEAR)}
    found = registry.op12_decontamination(spark, SF001).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found), key=str) == sorted(
        ((i, n, h, len(x), hashlib.sha256(",".join(x).encode()).hexdigest(), h > 0) for i, n, h, x in want), key=str
    )
    assert {r.doc_id: r.n_near for r in found} == near
    assert any(h for _, _, h, _ in want) and any(not h for _, _, h, _ in want)


AWKWARD_ITEMS = [
    (1, None), (2, ""), (3, "... !"), (4, "X"), (None, words(300, 1)), (11, words(300, 1)[40:400]), (11, words(300, 1)[40:400]),
    (12, "one two three"), (100, "é́ ﬁ ½"), (13, words(30000, 5)), (14, "aa " * 40), (15, "ONE-two\tThree four"), (16, "the end of"),
]
MORE = [
    (20, "one two three", "en", "s"), (21, "zero one two", "en", "s"), (22, "three one two two three four ONE two THREE four", "en", "s"),
    (23, "aa " * 25, "en", "s"), (24, "aa " * 9, "en", "s"), (25, words(300, 1)[100:300].upper(), "en", "s"), (26, "the", "en", "s"), (27, "end of", "en", "s"),
]


@pytest.mark.parametrize("block_words", [3, 500, postings.BLOCK_WORDS])
def test_awkward_rows_in_blocks_of_any_size(spark, docs, block_words):
    rows = awkward() + MORE
    index = postings.build_index(docs(rows, clashing=True), block_words)
    found = decontamination.decontaminate(None, items_of(spark, AWKWARD_ITEMS, clashing=True), index=index)
    assert got(found) == brute(rows, AWKWARD_ITEMS)


def test_items_in_parts_and_pieces(spark, docs, monkeypatch):
    monkeypatch.setattr(decontamination, "PIECE", 7)
    monkeypatch.setattr(decontamination, "WINDOWS_AT_ONCE", 5)
    monkeypatch.setattr(decontamination, "PLACES_AT_ONCE", 3)
    rows = awkward()[:6] + MORE + [(30 + k, words(60, k) + " " + words(40, k % 3), "en", "s") for k in range(8)]
    items = [(k, words(60, k)) for k in range(5)] + AWKWARD_ITEMS[:9]
    index = postings.build_index(docs(rows), 200)
    found = decontamination.find_items(index, items_of(spark, items), part_bytes=600)
    assert len(found.inputFiles()) > 1
    monkeypatch.setattr(decontamination, "PART_BYTES", 600)
    assert got(decontamination.decontaminate(None, items_of(spark, items), index=index)) == brute(rows, items)


def test_neighbourhoods(spark, docs):
    rows = MORE + [(40, "one x two three", "en", "s"), (41, "three two one", "en", "s"), (42, "one x x x two three", "en", "s"), (43, "two three", "en", "s"), (44, "two one three four", "en", "s")]
    items = [(12, "one two three"), (15, "one two three four"), (16, "the end of")]
    index = postings.build_index(docs(rows), 5)
    for slop in (1, 2):
        assert got(decontamination.decontaminate(None, items_of(spark, items), slop=slop, index=index)) == brute(rows, items, slop)
    near = {r.doc_id: tuple(r.items) for r in decontamination.decontaminate(None, items_of(spark, items), slop=1, index=index).collect()}
    assert near[40] == ("12",) and near[44] == ("12", "15") and near[42] == () and near[26] == () and near[27] == ()
    exact = {r.doc_id: tuple(r.items) for r in decontamination.decontaminate(None, items_of(spark, items), index=index).collect()}
    assert all(set(exact[i]) <= set(near[i]) for i in exact)
    with pytest.raises(ValueError):
        decontamination.find_items(index, items_of(spark, items), slop=postings.GAP)


def test_empty_tables(spark, docs):
    none, some = docs([(1, "a", "en", "s")]).filter("false"), docs(MORE)
    assert decontamination.decontaminate(none, items_of(spark, AWKWARD_ITEMS)).count() == 0
    clean = got(decontamination.decontaminate(some, items_of(spark, AWKWARD_ITEMS).filter("false")))
    assert len(clean) == len(MORE) and not any(h or x for _, _, h, x in clean)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="ab c", max_size=20), min_size=1, max_size=4), st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=4), min_size=1, max_size=4), st.integers(0, 2))
def test_a_block_against_plain_loops(texts, phrases, slop):
    block = postings.Block()
    for k, t in enumerate(texts):
        block.add(k, t.encode())
    lists = block.rows(0, pa.int64()).to_pylist()
    lists = [r for r in lists if r["term"] is not None]
    pieces = pa.table({"item_id": list(range(len(phrases))), "width": pa.array([len(p) for p in phrases], pa.int32()), "words": phrases})
    own = decontamination.Phrases(pieces)
    found = decontamination.Lists([r["term"] for r in lists], np.array([r["n"] for r in lists]), pa.array([r["postings"] for r in lists], pa.binary()), own.terms)
    hits = {}
    for d, o, a, b in zip(*decontamination.block_matches(found, own, slop)):
        hits.setdefault((int(d), int(o)), set()).update(range(a, b + 1))
    want = {}
    for d, t in enumerate(texts):
        w = t.split()
        for o, p in enumerate(phrases):
            for s in range(len(w) - len(p) + 1):
                if all(x in w[max(0, s + k - slop) : s + k + slop + 1] for k, x in enumerate(p)):
                    want.setdefault((d, o), set()).update(range(s, s + len(p)))
    assert hits == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**40), max_size=30))
def test_packed_numbers(values):
    raw, sizes = postings.packed(np.array(values, np.int64))
    assert postings.unpacked(raw).tolist() == values and len(raw) == sizes.sum()


def test_sql_on_awkward_rows(spark, docs):
    rows = [r for r in awkward() + MORE if r[1] is None or len(r[1]) < 5000]
    items = [r for r in AWKWARD_ITEMS if r[1] is None or len(r[1]) < 5000]
    db = duckdb.connect()
    for name, data, columns in (("documents", rows, "doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR"), ("benchmark", items, "item_id BIGINT, text VARCHAR")):
        db.execute(f"CREATE TABLE {name} ({columns})")
        db.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(data[0]))})", data)
    told = db.execute(f"SELECT doc_id, n_words, n_hit, n_items, items_sha256 FROM ({decontamination.ORACLE})").fetchall()
    want = [(i, n, h, len(x), hashlib.sha256(",".join(x).encode()).hexdigest()) for i, n, h, x in brute(rows, items)]
    assert sorted(told, key=str) == sorted(want, key=str)
