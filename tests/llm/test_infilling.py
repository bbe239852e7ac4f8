"""Fill-in-middle against a per-text version."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tidemark.llm import infilling, registry
from tidemark.llm.common import table

from samples import SF001, awkward


def brute(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    if h4 % 100 < 20:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_equals_the_per_text_version(spark):
    want = {r.doc_id: brute(r.doc_id, r.text) + (r.text or "",) for r in table(spark, SF001, "documents").collect()}
    got = registry.op13_infilling(spark, SF001).collect()
    assert len(got) == len(want)
    assert {r.doc_id: tuple(r)[1:] for r in got} == {i: (n, f, p, m, sha(out), sha(text)) for i, (n, f, p, m, out, text) in want.items()}
    assert {w[1] for w in want.values()} == {"plain", "psm", "spm"}


def test_awkward_rows(docs):
    rows = awkward() + [(500 + k, t, "en", "s") for k, t in enumerate(("a <P> b", "<S>", "x<M>y", "< P >", "<", "a<", "<M", "\n", "é", "é1a\x00b", "ab" * 40000))]
    got = infilling.restore(infilling.fill_in_middle(docs(rows, clashing=True))).collect()
    key = lambda r: str(r)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, bytes(r.output).decode()) for r in got), key=key) == sorted(((i, *brute(i, t)) for i, t, *_ in rows), key=key)
    want = {}
    for i, t, *_ in rows:
        want.setdefault(i, set()).add(t or "")
    assert all(bytes(r.restored).decode() in want[r.doc_id] for r in got)


def test_empty_table(docs):
    assert infilling.restore(infilling.fill_in_middle(docs([(1, "a", "en", "s")]).filter("false"))).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="aB é<>PSM\n\x00🙂7", max_size=25), st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1), st.booleans(), st.booleans()), min_size=1, max_size=6))
def test_runs_of_texts(rows):
    texts = pa.array([t.encode() for t, *_ in rows], pa.binary())
    h1, h2, spm, wanted = (np.array([r[k] for r in rows], d) for k, d in ((1, np.int64), (2, np.int64), (3, bool), (4, bool)))
    got = infilling.transformed(texts, h1, h2, spm, wanted, infilling.Marks())
    for k, (text, a, b, back, want) in enumerate(rows):
        units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
        low, high = sorted((a % (len(units) + 1), b % (len(units) + 1)))
        p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
        cut = want and text and not any(x in text for x in ("<P>", "<S>", "<M>"))
        out = text if not cut else f"<S>{s}<P>{p}<M>{m}" if back else f"<P>{p}<S>{s}<M>{m}"
        assert got["output"][k].as_py().decode() == out and got["n"][k].as_py() == len(units)
    assert infilling.restored(got["output"], got["form"], infilling.Marks()).to_pylist() == texts.to_pylist()


def test_other_marks_and_rates(docs):
    rows = [(k, f"word{k} and more [x]", "en", "s") for k in range(50)] + [(99, "holds |MID| itself", "en", "s")]
    marks = infilling.Marks("|PRE:", "|SUF:", "|MID:")
    got = infilling.restore(infilling.fill_in_middle(docs(rows), marks, seed="other", cut_percent=100, spm_percent=0), marks).collect()
    assert {r.form for r in got} == {"psm"} and all(bytes(r.output).startswith(b"|PRE:") for r in got)
    assert {(r.doc_id, bytes(r.restored).decode()) for r in got} == {(i, t) for i, t, *_ in rows}
    assert {r.form for r in infilling.fill_in_middle(docs(rows), cut_percent=0).collect()} == {"plain"}
    for bad in (("", "b", "c"), ("<P>", "<P>", "<M>"), ("aa", "b", "c"), ("xa", "ab", "c"), ("abc", "b", "d")):
        with pytest.raises(ValueError):
            infilling.Marks(*bad)
