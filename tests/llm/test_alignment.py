"""Two tokenizers' alignment against whole-text encoding and plain counting."""

import collections
import hashlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tidemark.llm import alignment, registry, two_tokenizers
from tidemark.llm.common import table

from samples import SF001, awkward, words


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(alignment.A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.B_PATH)


@pytest.fixture(scope="module")
def both():
    with open(alignment.A_PATH, encoding="utf-8") as a, open(alignment.B_PATH, "rb") as b:
        return two_tokenizers.TwoTokenizers(a.read(), b.read())


def whole(libraries, text):
    """[(id, begin, end)] of both tokenizers over the bytes of space + text; None if either gives other bytes."""
    if not text:
        return None
    a, b = libraries
    byte = two_tokenizers.byte_of()
    raw, out = (" " + text).encode(), []
    tokens_a = [(k, bytes(byte[c] for c in a.id_to_token(k))) for k in a.encode(" " + text, add_special_tokens=False).ids]
    tokens_b = [(k, bytes([int(p[3:5], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode()) for k, p in ((k, b.id_to_piece(k)) for k in b.encode(text))]
    for tokens in (tokens_a, tokens_b):
        if b"".join(x for _, x in tokens) != raw:
            return None
        at, held = 0, []
        for k, x in tokens:
            held.append((k, at, at + len(x)))
            at += len(x)
        out.append(held)
    return out


def brute(libraries, rows):
    links, shape = [], []
    for i, text in rows:
        found = whole(libraries, text)
        if found is None:
            links.append([])
            shape.append((i, 0, 0, 0, ""))
            continue
        a, b = found
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = []
        for x in (a, b):
            held, closing = [[]], iter(ends)
            end = next(closing)
            for k, _, t in x:
                held[-1].append(str(k))
                if t == end:
                    held.append([])
                    end = next(closing, None)
            groups.append([",".join(g) for g in held[:-1]])
        groups = ["|".join(g) for g in zip(*groups)]
        shape.append((i, len(a), len(b), len(ends), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        mine, j = [], 0
        for k, s, e in a:
            while b[j][2] <= s:
                j += 1
            n = j
            while n < len(b) and b[n][1] < e:
                mine.append((k, b[n][0]))
                n += 1
        links.append(mine)
    counts = collections.Counter(p for x in links for p in x)
    best = collections.defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return sorted(((i, n_a, n_b, g, len(x), sum(counts[p] == best[p[1]] for p in x), sum(counts[p] for p in x), sha) for (i, n_a, n_b, g, sha), x in zip(shape, links)), key=str)


def got(frame):
    return sorted((tuple(r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) for r in frame.collect()), key=str)


def test_query_equals_plain_counting(spark, libraries):
    rows = [(r.doc_id, r.text) for r in table(spark, SF001, "documents").collect()]
    want = brute(libraries, rows)
    assert got(registry.op11_alignment(spark, SF001)) == want
    assert any(w[5] < w[4] for w in want) and any(w[3] < min(w[1], w[2]) for w in want)


TEXTS = [
    " lead", "tail ", "two  blanks", "a\n\nb", "line\nline\n", "\n", " ", "   ", "tab\ttab", "<|endoftext|> <s> </s> <unk>", "<0x41>", "x▁y", "▁", "it's we'll I'M 'tis",
    "日本語 テキスト", "🙂 🙂🙂", "é ́", " a b c", "a b", "\x00 \x1f a", "1,000.50 (x) -- y", "a" * 5000, "der Fluß\nim Tal,\r\nim Wald",
]


@pytest.mark.parametrize("run_links,bucket_bytes", [(1, 1 << 26), (3000, 50_000), (1 << 22, 2000)])
def test_awkward_rows_in_runs_and_buckets_of_any_size(docs, libraries, monkeypatch, run_links, bucket_bytes):
    monkeypatch.setattr(alignment, "AT_ONCE", 64)
    rows = [r for r in awkward() if r[1] is None or len(r[1]) < 5000] + [(100 + k, t, "en", "s") for k, t in enumerate(TEXTS)] + [(200 + k, words(40, k % 7), "en", "s") for k in range(30)]
    found = alignment.align(docs(rows, clashing=True), run_links=run_links, bucket_bytes=bucket_bytes)
    assert got(found) == brute(libraries, [r[:2] for r in rows])


def test_long_text(docs, libraries):
    rows = [(1, words(30000, 5), "en", "b"), (2, words(30000, 5), "en", "b"), (3, "short", "en", "b")]
    assert got(alignment.align(docs(rows))) == brute(libraries, [r[:2] for r in rows])


def test_empty_table_and_no_tokens(docs):
    assert alignment.align(docs([(1, "a", "en", "s")]).filter("false")).count() == 0
    assert got(alignment.align(docs([(1, None, "en", "s"), (2, "x▁y", None, None)]))) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab' ’\n\t\r1.,é́▁  \x1c\x85<s>日🙂")) | st.characters(codec="utf-8"), max_size=30))
def test_segments_encode_like_whole_texts(libraries, both, text):
    want, found = whole(libraries, text), both.encode([text])[0]
    assert (found is None) == (want is None)
    if found is not None:
        assert both.splits
        for k in (0, 1):
            assert np.frombuffer(b"".join(s[k] for s in found), np.int32).tolist() == [x for x, *_ in want[k]]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 30), st.integers(1, 9), min_size=1, max_size=12), min_size=1, max_size=6), st.integers(1, 9))
def test_heap_merge_counts_every_pair(runs, at_once):
    frames = [alignment.squeezed(np.diff(np.array(sorted(r)), prepend=0), np.array([r[k] for k in sorted(r)])) for r in runs]
    total = collections.Counter()
    for r in runs:
        total.update(r)
    back, best = collections.defaultdict(list), {}
    before, alignment.AT_ONCE = alignment.AT_ONCE, at_once
    try:
        for frame, counts, ranks, most in alignment.merged(frames, 2):
            for f, n in zip(frame.tolist(), counts.tolist()):
                back[f].append(n)
            for r, n in zip(ranks.tolist(), most.tolist()):
                best[r] = max(best.get(r, 0), n)
    finally:
        alignment.AT_ONCE = before
    assert [back[k] for k in range(len(runs))] == [[total[p] for p in sorted(r)] for r in runs]
    assert best == {r: max(n for p, n in total.items() if p >> 2 == r) for r in {p >> 2 for p in total}}
