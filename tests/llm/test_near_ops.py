"""Near-duplicate classes, repeated substrings, nearest codes, components."""

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from tidemark.llm import anchors, cover, darts, hamming, links, near_dedup, registry, shingles, substrings
from tidemark.llm.common import table

from samples import SF001, awkward, words

# ------------------------------------------------------------------ signatures


def brute_shingles(text):
    w = (text or "").lower().split()
    if not w:
        return collections.Counter()
    return collections.Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))


def jaccard(a, b):
    return sum((a & b).values()) / sum((a | b).values())


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.sampled_from("a b c dd é".split()), max_size=14), min_size=1, max_size=4))
def test_weighted_shingles_equal_brute_force(texts):
    owner, h, weight = shingles.weighted(texts)
    names = {}
    for k, t in enumerate(texts):
        want = brute_shingles(" ".join(t))
        assert sorted(weight[owner == k].tolist()) == sorted(want.values())
        assert len(shingles.occurrences(h[owner == k], weight[owner == k])) == sum(want.values())
    for a in range(len(texts)):
        for b in range(a):
            x, y = (set(h[owner == k].tolist()) for k in (a, b))
            assert len(x & y) == len(set(brute_shingles(" ".join(texts[a]))) & set(brute_shingles(" ".join(texts[b]))))


def test_darts_estimate_weighted_similarity():
    rng = np.random.default_rng(3)
    element = shingles.mixed(np.arange(400, dtype=np.uint64))
    x, y = rng.integers(1, 9, 400), rng.integers(1, 9, 400)
    true = np.minimum(x, y).sum() / np.maximum(x, y).sum()
    owner = np.repeat([0, 1], 400)
    sig = darts.signatures(owner, np.tile(element, 2), np.concatenate([x, y]), 2, 4096)
    assert abs((sig[0] == sig[1]).mean() - true) < 0.03
    assert (sig != 0).all()


def test_signature_does_not_depend_on_the_batch():
    sets = [words(n, n).split() for n in (1, 4, 60, 900)]
    owner, h, w = shingles.weighted(sets)
    together = darts.signatures(owner, h, w, 4)
    for k, s in enumerate(sets):
        o, e, x = shingles.weighted([s])
        assert (darts.signatures(o, e, x, 1)[0] == together[k]).all()
    assert (darts.signatures(*shingles.weighted([[], ["a"]]), 2)[0] == 0).all()


# --------------------------------------------------------------- near classes


def edited(text, share, seed):
    r = random.Random(seed)
    w = text.split()
    for k in r.sample(range(len(w)), int(len(w) * share)):
        w[k] = f"edit{seed}x{k}"
    return " ".join(w)


def brute_classes(rows):
    sets = [brute_shingles(t) for _, t, *_ in rows]
    root = list(range(len(rows)))
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and jaccard(sets[a], sets[b]) >= 0.8:
                root[max(find(a), find(b))] = min(find(a), find(b))
    out = collections.defaultdict(list)
    for k in range(len(rows)):
        out[find(k)].append(k)
    return list(out.values())


def planted():
    rows = []
    for g in range(6):
        base = words(200 + 40 * g, 50 + g)
        rows += [(1000 + 20 * g + k, edited(base, 0.012 * k, 7 * g + k), "en", "s") for k in range(5)]
        rows.append((1000 + 20 * g + 10, base.upper(), "en", "s"))
        rows.append((1000 + 20 * g + 11, edited(base, 0.4, g), "en", "s"))
    return rows + awkward() + [(5000 + k, words(80, 900 + k), "en", "s") for k in range(30)]


@pytest.mark.parametrize("block", [near_dedup.BLOCK_TEXTS, 2])
def test_near_classes_by_brute_force(docs, monkeypatch, block):
    """Also with blocks of two texts, so that buckets fall into many blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK_TEXTS", block)
    rows = planted()
    got = near_dedup.near_classes(docs(rows, clashing=True)).collect()
    assert len(got) == len(rows)
    want = collections.Counter()
    for group in brute_classes(rows):
        ids = [rows[k][0] for k in group]
        known = [i for i in ids if i is not None]
        for i in ids:
            want[i, min(known) if known else None, len(ids)] += 1
    assert collections.Counter((r.doc_id, r.class_id, r.class_size) for r in got) == want
    classes = collections.Counter((r.class_id, r.class_size) for r in got if r.kept and r.digest)
    assert sum(r.kept for r in got) == len(brute_classes(rows))


def test_keep_one_returns_whole_rows(docs):
    d = docs(planted(), clashing=True)
    kept = near_dedup.keep_one(d)
    assert kept.columns == d.columns
    assert kept.count() == len(brute_classes(planted()))


def test_near_dedup_keeps_texts_of_any_white_space(docs):
    blanks = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    rows = [(k, f"{c} {c}", "en", "s") for k, c in enumerate(blanks)] + [(100, "a\x1cb\x85c", "en", "s"), (101, "a b c", "en", "s")]
    d = docs(rows)
    got = {r.doc_id: (r.class_id, r.class_size, r.kept) for r in near_dedup.near_classes(d).collect()}
    assert got == {k: (k, 1, True) for k in range(len(blanks))} | {100: (100, 2, True), 101: (100, 2, False)}
    assert {r.doc_id for r in near_dedup.keep_one(d).collect()} == set(got) - {101}


def test_near_dedup_of_an_empty_table(docs):
    d = docs([(1, "a", "en", "s")]).filter("false")
    assert near_dedup.near_classes(d).count() == 0 and near_dedup.keep_one(d).count() == 0


def test_components_by_brute_force(spark):
    r = random.Random(4)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(330)] + [(1000 + k, 1001 + k) for k in range(70)] + [(2000, 2001 + k) for k in range(50)]
    got = {x.id: x.root for x in links.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    root = {}
    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert links.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# ---------------------------------------------------------- repeated substrings


def brute_removed(texts):
    """(n_bytes, n_removed, n_spans, kept hash) of each text."""
    bodies = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[k : k + 400] for b in bodies for k in range(len(b) - 399))
    out = []
    for b in bodies:
        gone = bytearray(len(b))
        for k in range(len(b) - 399):
            if seen[b[k : k + 400]] > 1:
                gone[k : k + 400] = b"\1" * 400
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(b)))
        out.append((len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return out


def passages():
    shared = [words(120, 70 + k) for k in range(4)]
    rows = []
    for k in range(40):
        r = random.Random(k)
        parts = [words(r.randint(0, 90), 300 + k)]
        for p in r.sample(shared, r.randint(0, 3)):
            cut = r.randint(0, 200)
            parts += [p[cut : cut + r.randint(300, 900)], words(r.randint(0, 40), 500 + k)]
        rows.append((k, " ".join(parts), "en", "s"))
    unit = words(30, 1)
    rows += [
        (100, "ab" * 600, "en", "s"), (101, "x" * 401, "en", "s"), (102, "y" * 400, "en", "s"), (103, (unit + " ") * 8, "en", "s"),
        (104, shared[0][:400], "en", "s"), (105, shared[0][1:400], "en", "s"), (106, "é" * 200 + shared[1][:399], "en", "s"), (107, "é" * 200 + "z", "en", "s"),
    ]
    return rows + [r for r in awkward() if r[0] != 6]


def test_repeated_substrings_by_brute_force(docs):
    rows = passages()
    got = substrings.remove_repeated(docs(rows, clashing=True)).collect()
    want = collections.Counter((r[0], *w) for r, w in zip(rows, brute_removed([t for _, t, *_ in rows])))
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want
    for r in got:
        assert sum(int(b) - int(a) for a, b in (s.split(":") for s in r.spans.split(",") if s)) == r.n_removed


def test_repeated_substrings_on_the_smallest_table(spark):
    d = table(spark, SF001, "documents")
    rows = d.select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in registry.op1_repeated_substrings(spark, SF001).collect()}
    assert got == dict(zip((r.doc_id for r in rows), brute_removed([r.text for r in rows])))


def test_substrings_of_an_empty_table(docs):
    assert substrings.remove_repeated(docs([(1, "a", "en", "s")]).filter("false")).count() == 0


@pytest.mark.parametrize("chunk", [1 << 19, 700])
def test_anchors_by_brute_force(monkeypatch, chunk):
    monkeypatch.setattr(anchors, "CHUNK", chunk)
    body = (words(700, 2) + "ab" * 500).encode()
    h = anchors.mixed(np.zeros(1, np.uint64))  # warms the tables
    hashes, starts = anchors.anchors(body)
    monkeypatch.setattr(anchors, "CHUNK", 1 << 19)
    grams = anchors.gram_hashes(np.frombuffer(body, np.uint8)) & ~np.uint64((1 << 20) - 1)
    want, last = [], -1
    for i in range(len(body) - 399):
        place = i + int(np.argmin(grams[i : i + 201]))
        if place != last:
            want.append(i)
            last = place
    assert starts.tolist() == want and len(hashes) == len(want)


def test_the_sort_finds_windows_at_every_residue(spark):
    """Equal windows at all pairs of places modulo 3, in strings of their own."""
    base = words(300, 9).encode()
    rows = [(k, bytes([65 + k]) * k + base[:420] + bytes([97 + k]) * 30) for k in range(7)] + [(50, words(200, 8).encode())]
    got = {r.owner: (r.starts, r.ends) for r in cover.repeated(cover.in_chunks(spark.createDataFrame(rows, "owner bigint, body binary"))).collect()}
    assert got == {k: ([k], [k + 20]) for k in range(7)}


def sorted_here(strings):
    """The sort's levels without Spark, each string a chunk: [(level, the chunks' rows after it)]."""
    def batches(rows):
        return iter([pa.RecordBatch.from_pylist([r], pa.schema(STATE)) for r in rows])

    rows = [
        {"chunk": k, "body": b, "sizes": np.array([len(b)]).tobytes(), "owners": np.array([k]).tobytes(), "names": b"", "alive": b""} for k, b in enumerate(strings)
    ]
    after = []
    for level in range(len(cover.LEVELS) + 1):
        parts = cover.FIRST_PASSES if level == 0 else 1
        sent = [pa.Table.from_batches([b]) for part in range(parts) for b in cover._sent(level, 8, part, parts)(batches(rows))]
        sent = pa.concat_tables(sent).to_pylist() if sent else []
        words = len(cover.LEVELS[level][1]) if level < len(cover.LEVELS) else 2
        told = [cover._ranked(words)(pa.Table.from_pylist([r for r in sent if r["bucket"] == b])) for b in {r["bucket"] for r in sent}]
        told = [r for t in told for r in t.to_pylist()]
        kinds = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("names", pa.binary())])
        rows = [
            cover._received(level, 8)(pa.Table.from_pylist([r], pa.schema(STATE)), pa.Table.from_pylist([t for t in told if t["chunk"] == r["chunk"]], kinds)).to_pylist()[0]
            for r in rows
        ]
        after.append(rows)
    return after


STATE = [("chunk", pa.int64())] + [(c, pa.binary()) for c in ("body", "sizes", "owners", "names", "alive")]


def some_strings():
    base = words(200, 21).encode()
    return [bytes([65 + k]) * k + base[7 * k : 7 * k + 600] + bytes([97 + k]) * 450 for k in range(5)] + [words(120, 22).encode(), b"ab" * 300]


def windows_here(strings):
    seen = collections.Counter(b[k : k + 400] for b in strings for k in range(len(b) - 399))
    return [[seen[b[k : k + 400]] > 1 for k in range(len(b) - 399)] for b in strings]


@pytest.mark.parametrize("kept", [64, 3, 0])
def test_the_sort_parts_keys_that_share_a_hash(monkeypatch, kept):
    """With all, three or no bits of the hash left the same windows are found."""
    strings, plain = some_strings(), cover._hashed
    monkeypatch.setattr(cover, "_hashed", lambda keys: plain(keys) & np.uint64((1 << 64) - (1 << (64 - kept))))
    done = sorted_here(strings)[-1]
    assert [cover._unpack(r["alive"], bool)[: len(b) - 399].tolist() for r, b in zip(done, strings)] == windows_here(strings)


def test_a_key_is_sorted_only_in_its_own_pass(monkeypatch):
    strings, plain, seen = some_strings()[:1], cover._together, []

    def counted(h, keys, mine=None):
        got = plain(h, keys, mine)
        seen.append((len(got[0]), len(h)))
        return got

    monkeypatch.setattr(cover, "_together", counted)
    row = {"chunk": 0, "body": strings[0], "sizes": np.array([len(strings[0])]).tobytes(), "owners": b"", "names": b"", "alive": b""}
    for part in range(2):
        list(cover._sent(0, 8, part, 2)(iter([pa.RecordBatch.from_pylist([row], pa.schema(STATE))])))
    assert len(seen) == 2 and sum(own for own, _ in seen) == seen[0][1] == seen[1][1]
    assert all(0 < own < every for own, every in seen)


def test_names_are_kept_for_sampled_places_and_packed_by_bytes():
    strings = some_strings()
    for rows in sorted_here(strings)[:-1]:
        for r, b in zip(rows, strings):
            assert len(cover._unpack(r["names"], np.int64)) == sum(k % 3 != 0 for k in range(len(b)))
    names = (np.random.default_rng(4).integers(0, 50, 5000) << 32) + np.random.default_rng(5).integers(0, 1 << 19, 5000)
    assert cover._unpack(cover._pack(names), np.int64).tolist() == names.tolist()
    assert len(cover._pack(names)) < 0.9 * len(zstandard.ZstdCompressor(level=1).compress(names.tobytes()))
    assert cover._unpack(cover._pack(names[:0]), np.int64).tolist() == [] and cover._unpack(cover._pack(np.array([True, False])), bool).tolist() == [True, False]


def test_planted_passages_are_read_by_what_is_removed(docs):
    """n_removed tells documents with a repeated passage of 400 bytes or more from all others; n_bytes is a length."""
    rows, planted = [], set()
    for k in range(30):
        passage = words(51 + 4 * k, 7000 + k)
        passage += "." * max(0, 400 - len(passage))
        for copy in range(2 + k % 2):
            at = len(rows)
            planted.add(at)
            rows.append((at, f"{words(20 + k, 8000 + 10 * k + copy)} {passage} {words(15, 9000 + 10 * k + copy)}", "en", "s"))
    for k in range(60):  # clean: own words, or a passage of 399 bytes that repeats
        own = words(60 + 2 * k, 20000 + k)
        rows.append((len(rows), own if k % 2 else "\u00e9" * (k % 7 + 1) + chr(0x100 + k) + words(120, 30000 + k // 4)[:399] + chr(65 + k % 4), "en", "s"))
    got = {r.doc_id: r for r in substrings.remove_repeated(docs(rows)).collect()}
    caught = [got[k].n_removed > 0 for k in planted]
    left = [got[k].n_removed == 0 for k in got if k not in planted]
    assert len(got) == len(rows) and len(planted) == 75 and len(left) == 60
    assert sum(caught) / len(caught) == 1.0 and sum(left) / len(left) == 1.0
    assert all(got[k].n_bytes == len(t.encode()) for k, t, *_ in rows)


# --------------------------------------------------------------- nearest codes


def test_nearest_codes_by_brute_force(spark):
    r = np.random.default_rng(2)
    base = r.normal(size=(20, 64))
    rows = [(k, (base[k % 20] + r.normal(size=64) * 0.4).tolist()) for k in range(300)]
    rows += [(1000 + k, base[0].tolist()) for k in range(60)]  # one vector many times
    rows += [(2000, None), (None, base[1].tolist()), (2050, []), (2100, [1.0, None, float("nan")]), (100, rows[100][1])]
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("distance", T.StringType())])
    df = spark.createDataFrame([(*x, "clash") for x in rows], schema)
    got = hamming.nearest(df, F.col("vec_id") % 50 == 0, k=7).collect()
    codes = {}
    for i, v in rows:
        if i is not None and v:
            codes[i] = tuple(bool(x is not None and x > 0) for x in v) + (False,) * (64 - len(v))
    want = []
    for q in codes:
        if q % 50 == 0:
            near = sorted((sum(a != b for a, b in zip(codes[q], codes[i])), i) for i in codes if i != q)[:7]
            want += [(q, n, i, d) for n, (d, i) in enumerate(near, 1)]
    assert sorted((x.query_id, x["rank"], x.vec_id, x.distance) for x in got) == sorted(want)


def test_wider_vectors_are_refused(spark):
    from pyspark.errors import PySparkException
    df = spark.createDataFrame([(1, [1.0] * 65)], "vec_id bigint, embedding array<double>")
    with pytest.raises(PySparkException, match="more than 64 elements: 65"):
        df.select(hamming.code_of()).collect()
    with pytest.raises(ValueError):
        hamming.code_of(bits=65)


def test_every_pair_of_a_bucket_may_be_verified(docs):
    rows = [(k, " ".join(words(40, 1).split()[: 40 - k]), "en", "s") for k in range(6)] + [(10 + k, words(40, 20 + k), "en", "s") for k in range(5)]
    got = {r.doc_id: r.class_id for r in near_dedup.near_classes(docs(rows), margin=1.0).collect()}
    assert got == {r.doc_id: r.class_id for r in near_dedup.near_classes(docs(rows)).collect()} and got[3] == 0 and got[12] == 12


def test_fewer_rows_than_neighbours(spark):
    df = spark.createDataFrame([(0, [1.0, -1.0]), (1, [1.0, 1.0]), (2, [-1.0, -1.0])], "vec_id bigint, embedding array<double>")
    got = hamming.nearest(df, F.col("vec_id") == 0).collect()
    assert [(x["rank"], x.vec_id, x.distance) for x in sorted(got)] == [(1, 1, 1), (2, 2, 1)]
    assert hamming.nearest(df.filter("false"), F.col("vec_id") == 0).count() == 0


@pytest.mark.parametrize("bits, count", [(64, 2), (64, 5), (64, 7), (10, 3)])
def test_segments_cover_the_code(bits, count):
    parts = hamming.segments(bits, count)
    assert parts[0][0] == 0 and sum(w for _, w in parts) == bits
    assert all(a + w == b for (a, w), (b, _) in zip(parts, parts[1:]))
