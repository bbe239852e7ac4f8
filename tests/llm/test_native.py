"""Exact dedup, mixing, licence scan, sharding."""

import collections
import hashlib
import math
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, licences, mixing, registry, sharding
from tidemark.llm.common import ROW
from tidemark.sources.tables import TABLE_NAMES
from tools.oracle_check import norm, spark_type_name

from samples import SF001, awkward, words

NATIVE = ("op4_poisson_mix", "op5_licence_scan", "op6_shard_placement", "op7_nearest_codes", "op9_exact_dedup")


@pytest.mark.parametrize("name", NATIVE)
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = registry.QUERIES[name](spark, SF001)
    rel = con.sql(registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {f.name: spark_type_name(f.dataType) for f in df.schema.fields} == types
    order = sorted(df.columns)
    mine = collections.Counter(tuple(norm(r[c]) for c in order) for r in df.collect())
    at = [rel.columns.index(c) for c in order]
    assert mine == collections.Counter(tuple(norm(r[i]) for i in at) for r in rel.fetchall())


def test_native_plans_run_no_python(spark):
    for name in ("op4_poisson_mix", "op5_licence_scan", "op9_exact_dedup"):
        plan = registry.QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan), name


def normalised(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("support", [1e-4, 0.2, 0.9])
def test_exact_dedup_by_brute_force(docs, support):
    rows = awkward() + [(k, "copy  of\ta line" if k % 3 else "copy of a line", "en", "h") for k in range(100, 160)]
    out = exact_dedup.exact_dedup(docs(rows, clashing=True), support).collect()
    groups = collections.defaultdict(list)
    for i, t, *_ in rows:
        groups[hashlib.sha256(normalised(t).encode()).hexdigest()].append(i)
    assert len(out) == len(rows)
    for r in out:
        ids = groups[r.text_sha256]
        known = [i for i in ids if i is not None]
        assert r.group_size == len(ids)
        assert r.keep_id == (min(known) if known else None)
    assert collections.Counter(r.text_sha256 for r in out if r.kept) == dict.fromkeys(groups, 1)
    assert all(r.doc_id == r.keep_id for r in out if r.kept)


def test_keep_first_returns_whole_rows(docs):
    d = docs(awkward(), clashing=True)
    kept = exact_dedup.keep_first(d)
    assert kept.columns == d.columns
    texts = [normalised(r.text) for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({normalised(t) for _, t, *_ in awkward()})


def test_exact_dedup_of_an_empty_table(docs):
    d = docs([(1, "a", "en", "s")]).filter("false")
    assert exact_dedup.exact_dedup(d).count() == 0 and exact_dedup.keep_first(d).count() == 0


def poisson_cdf(rate, k):
    return sum(math.exp(-rate + j * math.log(rate) - math.lgamma(j + 1)) for j in range(k + 1))


@pytest.mark.parametrize("limit", [mixing.BROADCAST_BYTES, 0])
def test_mix_by_brute_force(docs, limit):
    """Both joins give the counts that inverting the distribution gives."""
    rows = [(k, words(3 + k % 7, k), "en", f"s{k % 4}" if k % 5 else None) for k in range(200)] + awkward()
    weights = {"s0": 3.0, "s1": 1.0, None: 2.0, "b": 0.5}
    mixed = mixing.mix_sources(docs(rows, clashing=True), weights, epochs=2.0, broadcast_bytes=limit)
    got = collections.Counter()
    for r in mixed.select(f"{ROW}.doc_id", f"{ROW}.text", f"{ROW}.source", "copy", "n_copies").collect():
        got[r.doc_id, r.text, r.source] += 1
    chars = collections.Counter()
    for _, t, _, s in rows:
        chars[s] += len(t or "")
    total, all_weight = sum(chars.values()), sum(w for s, w in weights.items() if chars[s])
    want = collections.Counter()
    for i, t, _, s in rows:
        if not chars[s] or s not in weights:
            continue
        rate = weights[s] / all_weight * total * 2.0 / chars[s]
        h = hashlib.md5("|".join([mixing.SEED, "" if i is None else str(i), hashlib.md5((t or "").encode()).hexdigest()]).encode()).hexdigest()
        u, n = int(h[:13], 16) / 2**52, 0
        while poisson_cdf(rate, n) <= u:
            n += 1
        want[i, t, s] += n
    assert got == +want


def test_mix_reaches_its_weights(docs):
    rows = [(k, "word " * 10, "en", "big" if k % 3 else "small") for k in range(6000)]
    mixed = mixing.mix_sources(docs(rows), {"big": 1.0, "small": 1.0}).groupBy(f"{ROW}.source").count().collect()
    counts = {r["source"]: r["count"] for r in mixed}
    assert abs(counts["big"] - 3000) < 200 and abs(counts["small"] - 3000) < 200


def test_large_rates_do_not_underflow(spark):
    steps = spark.range(1).select(mixing.cumulative(F.lit(900.0)).alias("s")).first().s
    assert steps[0] < 1e-300 and abs(steps[900] - 0.5089) < 1e-3 and abs(steps[-1] - 1) < 1e-9


def test_mix_of_empty_sources_and_tables(docs):
    assert mixing.mix_sources(docs([(1, None, None, "a"), (2, "", None, None)])).count() == 0
    assert mixing.mix_sources(docs([(1, "a", "en", "s")]).filter("false")).count() == 0


def wrapped(text):
    """A line end after every seventh word."""
    return re.sub(r"((?:\S+\s+){6}\S+)\s", r"\1\n", text)


def licence_texts():
    """(text, licence) of every rule: line by line, wrapped, commented, upper case."""
    for name, rule in licences.RULES:
        parts = [licences.SENTENCES[i] for i in rule]
        paragraphs = "\n\n".join(wrapped(p) for p in parts)
        yield "Some words first.\n" + "\n".join(parts) + "\nAnd after.", name
        yield paragraphs.upper(), name
        yield "\n".join(("# " + line).rstrip() for line in paragraphs.split("\n")), name


def test_every_known_licence_text_is_found(docs):
    rows = list(licence_texts())
    got = {r.doc_id: r.licences for r in licences.scan_licences(docs([(k, t, "en", "s") for k, (t, _) in enumerate(rows)], clashing=True)).collect()}
    assert [(k, got[k]) for k in range(len(rows))] == [(k, name) for k, (_, name) in enumerate(rows)]


def test_a_longer_rule_wins_and_consumes_its_sentences(docs):
    text = lambda *ids: "\n\n".join(licences.SENTENCES[i] for i in ids)
    two = ("bsd-redistribution", "bsd-source", "bsd-binary")
    rows = {
        1: (text(*two, "bsd-endorse"), "BSD-3-Clause"), 2: (text(*two), "BSD-2-Clause"), 3: (text(*two[:2]), "BSD-1-Clause"),
        4: (text(*two, "bsd-advert", "bsd-endorse"), "BSD-4-Clause"), 5: (text(*two, *two, "bsd-endorse"), "BSD-2-Clause,BSD-3-Clause"),
        6: (text(*two, "bsd-endorse", *two), "BSD-2-Clause,BSD-3-Clause"), 7: (text("bsd-redistribution", "mit-grant", "bsd-source", "mit-notice", "bsd-binary"), "BSD-2-Clause,MIT"),
        8: (text("mit-title", "mit-grant", "mit-notice", "mit-warranty"), "MIT"), 9: (text("mit-grant", "apache2-short", "classpath-exception"), "Apache-2.0,Classpath-exception-2.0"),
        10: (text("mit-notice", "mit-grant"), ""), 11: (text("lgpl-free", "lgpl21-redistribute") + "\n\n" + text("agpl3-redistribute"), "AGPL-3.0-or-later,LGPL-2.1-or-later"),
        12: (text("apache2-header", "apache2-comply", "apache2-as-is") + "\n" + text("zlib-as-is", "zlib-grant", "bsl1-header"), "Apache-2.0,BSL-1.0,Zlib"),
    }
    got = {r.doc_id: r.licences for r in licences.scan_licences(docs([(k, t, "en", "s") for k, (t, _) in rows.items()])).collect()}
    assert got == {k: name for k, (_, name) in rows.items()}


def test_own_sentences_and_rules(docs):
    own = licences.Licences({"a": "This house is licensed.", "b": "No warranty; none at all, no software."}, [("H", ("a", "b")), ("A", ("a",))], split={"b": ("b1", "b2")})
    rows = [(1, "This house is licensed.\nNo warranty; none at all, no software.", "en", "s"), (2, "This house is licensed", "en", "s"), (3, "Released under the MIT License.", "en", "s")]
    assert {r.doc_id: r.licences for r in licences.scan_licences(docs(rows), own).collect()} == {1: "H", 2: "A", 3: ""}
    for bad in ({"a": "No cue in here."}, {"a": "A licence.", "b": "a licence!"}, {"a": "Two licences; one piece too many."}):
        with pytest.raises(ValueError):
            licences.Licences(bad, [])


def test_licence_sql_on_texts_of_all_kinds(docs):
    """The SQL beside the operator on full, wrapped, commented and broken texts, copyright lines among them."""
    texts = [t for t, _ in licence_texts()]
    texts += [f"Copyright (c) 2020 Foo\n{t}" for t in texts[:30]] + [f"{a}\n\n{b}" for a, b in zip(texts, texts[7:])] + [t[: len(t) // 2] for t in texts]
    texts += ["copyright: notice\nMIT License", "copyright notice\nMIT License", "© 2020 x\nMIT License", "(c)\nMIT License", "MIT License;\r\n\r\nAll rights reserved.", "* * *\nMIT License\n* * *"]
    rows = [(k, t, "en", "s") for k, t in enumerate(texts)] + [(None, None, None, None), (9000, "", "en", "s"), (9001, "MIT License. " * 3000, "en", "s")]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in rows])
    told = con.sql(licences.oracle()).fetchall()
    got = [(r.doc_id, r.n_known, r.sentence_ids, r.licences) for r in licences.scan_licences(docs(rows)).collect()]
    assert sorted(got, key=str) == sorted(told, key=str)


def test_order_matters_and_awkward_texts_have_none(docs):
    swapped = licences.SENTENCES["mit-notice"] + "\n" + licences.SENTENCES["mit-grant"]
    got = {r.doc_id: r for r in licences.scan_licences(docs([(100, swapped, "en", "s"), (101, "The license of a poet.", "en", "s"), *awkward()])).collect()}
    assert got[100].licences == "" and got[100].n_known == 2
    assert got[101].n_known == 0
    assert all(got[i].licences == "" for i in (1, 2, 3, 4, 5, 6))
    assert licences.scan_licences(docs([(1, "a", "en", "s")]).filter("false")).count() == 0


FOUNDATION = "it under the terms of the GNU General Public License as published by the Free Software Foundation; "
HOPE = "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty."


def test_version_of_a_split_gpl_sentence_counts(docs):
    ends = {
        "either version 2 of the License, or (at your option) any later version.": "GPL-2.0-or-later",
        "either version 3 of the License, or (at your option) any later version.": "GPL-3.0-or-later",
        "version 2 of the License.": "GPL-2.0-only",
        "version 3 of the License.": "GPL-3.0-only",
        "either version 9 of the License.": "",
    }
    rows, want = [], {}
    for k, (end, name) in enumerate(ends.items()):
        text = f"Foo is free software; you can redistribute it and/or modify {FOUNDATION}{end} {HOPE}"
        rows += [(2 * k, text, "en", "s"), (2 * k + 1, re.sub(r"((?:\S+\s+){6}\S+)\s", r"\1\n", text), "en", "s")]
        want[2 * k] = want[2 * k + 1] = name
    # Another licence's version does not complete the sentence.
    lesser = "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; "
    both = f"you can redistribute it and/or modify {FOUNDATION}version 2 of the License. {HOPE}\n\nyou can modify {lesser}either version 3 of the License, or (at your option) any later version. {HOPE}"
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public License, v. "
    rows += [(50, both, "en", "s"), (51, mpl + "2.0.", "en", "s"), (52, mpl + "1.1.", "en", "s")]
    want |= {50: "GPL-2.0-only", 51: "MPL-2.0", 52: ""}
    got = {r.doc_id: r.licences for r in licences.scan_licences(docs(rows)).collect()}
    assert got == want


def test_licences_in_comments_and_after_copyright_lines(docs):
    wrap = lambda name: re.sub(r"((?:\S+\s+){6}\S+)\s", r"\1\n", licences.SENTENCES[name])
    mit = f"MIT License\n\nCopyright (c) 2020 Foo\n\n{wrap('mit-grant')}\n\n{wrap('mit-notice')}"
    isc = f"Copyright 2020 Foo <a@b.example>\n\n{wrap('isc-grant')}"
    rows, want = [], {}
    for k, leader in enumerate((" * ", "# ", "// ", "-- ", ";; ", "")):
        for n, (body, name) in enumerate(((mit, "MIT"), ("The " + mit.split("\n\nThe above")[0].replace("License", "License (MIT)", 1), "MIT"), (isc, "ISC"))):
            for tight in (0, 1):
                text = body.replace("Foo\n\n", "Foo\n").replace("example>\n\n", "example>\n") if tight else body
                i = 10 * k + 2 * n + tight
                rows.append((i, "\n".join((leader + line).rstrip() for line in text.split("\n")), "en", "s"))
                want[i] = name
    # A title known by its line, a grant known as a whole: one sequence.
    rows.append((90, "The MIT License (MIT)\nCopyright (c) 2020 Foo\n\n" + wrap("mit-grant"), "en", "s"))
    # A sentence wrapped before "copyright notice" is still one sentence.
    notice = licences.SENTENCES["mit-notice"].replace("above copyright", "above\ncopyright")
    rows.append((91, wrap("mit-grant") + "\n" + notice, "en", "s"))
    # A line that happens to read like the end of another header is none.
    rows.append((92, f"you can redistribute it and/or modify {FOUNDATION}either\nversion 2 of the License,\nor later. {HOPE}", "en", "s"))
    want |= {90: "MIT", 91: "MIT", 92: ""}
    got = {r.doc_id: r for r in licences.scan_licences(docs(rows)).collect()}
    assert {i: r.licences for i, r in got.items()} == want
    assert got[90].sentence_ids == "mit-title,mit-grant" and got[90].n_known == 2


def claimed(names, size):
    """The table filled turn by turn from the shards' whole preference lists."""
    names = sorted(set(names))
    number = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:15], 16)
    lists = [[(number(f"offset|{n}") % size + j * (number(f"skip|{n}") % (size - 1) + 1)) % size for j in range(size)] for n in names]
    owner = {}
    while len(owner) < size:
        for shard, wanted in enumerate(lists):
            free = next((slot for slot in wanted if slot not in owner), None)
            if free is not None:
                owner[free] = shard
    return [owner[k] for k in range(size)]


@pytest.mark.parametrize("names,size", [(["a"], 3), (["b", "a", "c"], 7), ([f"n{k}" for k in range(5)], 5), ([f"s{k}" for k in range(9)], 101)])
def test_shards_take_turns_by_preference(names, size):
    assert sharding.lookup_table(names, size) == claimed(names, size)
    with pytest.raises(ValueError):
        sharding.lookup_table(names, 2097169)


def test_sharding_of_an_empty_table(docs):
    assert sharding.assign_shards(docs([(1, "a", "en", "s")]).filter("false")).count() == 0


def test_lookup_table_is_fair_and_stable():
    names = [f"n{k}" for k in range(10)]
    owner = sharding.lookup_table(names, 1009)
    sizes = collections.Counter(owner)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    assert owner == sharding.lookup_table(names[::-1], 1009)
    fewer = sharding.lookup_table(names[:-1], 1009)
    moved = sum(a != b and a != 9 for a, b in zip(owner, fewer))
    assert moved < 0.25 * 1009
    # Every claimed slot is the first free one of its shard's order at its turn.
    assert set(owner) == set(range(10))


@pytest.mark.parametrize("shards, size", [([], 7), (["a", "b"], 8), (["a", "b", "c"], 2)])
def test_lookup_table_refuses(shards, size):
    with pytest.raises(ValueError):
        sharding.lookup_table(shards, size)


def test_placement_of_awkward_rows(docs, tmp_path):
    rows = awkward() + [(None, f"no id {k}", "en", "s") for k in range(50)]
    d = docs(rows, clashing=True)
    placed = sharding.assign_shards(d).select(f"{ROW}.doc_id", f"{ROW}.text", F.col("shard")).collect()
    assert len(placed) == len(rows)
    assert len({r.shard for r in placed if r.doc_id is None}) > 10
    assert len({r.shard for r in placed if r.doc_id == 7}) == 1
    sharding.write_shards(docs(rows), str(tmp_path / "out"), ["a", "b", "c"], 101)
    back = d.sparkSession.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(rows) and {r.shard for r in back.select("shard").distinct().collect()} <= {"a", "b", "c"}
