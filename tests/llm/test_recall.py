import os
import random
import textwrap

import duckdb
import numpy as np
import pyarrow as pa

import pytest

pytest.importorskip("tilewright.llm")

import brute  # noqa: E402

from tilewright.llm import bitfilter, license_scan, line_dedup, near_dup, oracles  # noqa: E402


def test_a_changed_character_in_a_short_line(spark):
    # fifty characters, one of them changed: 41 of 51 runs of five are common
    line = "".join(chr(0x4E00 + i) for i in range(50))
    rows = [(1, line, "en", "s", 1, "k"), (2, line[:25] + "x" + line[26:], "en", "s", 1, "k")]
    got = {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(spark.createDataFrame(rows, brute.SCHEMA)).collect()}
    assert got == {1: 0, 2: 1}


def test_table_of_repeated_hashes(spark):
    rnd = random.Random(3)
    few, twice = [[rnd.getrandbits(64) - 2**63 for _ in range(n)] for n in (2000, 300)]
    rows = spark.createDataFrame([(h,) for h in few + twice + twice], "h long").repartition(7)
    table = bitfilter.build_twice(rows, 27)
    assert bitfilter.contains(table, np.array(twice).view(np.uint64), 27).all()
    assert bitfilter.contains(table, np.array(few).view(np.uint64), 27).mean() < 0.01


def test_line_dedup_by_runs_of_five(spark):
    rows = brute.fixture(n=30)
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, brute.SCHEMA).repartition(3)).collect()}
    assert got == brute.dedup_lines(rows)


def test_bands_lose_hardly_a_pair():
    rnd = random.Random(12)
    chars = [chr(c) for c in range(0x4E00, 0x9000)]
    lines = []
    for i in range(4000):
        # 70 runs of five, of which the first 60 are common: exactly 0.75
        a, b = rnd.sample(chars, 74), rnd.sample(chars, 10)
        lines += [(2 * i, "".join(a)), (2 * i + 1, "".join(a[:64] + b))]
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*lines)], names=["class", "line"])
    keys = {}
    for out in line_dedup._bands([batch]):
        keys |= dict(zip(out.column(0).to_pylist(), out.column(1).to_pylist()))
    lost = sum(not set(keys[2 * i]) & set(keys[2 * i + 1]) for i in range(4000))
    # 0.0001 of the pairs are expected to be lost
    assert lost <= 3


def _signed_lines(lines):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(lines)), pa.int64()), pa.array(lines)], names=["class", "line"])
    return pa.Table.from_batches(list(line_dedup._bands([batch]))).combine_chunks().to_batches()[0]


def test_sketches_rule_out_unlike_lines_only():
    rnd, alphabet = random.Random(8), [chr(c) for c in range(0x4E00, 0x9000)]
    lines = []
    for n in [1, 4, 5, 60, 64, 68, 69, 130, 300, 700, 5000] * 6:
        line = rnd.choices(alphabet, k=n)
        lines.append(line)
        for share in (0.01, 0.02, 0.03, 0.05, 0.3, 1):
            lines.append([rnd.choice(alphabet) if rnd.random() < share else c for c in line])
        lines.append(line[: n * 3 // 4])
    signed = _signed_lines(["".join(line) for line in lines])
    rows = [(1, c, n, k) for c, n, k in zip(*(signed.column(i).to_pylist() for i in (0, 2, 3)))]
    table = pa.Table.from_batches([pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=["key", "class", "n", "sketch"])])
    i, j = map(np.array, zip(*((a, b) for a in range(len(lines)) for b in range(a))))
    kept = set(zip(*line_dedup._Sketched(table, 75).may_be_alike(i, j)))
    sets = [brute.char_set("".join(line)) for line in lines]
    unlike = []
    for a, b in zip(i, j):
        share = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
        assert (a, b) in kept or share < 0.75
        if share < 0.2 and 0.75 <= len(sets[a]) / len(sets[b]) <= 4 / 3 and len(sets[a]) > 50:
            unlike.append((a, b) in kept)
    # those far from alike hardly ever go on to their texts; every pair of a key did before
    assert len(unlike) > 1000 and np.mean(unlike) < 0.01


@pytest.mark.parametrize("most", [1, 3, 100])
def test_all_pairs_of_a_key_in_batches_of_any_size(most):
    line = "".join(chr(0x4E00 + i) for i in range(50))
    signed = _signed_lines([line[:i] + "x" + line[i + 1 :] for i in range(12)] + [chr(0x5000 + i) * 50 for i in range(3)])
    members = {1: [3], 2: [0, 1, 13], 3: list(range(2, 15)), 4: [5, 6], 5: [7, 8, 9, 14]}
    at = [(key, c) for key, group in members.items() for c in group]
    rows = signed.take(pa.array([c for _, c in at]))
    rows = pa.RecordBatch.from_arrays([pa.array([k for k, _ in at]), rows.column(0), rows.column(2), rows.column(3)], names=["key", "class", "n", "sketch"])
    text = [line[:i] + "x" + line[i + 1 :] for i in range(12)] + [chr(0x5000 + i) * 50 for i in range(3)]
    sets = [brute.char_set(t) for t in text]
    small = {k: g for k, g in members.items() if len(g) <= most}
    large = {k: g for k, g in members.items() if len(g) > most}
    pairs = {(a, b) for g in small.values() for a in g for b in g if a < b} | {(g[0], b) for g in large.values() for b in g[1:]}
    alike = {(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    for step in (1, 2, 5, 50):
        batches = [rows.slice(k, step) for k in range(0, len(at), step)]
        out = pa.Table.from_batches(list(line_dedup._proposed(75, most)(iter(batches)))).to_pylist()
        found = {(r["a"], r["b"]) for r in out if r["key"] is None}
        assert alike and alike <= found <= {(a, b) for a, b in pairs if b < 12}
        assert {(r["b"], r["key"]) for r in out if r["key"] is not None} == {(b, k) for k, g in large.items() for b in g}


def test_line_dedup_with_keys_that_many_lines_share(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "GROUP", 1)
    rows = brute.fixture(n=30)
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, brute.SCHEMA).repartition(3)).collect()}
    assert got == brute.dedup_lines(rows)


def test_table_keys_lose_hardly_a_pair():
    # sets of 70 hashes with 60 in common: exactly 0.75
    n = 40000
    rnd = np.random.default_rng(9)
    common = rnd.integers(0, 2**64, (n, 60), dtype=np.uint64)
    keys = []
    for _ in range(2):
        sets = np.concatenate([common, rnd.integers(0, 2**64, (n, 10), dtype=np.uint64)], axis=1)
        keys.append(near_dup._half_keys(sets.reshape(-1), np.arange(n) * 70))
    same, halves = keys[0] == keys[1], near_dup.HALVES
    met = same[:halves].any(axis=0) & same[halves:].any(axis=0)
    # 0.00002 of the pairs are expected to be lost
    assert n - met.sum() <= 6


HEADS = [
    "Copyright The Kubernetes Authors.",
    "Copyright The OpenTelemetry Authors",
    "Copyright (c) 2020 A. Person\nAll rights reserved.",
    "Portions Copyright 2020 A. Person",
    "Copyright in 2020 by A. Person",
    "Copyright (c) 2020 A. Person\n(c) 2021 B. Person\nCopyright C. Person\n",
    "© A. Person",
    "",
]


def test_licenses_wrapped_at_any_width(spark):
    rows = []
    for name, titles, text in license_scan.WHOLE:
        for width in range(30, 121, 3):
            for head in HEADS[width % 4 :: 4]:
                wrapped = textwrap.fill(text, width, break_long_words=False)
                rows.append((len(rows), f"{head}\n{wrapped}", name, "s", 1, "k"))
                rows += [(len(rows), f"{title}\n{head}\n{wrapped}", name, "s", 1, "k") for title in titles[:1]]
    text = license_scan.ISC_GRANT + license_scan.ISC_NOTICE.replace("above ", "above\n") + license_scan.ISC_WARRANTY
    rows += [(len(rows), text, "ISC", "s", 1, "k"), (len(rows) + 1, "Copyright A. Person\n" + text, "ISC", "s", 1, "k")]
    docs = spark.createDataFrame(rows, brute.SCHEMA)
    got = license_scan.scan_licenses(docs, license_scan.known_licenses(spark)).select("doc_id", "license").collect()
    assert sorted(map(tuple, got)) == sorted((r[0], r[2]) for r in rows)


PUBLISHED = {
    "Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0-Perl", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0", "GFDL-1.2": "GFDL-1.2", "GFDL-1.3": "GFDL-1.3",
    "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0",
}
FOLDER = "/usr/share/common-licenses"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no published texts on this machine")
def test_long_licenses_wrapped(spark):
    rows = []
    for file, name in PUBLISHED.items():
        with open(os.path.join(FOLDER, file), encoding="utf-8") as f:
            text = f.read()
        head = HEADS[len(rows) % len(HEADS)]
        rows += [(len(rows), text, name, "s", 1, "k"), (len(rows) + 1, f"{head}\n\n{text}", name, "s", 1, "k")]
        for width in range(30, 121, 15):
            wrapped = textwrap.fill(text, width, break_long_words=False)
            rows.append((len(rows), wrapped, name, "s", 1, "k"))
            # one that begins with its own statement, over several lines, is not found below another one
            if file != "BSD":
                rows.append((len(rows), f"{HEADS[0]}\n\n{wrapped}", name, "s", 1, "k"))
    docs = spark.createDataFrame(rows, brute.SCHEMA)
    got = license_scan.scan_licenses(docs, license_scan.known_licenses(spark)).select("doc_id", "license").collect()
    assert sorted(map(tuple, got)) == sorted((r[0], r[2]) for r in rows)


def test_license_sql_states_the_same_rule(spark, tmp_path):
    texts = [f"{head}\n{textwrap.fill(text, 78)}\n{tail}" for head in HEADS for _, _, text in license_scan.WHOLE for tail in ("", "Copyright notice", "all rights reserved")]
    texts += [f"x\n{a}\n\n{b}\n{c}" for a in HEADS for b in HEADS for c in ("SPDX-License-Identifier: GPL-2.0-only", "(c) 2020 é", "©", "Copyrighted 2020")]
    texts += [None, "", "\n \n", "all rights reserved\nall rights reserved", "Licensed under CC BY-NC-ND 2.5.", "- Copyright -", "copyright2020", "(C) 20201"]
    rows = [(None if i % 50 == 7 else i // 2, t, "en", "s", 1, "k") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, brute.SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    names = ["doc_id", "text_digest", "license", "n_notices", "notices"]
    got = license_scan.scan_licenses(docs, license_scan.known_licenses(spark)).select(*names).collect()
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(f"select {', '.join(names)} from ({oracles.license_scan()})").fetchall()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def _goes_on_from_python(plan):
    """Whether the frame is a Python step's rows, with nothing between that is shuffled."""
    for line in plan.splitlines():
        name = line.lstrip(" :+-").split(" ")[0].split("(")[0]
        if name not in ("Project", "Filter", "SubqueryAlias"):
            return name == "MapInArrow"
    return False


@pytest.mark.parametrize("group", [2, 2048])
def test_a_task_has_one_python_step(spark, monkeypatch, group):
    # two steps in a task are two processes, both of which keep their memory for the stages after
    kind, chained = type(spark.range(1)), []
    step = kind.mapInArrow

    def watched(self, *args, **kwargs):
        chained.append(_goes_on_from_python(self._jdf.queryExecution().analyzed().toString()))
        return step(self, *args, **kwargs)

    monkeypatch.setattr(kind, "mapInArrow", watched)
    monkeypatch.setattr(line_dedup, "GROUP", group)
    rows = brute.fixture(n=30)
    docs = spark.createDataFrame(rows, brute.SCHEMA).repartition(3)
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup_lines(docs).collect()}
    assert got == brute.dedup_lines(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(docs).collect()} == brute.near_duplicates(rows)
    assert chained and not any(chained)


def test_keys_of_a_line_go_out_in_parts():
    signed = _signed_lines(["line number %d" % i for i in range(500)])

    class Full:
        value = type("Table", (), {"values": np.full(1 << 24, 255, dtype=np.uint8)})

    out = list(line_dedup._met_keys(Full, Full)([signed]))
    assert sum(len(b) for b in out) == 500 * line_dedup.BANDS
    assert max(len(b) for b in out) <= 1 << 13


def test_similar_pairs_of_many_sizes():
    rnd = random.Random(8)
    pairs = []
    for i in range(600):
        a = "".join(rnd.choice("abcdeé ") for _ in range(rnd.choice([1, 4, 5, 30, 300]))) + "x"
        b = a if i % 7 == 0 else a[: rnd.randrange(len(a) + 1)] + "y" + a[rnd.randrange(len(a) + 1) :]
        pairs.append((i, i + 1000, a, b))
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*pairs)], names=["a", "b", "sb", "sa"])
    runs = lambda line: {line[i : i + 5] for i in range(max(1, len(line) - 4))}
    want = [i for i, _, a, b in pairs if 100 * len(runs(a) & runs(b)) >= 75 * len(runs(a) | runs(b))]
    assert 100 < len(want) < 500
    assert [x for out in line_dedup._alike(75)([batch]) for x in out.column(0).to_pylist()] == want


def _joined(pairs, nodes):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    return {n: top(n) for n in nodes}


def test_a_forest_stands_for_all_pairs_of_a_key():
    # near copies of one line: their pairs grew with the square of their number
    rnd = random.Random(3)
    alphabet = [chr(c) for c in range(0x4E00, 0x9000)]
    lines = []
    for _ in range(4):
        line = rnd.choices(alphabet, k=90)
        lines += ["".join(rnd.choice(alphabet) if rnd.random() < 0.03 else c for c in line) for _ in range(100)]
    signed = _signed_lines(lines)
    at = [(key, c) for key in (1, 2, 3) for c in rnd.sample(range(400), 250)]
    at.sort()
    rows = signed.take(pa.array([c for _, c in at]))
    rows = pa.RecordBatch.from_arrays([pa.array([k for k, _ in at]), rows.column(0), rows.column(2), rows.column(3)], names=["key", "class", "n", "sketch"])
    for step in (7, 400, 1000):
        batches = [rows.slice(k, step) for k in range(0, len(at), step)]
        every, forest = (pa.Table.from_batches(list(line_dedup._proposed(75, 300, few)(iter(batches)))).to_pylist() for few in (False, True))
        for key in (1, 2, 3):
            nodes = [c for k, c in at if k == key]
            all_pairs, few = ([(r["a"], r["b"]) for r in found if r["of"] == key] for found in (every, forest))
            assert _joined(few, nodes) == _joined(all_pairs, nodes) and set(few) <= set(all_pairs)
            assert len(few) == 250 - len(set(_joined(few, nodes).values())) < len(all_pairs) / 5
    # inside a component nothing is left to judge
    known = rows.append_column("component", pa.array([c // 100 for _, c in at]))
    assert not any(r["a"] // 100 == r["b"] // 100 for out in line_dedup._proposed(75, 300)([known]) for r in out.to_pylist())


def test_pairs_of_keys_with_a_broken_forest(spark, monkeypatch):
    # of lines around the limit, what a sketch lets through is often not alike: then the other pairs of the key count
    rnd = random.Random(5)
    lines = []
    for _ in range(12):
        line = [rnd.choice("abcdefgh ") for _ in range(70)]
        for _ in range(14):
            lines.append("".join(rnd.choice("abcdefgh") if rnd.random() < 0.02 else c for c in line))
    rnd.shuffle(lines)
    rows = [(i, "\n".join(lines[3 * i : 3 * i + 3]), "en", "s", 1, "k") for i in range(56)]
    kept, stored = {}, line_dedup.stored
    monkeypatch.setattr(line_dedup, "stored", lambda df, name: kept.setdefault(name, []).append(stored(df, name)) or kept[name][-1])
    monkeypatch.setattr(line_dedup, "PASS_ROWS", 1)
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, brute.SCHEMA)).collect()}
    assert got == brute.dedup_lines(rows)
    assert len(kept["line-proposed"]) == line_dedup.PASSES
    assert kept["line-open"][0].count() and kept["line-links"][1].count()


def test_a_stored_frame_leaves_no_shuffle_files(spark):
    from tilewright.llm.shared import stored

    folders = [d.getPath() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f for d in folders for _, _, names in os.walk(d) for f in names if f.startswith("shuffle")}
    before = files()
    out = stored(spark.range(1000).repartition(7, "id"), "some")
    assert not files() - before and out.count() == 1000
