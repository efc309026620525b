import math
import random

import brute
import pytest

pytest.importorskip("tilewright.llm")

from pyspark.sql import functions as F  # noqa: E402

from tilewright.llm import decontamination, license_scan, quality_rules  # noqa: E402


def counts(text):
    w = brute.words(text)
    windows = {}
    for i in range(len(w) - 4):
        windows.setdefault(tuple(w[i : i + 5]), []).append(i)
    hit = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in (text or "").split("\n") if brute.words(x)]
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


def test_counts(spark):
    rows = brute.fixture() + [(None, "a b c d e f a b c d e | ** é x", None, None, None, None), (8, "a\na\n \n \nb", "en", "s", 1, "k")]
    got = quality_rules.features(spark.createDataFrame(rows, brute.SCHEMA)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted((r.doc_id or -1, *(r[n] for n in names)) for r in got) == sorted((r[0] or -1, *counts(r[1])) for r in rows)


def test_binomial_tail(spark):
    cases = [(10, 0, 0.025), (500, 3, 0.025), (20000, 400, 0.025), (3, 0, 0.5), (100000, 2400, 0.025), (7, 2, 0.5)]
    df = spark.createDataFrame(cases, "n long, k long, p double")
    for n, k, p in cases:
        got = df.where((F.col("n") == n) & (F.col("k") == k)).select(quality_rules.binomial_tail(F.col("n"), F.col("k"), p)).first()[0]
        want = sum(
            math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log(1 - p)) for i in range(k + 1)
        )
        assert got == pytest.approx(want, rel=1e-8)


def test_cutoffs_hold_the_risk(spark):
    rnd = random.Random(8)
    docs, labels = [], []
    for i in range(2400):
        good = i % 3 > 0
        word = lambda: "w%d" % rnd.randrange(10**6)
        text = " ".join(word() + ("$$" if (not good and rnd.random() < 0.8) else "") for _ in range(30))
        docs.append((i, text, "en" if i % 2 else "de", "s", 1, "k"))
        labels.append((i, int(good), 0))
    labels += [(None, 1, 0), (3, None, 0)]
    d = spark.createDataFrame(docs, brute.SCHEMA)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.kept for r in quality_rules.quality_rules(d, table).collect()}
    good = [got[i] for i in range(2400) if i % 3 > 0]
    bad = [got[i] for i in range(2400) if i % 3 == 0]
    assert all(good) and sum(bad) < 0.02 * len(bad)
    # too few labels certify nothing: only the base rule rejects
    few = quality_rules.quality_rules(d, table.where("doc_id < 60")).where("not kept and not base_failed").count()
    assert few == 0
    assert quality_rules.quality_rules(spark.createDataFrame([], brute.SCHEMA), table).count() == 0


def test_license_scan(spark):
    mit = license_scan.MIT
    spelled = "MIT  LICENCE\n\nCopyright (c) 2020 A. Person\n" + mit.replace(", ", ",\n  ").upper()
    rows = [
        (1, mit), (2, spelled), (3, mit + " more"), (4, None), (5, ""), (6, "prose here\n  * Released under the MIT LICENCE!\nmore"), (None, mit), (7, mit), (7, mit)
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "k") for i, t in rows], brute.SCHEMA)
    got = sorted(((r.doc_id or 0, r.license, r.n_notices, r.notices) for r in license_scan.scan_licenses(docs, license_scan.known_licenses(spark)).collect()), key=str)
    want = [
        (0, "MIT", 1, "MIT"), (1, "MIT", 1, "MIT"), (2, "MIT", 0, ""), (3, None, 0, ""), (4, None, 0, ""), (5, None, 0, ""), (6, None, 1, "MIT"), (7, "MIT", 1, "MIT"), (7, "MIT", 1, "MIT")
    ]
    assert got == want
    assert license_scan.scan_licenses(docs.limit(0), license_scan.known_licenses(spark)).count() == 0


def test_edit_search():
    rnd = random.Random(4)
    for _ in range(300):
        item = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 40)))
        text = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 60)))
        distance, end = decontamination.edit_search(item, text)
        assert distance == brute.edit_distance_in(item, text)
        assert brute.edit_distance_in(item, text[:end]) == distance


def test_decontamination(spark):
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice(["th", "er", "on", "an"]) for _ in range(rnd.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(rnd.randint(15, 50))) for i in range(6)] + [(6, None), (7, " "), (8, "tiny")]
    rows = []
    for i in range(40):
        text = prose(60)
        if i % 4 == 0:
            inside = list(items[i % 6][1])
            for _ in range(rnd.randint(0, 2 + len(inside) // 20)):
                at = rnd.randrange(len(inside))
                inside[at] = rnd.choice(["", "x", inside[at] + "y"])
            text += "\n" + "".join(inside).upper().replace(" ", "  \n", 1) + " " + prose(20)
        rows.append((i, text, "en", "s", 1, "k"))
    rows += [(90, None, None, None, None, None), (91, "", "en", "s", 1, "k"), (92, "a tiny one", "en", "s", 1, "k")]
    docs = spark.createDataFrame(rows, brute.SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for doc, text, *_ in rows:
        for number, item in items:
            item = decontamination.normal(item)
            if item and text and (d := brute.edit_distance_in(item, decontamination.normal(text))) <= len(item) // 20:
                want.add((doc, number, d))
    assert {(r.doc_id, r.item_id, r.distance) for r in decontamination.contaminated(docs, bench).collect()} == want
    assert len(want) >= 6
    clean = decontamination.decontaminate(docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {r[0] for r in rows} - {d for d, *_ in want}
    assert decontamination.decontaminate(docs, bench.limit(0)).count() == len(rows)
