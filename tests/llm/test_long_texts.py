"""One text of some megabytes next to short ones: results of the operators that read whole texts."""

import brute
import pytest

pytest.importorskip("tilewright.llm")

from pyspark.sql import functions as F  # noqa: E402

from tilewright.llm import credential_links, license_scan, line_dedup, near_dup, quality_rules, substring_dedup  # noqa: E402

PASSAGE = " ".join(f"p{i}" for i in range(60))
LINES = [" ".join(f"w{i}x{k * i * 7919 % 99991}" for k in range(1, 9)) for i in range(30000)]
LONG = "\n".join(LINES) + "\n" + PASSAGE


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, PASSAGE), (2, LONG), (3, LONG.replace("w17x", "v17x")), (4, LONG.replace("\n", " "))]
    return spark.createDataFrame([(i, t, "en", "s", len(t), "k") for i, t in rows], brute.SCHEMA).repartition(2)


def test_near_duplicates(docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(docs).collect()}
    n = len(LONG.split()) - 4
    assert {d: c for d, (_, c) in got.items()} == {1: 1, 2: 2, 3: 2, 4: 2}
    assert got[1][0] == 56 and got[2][0] == got[4][0] <= n


def test_line_dedup(docs):
    got = {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(docs.where("doc_id in (1, 2)")).collect()}
    assert got == {1: 0, 2: 1}


def test_substring_dedup(docs):
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(docs).collect()}
    n = len(LONG.split())
    # document 3 differs in the eight words of one line
    assert got == {1: (60, 0), 2: (n, 60), 3: (n, n - 8), 4: (n, n)}


def test_licenses_rules_and_secrets(docs, spark):
    assert {r.license for r in license_scan.scan_licenses(docs, license_scan.known_licenses(spark)).collect()} == {None}
    rules = {r.doc_id: r.n_words for r in quality_rules.features(docs).collect()}
    assert rules[2] == len(LONG.split())
    key = "AKIA" + "Q" * 16
    told = docs.withColumn("text", F.concat("text", F.lit(f" {key} ")))
    for r in credential_links.secret_report(told).where("doc_id > 1").collect():
        end = len(LONG) + 1 + len(key)
        assert (r.n_access, r.n_assign, r.n_hex) == (1, 0, 0) and f"access:{end - len(key)}:{end}" in r.spans
