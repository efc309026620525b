import brute
import pytest

pytest.importorskip("tilewright.llm")

from tilewright.llm import components, line_dedup, near_dup, substring_dedup  # noqa: E402


@pytest.fixture(scope="module")
def rows():
    return brute.fixture()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, brute.SCHEMA).repartition(5)


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, 3), (3, 5), (5, 7), (9, 9), (50, 60)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 141)} | {3: 3, 5: 3, 7: 3, 50: 50, 60: 50}
    assert got == want
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates(docs, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(docs).collect()}
    assert got == brute.near_duplicates(rows)


def test_near_duplicates_of_odd_tables(spark):
    empty = spark.createDataFrame([], brute.SCHEMA)
    assert near_dup.near_duplicates(empty).count() == 0
    twice = [(4, "a b c d e f", "en", "s", 1, "k")] * 2 + [(4, "p q", "en", "s", 1, "k"), (None, "a b c d e f", "en", "s", 1, "k"), (2, None, None, None, None, None)]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in near_dup.near_duplicates(spark.createDataFrame(twice, brute.SCHEMA)).collect())
    assert got == [(2, 0, 2), (4, 1, 4), (4, 2, 4), (4, 2, 4)]


def test_line_dedup(docs, rows):
    result = line_dedup.dedup_lines(docs)
    assert result.columns == [*docs.columns, "n_removed"]
    got = {r.doc_id: (r.text, r.n_removed) for r in result.collect()}
    assert got == brute.dedup_lines(rows)
    assert sum(n for _, n in got.values()) > 20


def test_line_dedup_of_odd_tables(spark):
    assert line_dedup.dedup_lines(spark.createDataFrame([], brute.SCHEMA)).count() == 0
    rows = [(None, "first line here", "en", "s", 1, "k"), (1, "first line here\n\nfirst line hers", "en", "s", 1, "k"), (1, None, "en", "s", 1, "k")]
    got = sorted((str(r.doc_id), str(r.text), r.n_removed) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, brute.SCHEMA)).collect())
    assert got == [("1", "", 2), ("1", "None", 0), ("None", "first line here", 0)]


def test_line_dedup_keeps_columns_of_any_name(spark):
    names = ["_hash", "hash", "Key", "lost", "_id", "_gone", "class", "line_no", "component", "first", "c", "line", "keys"]
    docs = spark.createDataFrame([(1, "one line of text\nother words here"), (2, "one line of text\nmore")], "doc_id long, text string")
    odd = docs.selectExpr(*(f"concat('{n}', doc_id) as `{n}`" for n in names), "doc_id", "'x' as n_removed", "text")
    got = {r.doc_id: r for r in line_dedup.dedup_lines(odd).collect()}
    assert {d: (r.text, r.n_removed) for d, r in got.items()} == {1: ("one line of text\nother words here", 0), 2: ("more", 1)}
    assert all(r[n] == f"{n}{d}" for d, r in got.items() for n in names)


def test_substring_dedup(docs, rows):
    got = {r.doc_id: (r.n_words, r.n_removed, r.text) for r in substring_dedup.remove_repeats(docs).collect()}
    want = brute.remove_repeats(rows)
    assert {d: v[:2] for d, v in got.items()} == {d: v[:2] for d, v in want.items()}
    assert got == want
    assert sum(v[1] for v in got.values()) > 500


def test_substring_dedup_of_odd_tables(spark):
    assert substring_dedup.remove_repeats(spark.createDataFrame([], brute.SCHEMA)).count() == 0
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(5, long, "en", "s", 1, "k"), (5, "y " + long, "en", "s", 1, "k"), (9, "x " + long + " z", "en", "s", 1, "k"), (None, long, "en", "s", 1, "k")]
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.text) for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, brute.SCHEMA)).collect())
    assert got == [("5", 60, 0, long), ("5", 61, 0, "y " + long), ("9", 62, 60, "x z"), ("None", 60, 0, long)]
