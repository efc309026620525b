"""Quality rules whose cutoffs are certified on labelled holdouts. DataFrame functions only.

A rule rejects a document when one of its features is at least a cutoff. For every stratum
(value of ``lang``), rule and cutoff of a fixed grid, the labelled documents of good quality are
counted: ``n`` in all and ``k`` that the cutoff would reject. The cutoff is admissible when the
exact binomial test refutes a false rejection rate above the rule's share of ``risk``:
``P(Binomial(n, risk / rules) <= k) <= delta / tests``. The division by the number of tests (all
strata, rules and cutoffs, Bonferroni) makes all admissible cutoffs right at once with probability
``1 - delta``, whichever is picked afterwards. Picked is the one with most documents labelled
bad rejected, less ``COST`` for each good one; among equals, the mildest. Where none gains, or none
is admissible, the rule rejects nothing in that stratum.

Defined cases: null text is the empty text; null or blank ``lang`` is the stratum ``''``; labels
with null ``doc_id`` or ``quality`` are ignored, and of several labels of a document the lowest
counts; a repeated ``doc_id`` in documents is judged row by row. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.llm.shared import stored

RISK = 0.10
DELTA = 0.05
#: Terms summed next to ``k``; what lies below is bounded by a geometric series.
TERMS = 2048

#: rule -> cutoffs, mildest last.
GRID = {
    "symbols": [0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.8],
    "bangs": [0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.8],
    "dup_lines": [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8],
    "repeats": [0.02, 0.05, 0.08, 0.1, 0.12, 0.15, 0.18],
}
SYMBOLS = "#*$%&|<>"
WHITE = "\t\n\x0b\x0c\r"
NOT_SPACE = r"[^\x20\x09-\x0D]"
#: A cutoff must catch this many bad documents for every good one it rejects in the holdout.
COST = 5


def _without(text: Column, characters: str) -> Column:
    return reduce(lambda c, x: F.replace(c, F.lit(x)), characters, text)


def _with_windows(df: DataFrame, words: str, name: str, salt: int) -> DataFrame:
    """A hash of every five-word window: of pairs, then of threes, then of two threes that overlap.

    Each step is a column of its own: a lambda's input that is used twice is computed twice.
    """
    for source, apart in ((words, 1), (name, 1), (name, 2)):
        n = F.size(source) - apart
        step = F.zip_with(
            F.slice(source, F.lit(1), n), F.slice(source, F.lit(1 + apart), n), lambda a, b: F.xxhash64(F.lit(salt), a, b)
        )
        df = df.withColumn(name, step)
    return df


def _neighbours(name: str, merge) -> Column:
    """``merge`` of every two neighbours in an array column."""
    most = F.greatest(F.size(name) - 1, F.lit(0))
    return F.zip_with(F.slice(name, F.lit(1), most), F.slice(name, F.lit(2), most), merge)


def features(documents: DataFrame) -> DataFrame:
    """doc_id, lang and the counts of every document; one pass, no shuffle.

    ``n_repeat_words``: five-word windows are sorted by a 128-bit hash, so equal ones are
    neighbours; the positions of those that have an equal neighbour are sorted, and each covers
    the words up to the next, five at most.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    df = documents.select(
        "doc_id",
        F.coalesce(F.trim("lang"), F.lit("")).alias("lang"),
        text.alias("text"),
        F.array_remove(F.split(reduce(lambda c, x: F.replace(c, F.lit(x), F.lit(" ")), WHITE, text), " "), "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(NOT_SPACE))).alias("lines"),
    )
    df = df.select(
        "doc_id",
        "lang",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.length("text") - F.length(_without(F.col("text"), "!"))).cast("long").alias("n_bangs"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("words") >= 6, F.col("words")).alias("words"),
    )
    df = _with_windows(df, "words", "windows", 1)
    # most documents have no repeated window: only the others are sorted, with a second hash
    df = df.withColumn("repeated", F.size(F.array_distinct("windows")) < F.size("windows"))
    df = df.withColumn("words", F.when(F.col("repeated"), F.col("words")))
    df = _with_windows(df, "words", "other", 2).drop("words")
    pairs = F.zip_with("windows", "other", lambda h, g: F.struct(h.alias("h"), g.alias("g")))
    df = df.withColumn("windows", F.when(F.col("repeated"), pairs)).drop("other", "repeated")
    placed = F.transform("windows", lambda w, i: F.struct(w["h"].alias("h"), w["g"].alias("g"), i.alias("i")))
    df = df.withColumn("windows", F.sort_array(placed))
    df = df.withColumn("same", F.when(F.col("windows").isNotNull(), _neighbours("windows", lambda a, b: (a["h"] == b["h"]) & (a["g"] == b["g"]))))
    either = F.zip_with(F.concat(F.array(F.lit(False)), "same"), F.concat("same", F.array(F.lit(False))), lambda a, b: a | b)
    hits = F.filter(F.zip_with("windows", either, lambda w, hit: F.when(hit, w["i"])), lambda i: i.isNotNull())
    df = df.withColumn("hits", F.sort_array(hits))
    gaps = _neighbours("hits", lambda a, b: F.least(b - a, F.lit(5)))
    covered = F.aggregate(gaps, F.lit(5).cast("long"), lambda total, gap: total + gap)
    df = df.withColumn("n_repeat_words", F.when(F.size("hits") > 0, covered).otherwise(F.lit(0).cast("long")))
    return df.drop("windows", "same", "hits")


def shares() -> dict[str, Column]:
    """Feature of each rule, comparable between documents of any length."""
    words, lines = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "n_lines"))
    return {
        "symbols": F.col("n_symbols") / words,
        "bangs": F.col("n_bangs") / words,
        "dup_lines": F.col("n_dup_lines") / lines,
        "repeats": F.col("n_repeat_words") / words,
    }


def log_gamma(x: Column) -> Column:
    """Stirling's series at ``x + 8``, taken back to ``x >= 1``; right to 1e-13."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    shift = reduce(lambda a, b: a * b, [x + j for j in range(8)])
    return (y - 0.5) * F.log(y) - y + 0.9189385332046727 + series - F.log(shift)


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k), for k below the mean; never too small.

    The terms from ``k - TERMS`` up are summed; as the terms fall towards 0, the rest is at most
    the lowest of them times a geometric series.
    """
    odds = float(p / (1 - p))
    n, k = n.cast("double"), k.cast("double")
    log_top = log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p))
    start = F.struct(F.exp(log_top).alias("term"), F.exp(log_top).alias("total"), k.alias("i"))

    def step(acc, _):
        term = F.when(acc["i"] >= 1, acc["term"] * acc["i"] / ((n - acc["i"] + 1) * odds)).otherwise(F.lit(0.0))
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"), (acc["i"] - 1).alias("i"))

    def finish(acc):
        ratio = acc["i"] / ((n - acc["i"] + 1) * odds)
        rest = F.when((acc["i"] >= 1) & (ratio < 1), acc["term"] * ratio / (1 - ratio)).otherwise(F.lit(0.0))
        return acc["total"] + rest

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step, finish)


def certified_cutoffs(
    documents: DataFrame, labels: DataFrame, grid: dict[str, list[float]] = GRID, risk: float = RISK, delta: float = DELTA
) -> DataFrame:
    """lang, rule, cutoff, n, k, caught, tail: the picked admissible cutoff of each stratum and rule.

    ``documents`` is the output of ``features``.
    """
    label = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = documents.join(label, "doc_id")
    share = shares()
    long = known.select(
        "lang", "quality", F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), share[r].alias("x")) for r in grid])).alias("f")
    ).select("lang", "quality", "f.rule", "f.x")
    per_rule = {r: F.array(*[F.lit(float(c)) for c in cs]) for r, cs in grid.items()}
    cutoffs = reduce(lambda a, rule: F.when(F.col("rule") == rule, per_rule[rule]).otherwise(a), grid, F.lit(None).cast("array<double>"))
    counted = stored(
        long.select("lang", "rule", "quality", "x", F.explode(cutoffs).alias("cutoff"))
        .groupBy("lang", "rule", "cutoff")
        .agg(
            F.count_if(F.col("quality") == 1).alias("n"),
            F.count_if((F.col("quality") == 1) & (F.col("x") >= F.col("cutoff"))).alias("k"),
            F.count_if((F.col("quality") != 1) & (F.col("x") >= F.col("cutoff"))).alias("caught"),
        ),
        "quality-counts",
    )
    share_of_risk, tests = risk / len(grid), max(1, counted.count())
    tail = F.when((F.col("n") > 0) & (F.col("k") < F.col("n") * share_of_risk), binomial_tail(F.col("n"), F.col("k"), share_of_risk)).otherwise(F.lit(1.0))
    admissible = counted.withColumn("tail", tail).where((F.col("tail") <= delta / tests) & (F.col("caught") > COST * F.col("k")))
    best = F.max_by(F.struct("cutoff", "n", "k", "caught", "tail"), F.struct(F.col("caught") - COST * F.col("k"), F.col("cutoff")))
    return admissible.groupBy("lang", "rule").agg(best.alias("b")).select("lang", "rule", "b.*")


def judge(documents: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``features`` rows with ``base_failed``, ``rules_failed`` (names) and ``kept``.

    There is one row of cutoffs per stratum; a skewed or absent stratum costs nothing in the join,
    which Spark broadcasts when the table of strata is small.
    """
    wide = cutoffs.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))
    share = shares()
    failed = F.filter(
        F.array(*[F.when(share[r] >= F.col("cutoffs")[r], F.lit(r)) for r in sorted(share)]), lambda name: name.isNotNull()
    )
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        documents.join(wide, "lang", "left")
        .withColumn("base_failed", base)
        .withColumn("rules_failed", F.coalesce(failed, F.array().cast("array<string>")))
        .withColumn("kept", ~F.col("base_failed") & (F.size("rules_failed") == 0))
        .drop("cutoffs")
    )


def quality_rules(documents: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """Whole operator: counts, certified cutoffs, verdicts; a row per row of ``documents``."""
    rows = stored(features(documents), "quality-features")
    return judge(rows, certified_cutoffs(rows, labels, risk=risk, delta=delta))
