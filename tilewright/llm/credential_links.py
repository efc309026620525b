"""Secrets in texts: strong patterns on their own, weak ones only beside what completes a credential.

A credential has parts: an identifier (access id, user), a secret (password, token, key) and an
endpoint (address, host). Strong patterns are reported wherever they stand. A weak candidate, such
as a user name, a short run of hex digits or an address, says little alone. Each part has a scope: its own
place and ``REACH`` code points on either side. An interval join of candidates' scopes with all parts
of the same text finds what co-occurs, and a weak candidate is reported only when the roles in its
scope complete it (``PATTERNS``). Places are code points, the end is exclusive. Texts of secrets are
never written, places only.

Everything is made of column functions: a pattern's matches and the gaps between them give lengths, whose
running sums are the places. The join is on (text, cell of ``CELL`` code points), so a text with very many
parts is spread over its cells, and a cell holds no more parts than fit into it.

Defined cases: a null text is empty, and an empty one has no spans; every row is a text of its own, also
with a repeated or null ``doc_id``; candidates that overlap a strong span are left out; columns
other than ``doc_id`` and ``text`` are not read; no rows give no rows.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilewright.llm.shared import stored

#: Code points on either side of a part within which another one may complete it.
REACH = 200
CELL = 256


def _either_case(words: str) -> str:
    """A pattern's plain letters in either case, with none but the ASCII letters."""
    return "".join(f"[{c.upper()}{c}]" if c.isascii() and c.isalpha() else c for c in words)


def _assigned(names: str, value: str) -> str:
    return rf"""({_either_case(names)})["']?\x20*[:=]\x20*["']?({value}+)"""


@dataclass(frozen=True)
class Pattern:
    """Matches whose ``group`` has ``least`` to ``most`` characters; ``needs``: roles of which one set must be in scope."""

    kind: str
    role: str
    regex: str
    group: int
    least: int
    most: int = 1 << 30
    needs: tuple[tuple[str, ...], ...] = ()

    @property
    def strong(self) -> bool:
        return not self.needs


_VALUE = "[A-Za-z0-9+/_.=-]"
_SCHEMES = "https?|ftp|ssh|postgres|postgresql|mysql|mongodb|redis|amqp|jdbc:[a-z]+|s3"

#: Strong patterns, then weak ones. A run of 24 digits or of 16 letters after AKIA is what is left of
#: the longest runs when those that are too short are dropped.
PATTERNS = (
    Pattern("assign", "secret", _assigned("password|passwd|secret|token|api_?key", _VALUE), 2, 6),
    Pattern("access", "identifier", "AKIA[A-Z0-9]{16,}", 0, 20),
    Pattern("hex", "secret", "[0-9a-f]{24,}", 0, 24),
    Pattern("identifier", "identifier", "AKIA[A-Z0-9]{4,}", 0, 8, 19, (("secret",),)),
    Pattern("identifier", "identifier", _assigned("username|user|login|account|client_?id", "[A-Za-z0-9@+/_.-]"), 2, 3, needs=(("secret",),)),
    Pattern("credential", "secret", _assigned("passphrase|pass|pwd|auth|credentials?|private_?key", _VALUE), 2, 6, needs=(("identifier",), ("endpoint",))),
    Pattern("credential", "secret", "[0-9a-f]{16,}", 0, 16, 23, (("identifier",),)),
    Pattern("credential", "secret", "[A-Za-z0-9+/]{40,}", 0, 40, 40, (("identifier",),)),
    Pattern("endpoint", "endpoint", rf"""({_SCHEMES})://[^\x20\x09-\x0D"'<>]+""", 0, 10, needs=(("identifier", "secret"),)),
    Pattern("endpoint", "endpoint", _assigned("host|hostname|server|endpoint|database", "[A-Za-z0-9._:-]"), 2, 4, needs=(("identifier", "secret"),)),
)
KINDS = tuple(dict.fromkeys(p.kind for p in PATTERNS))
ROLES = ("identifier", "secret", "endpoint")


def _lengths(text: Column, number: int, pattern: Pattern) -> Column:
    """An entry for each match: pattern, place in the row of matches, code points before it and in it, and whether it counts."""
    regex = F.lit(pattern.regex)
    found = F.arrays_zip(
        F.split(text, pattern.regex, -1).alias("gap"),
        F.regexp_extract_all(text, regex, F.lit(0)).alias("all"),
        F.regexp_extract_all(text, regex, F.lit(pattern.group)).alias("value"),
    )
    entry = lambda m, i: F.struct(
        F.lit(number).alias("pattern"),
        i.alias("i"),
        F.length(m["gap"]).cast("long").alias("gap"),
        F.length(m["all"]).cast("long").alias("length"),
        F.length(m["value"]).between(pattern.least, pattern.most).alias("good"),
    )
    # what follows the last match has no match beside it
    matched = F.filter(F.transform(found, entry), lambda e: e["length"].isNotNull())
    return F.when(text.rlike(pattern.regex), matched)


def located(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id) of every row and (row, pattern, start, end) of every match that is long enough."""
    text = F.coalesce("text", F.lit(""))
    entries = F.concat(*[F.coalesce(_lengths(text, n, p), F.array()) for n, p in enumerate(PATTERNS)])
    # row numbers must not change when a task runs again: they are read from the files
    rows = stored(documents.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), entries.alias("entries")), "secret-matches")
    each = rows.select("row", F.explode("entries").alias("e")).select("row", "e.*")
    before = Window.partitionBy("row", "pattern").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("length")).over(before)
    parts = each.withColumn("end", end).where("good").select("row", "pattern", (F.col("end") - F.col("length")).alias("start"), "end")
    return rows.select("row", "doc_id"), stored(parts, "secret-parts")


def _of_pattern(value) -> Column:
    """A column by the number of the pattern."""
    return F.element_at(F.array(*[F.lit(value(p)) for p in PATTERNS]), F.col("pattern") + 1)


def _cells(first: Column, last: Column) -> Column:
    return F.explode(F.sequence(F.floor(F.greatest(first, F.lit(0)) / CELL), F.floor(last / CELL)))


def linked(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """The strong parts, and the weak ones that others in their scope complete; ``parts``: row, pattern, start, end."""
    strong = _of_pattern(lambda p: p.strong)
    weak = parts.where(~strong).withColumn("cell", _cells(F.col("start") - reach, F.col("end") + reach))
    others = parts.select(
        "row",
        _cells(F.col("start"), F.col("end")).alias("cell"),
        _of_pattern(lambda p: p.role).alias("role"),
        strong.alias("strong"),
        F.col("start").alias("low"),
        F.col("end").alias("high"),
    )
    near = weak.join(others, ["row", "cell"]).where((F.col("low") < F.col("end") + reach) & (F.col("high") > F.col("start") - reach))
    over = F.col("strong") & (F.col("low") < F.col("end")) & (F.col("high") > F.col("start"))
    seen = near.groupBy("row", "pattern", "start", "end").agg(
        F.max(over).alias("over"), *[F.max(F.col("role") == role).alias(role) for role in ROLES]
    )
    complete = functools.reduce(
        Column.__or__,
        [
            (F.col("pattern") == n) & functools.reduce(Column.__or__, [functools.reduce(Column.__and__, map(F.col, roles)) for roles in p.needs])
            for n, p in enumerate(PATTERNS)
            if not p.strong
        ],
    )
    completed = seen.where(~F.col("over") & complete).select("row", "pattern", "start", "end")
    return parts.where(strong).unionByName(completed)


def secret_spans(documents: DataFrame, reach: int = REACH) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id) of every row, and (row, kind, role, strong, start, end) of every span to report."""
    rows, parts = located(documents)
    spans = linked(parts, reach).select(
        "row", _of_pattern(lambda p: p.kind).alias("kind"), _of_pattern(lambda p: p.role).alias("role"), _of_pattern(lambda p: p.strong).alias("strong"), "start", "end"
    )
    # two weak patterns of one kind may hit the same place
    return rows, spans.distinct()


def secret_report(documents: DataFrame, reach: int = REACH) -> DataFrame:
    """doc_id, a count of each kind, and the strong spans and all spans as ``kind:start:end`` in order of start and kind."""
    rows, spans = secret_spans(documents, reach)
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    named = spans.withColumn("name", F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string")))
    entry = F.struct("start", order.alias("order"), "end", "name")
    joined = lambda entries: F.array_join(F.transform(F.sort_array(entries), lambda e: e["name"]), ",")
    of_row = named.groupBy("row").agg(
        *[F.count_if(F.col("kind") == kind).alias(f"n_{kind}") for kind in KINDS],
        joined(F.collect_list(F.when(F.col("strong"), entry))).alias("strong_spans"),
        joined(F.collect_list(entry)).alias("spans"),
    )
    filled = rows.join(of_row, "row", "left")
    return filled.select(
        "doc_id",
        *[F.coalesce(f"n_{kind}", F.lit(0)).cast("long").alias(f"n_{kind}") for kind in KINDS],
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("strong_spans", "spans")],
    )
