"""The registered queries of this subpackage and their DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.llm import credential_links as credentials
from tilewright.llm import decontamination as leaks
from tilewright.llm import license_scan as licenses
from tilewright.llm import line_dedup as lines
from tilewright.llm import mixing_model as mixing
from tilewright.llm import near_dup as near
from tilewright.llm import oracles, packing, phrases, token_files, whitening
from tilewright.llm import quality_model as model
from tilewright.llm import quality_rules as rules
from tilewright.llm import substring_dedup as substrings
from tilewright.llm.shared import held_out, prepare, staging_path, table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), licenses.known_licenses(spark))


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.score(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_removed")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = staging_path(spark, "token-files")
    parts = token_files.write_token_files(table(spark, sf_dir, "documents"), folder)
    return token_files.read_token_files(spark, folder, parts)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_pieces(table(spark, sf_dir, "documents"))


def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = model.score(documents, table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), *model.HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= model.THRESHOLD).cast("int").alias("predicted"),
    )


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = credentials.secret_report(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("strong_spans", 256).alias("base_sha256"), "spans")


def _prepared(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return run(spark, sf_dir)

    return call


#: Name -> (callable of session and folder, DuckDB text or None)
_QUERIES = {
    "op1_license_scan": (op1_license_scan, oracles.license_scan()),
    "op2_lm_scores": (op2_lm_scores, None),
    "op3_line_dedup": (op3_line_dedup, None),
    "op4_token_files": (op4_token_files, None),
    "op5_substring_dedup": (op5_substring_dedup, oracles.substring_dedup()),
    "op6_packing": (op6_packing, None),
    "op7_quality_model": (op7_quality_model, None),
    "op8_near_dedup": (op8_near_dedup, oracles.near_dedup()),
    "op9_decontamination": (op9_decontamination, None),
    "op10_quality_rules": (op10_quality_rules, oracles.quality_rules()),
    "op11_collocations": (op11_collocations, oracles.collocations()),
    "op12_whitening": (op12_whitening, None),
    "op13_secrets": (op13_secrets, oracles.secrets()),
}
QUERIES = {name: (_prepared(run), sql) for name, (run, sql) in _QUERIES.items()}
