"""Check queries of the training-data operators, over whole tables."""

from __future__ import annotations

import pathlib
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.llm.bpe import encode_decode, token_count
from rillflow.llm.collocations import collocations
from rillflow.llm.decontamination import contained_items
from rillflow.llm.line_dedup import dedup_lines
from rillflow.llm.periodic_runs import longest_run, periodic_runs
from rillflow.llm.pii import KINDS, personal_data
from rillflow.llm.quality_model import SCORE_AT, quality_scores
from rillflow.llm.quality_rules import quality_rules
from rillflow.llm.secrets import review, scan
from rillflow.llm.simhash import near_duplicates
from rillflow.llm.spans import removed_bytes
from rillflow.llm.suffix_dedup import dedup_strings
from rillflow.llm.unit_dedup import dedup_units
from rillflow.llm.warc import page_archive

VOCABULARY = "byte_bpe_50k.json"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors of a session, once, so that they need no copy of their own."""
    context = spark.sparkContext
    if getattr(context, "_rillflow_sent", None):
        return
    package = pathlib.Path(__file__).parents[1]
    # Spark's file server hands the archive to executors; they never look at this folder.
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='rillflow-')}/rillflow", "zip", package.parent, package.name)
    context.addPyFile(archive)
    context._rillflow_sent = archive


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(_table(spark, sf_dir, "documents"), radius=4, shingle=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp0")), 16, "0").alias("fingerprint"), "component_id")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    done = page_archive(_table(spark, sf_dir, "pages"))
    return done.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that stand earlier, removed from every document."""
    return _removal_digest(dedup_strings(_table(spark, sf_dir, "documents"), length=100))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the share of its shingles."""
    found = contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_item_shingles", "n_shared", "containment")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_repeat_chars"]
    return quality_rules(_table(spark, sf_dir, "documents")).select(*columns)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, those deleted as parts of repeated runs, and a digest of the text left."""
    done = dedup_lines(_table(spark, sf_dir, "documents"), min_lines=3, long_words=50)
    return done.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document, with the forest's verdict."""
    found = scan(_table(spark, sf_dir, "documents"), review())
    return found.select("doc_id", "word", "nth", "candidate", "score", (F.col("score") >= 0.5).alias("is_secret"))


def op8_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """Ids of every document and the text decoded from them, as digests."""
    import public_tokenizers

    done = encode_decode(_table(spark, sf_dir, "documents"), vocabulary or public_tokenizers.path(VOCABULARY))
    return done.select(
        "doc_id", token_count("ids").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256")
    )


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    scores = quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scores.withColumn("predicted", (F.col("score") >= SCORE_AT).cast("int"))


def _removal_digest(done: DataFrame) -> DataFrame:
    """What was removed from each document, and a digest of what is left."""
    return done.select(
        "doc_id", "n_bytes", removed_bytes("removed").alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op10_unit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated paragraphs, lines and sentences removed from every document."""
    return _removal_digest(dedup_units(_table(spark, sf_dir, "documents"), ("paragraph", "line", "sentence"), min_words=8))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data of every document: counts and digest of the base ones, and all of them."""

    def listed(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    found = personal_data(_table(spark, sf_dir, "documents"))
    counts = [F.expr(f"size(filter(base, s -> s.kind = '{kind}'))").cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best collocations of every language."""
    found = collocations(_table(spark, sf_dir, "documents"))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def planted_periods(docs: DataFrame) -> DataFrame:
    """Documents of which a tenth, chosen by the CRC-32 of their id, repeat a stretch of words to their end."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), 0)
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("own"))
    rows = rows.withColumn("n", F.size("own")).withColumn("g", F.floor(F.col("h") / 10).cast("long")).withColumn("a", F.expr("g % greatest(n, 1)"))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    planted = F.array_join(F.expr("transform(own, (w, i) -> if(i < a, w, element_at(own, cast(1 + a + (i - a) % p as int))))"), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, and a digest of the text with one period of each."""
    found = periodic_runs(planted_periods(_table(spark, sf_dir, "documents"))).withColumn("best", longest_run())
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("best")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_warc": op2_warc,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_decontamination": op4_decontamination,
    "op5_quality_rules": op5_quality_rules,
    "op6_line_dedup": op6_line_dedup,
    "op7_secret_scan": op7_secret_scan,
    "op8_bpe": op8_bpe,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_unit_dedup": op10_unit_dedup,
    "op11_pii": op11_pii,
    "op12_collocations": op12_collocations,
    "op13_periodic_runs": op13_periodic_runs,
}
