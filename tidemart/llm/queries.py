"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import fillmiddle, fingerprints, innerproduct, langid, licenses, pieces, resample, secret_ledger
from tidemart.llm import toxicity, vectorcodes, warc
from tidemart.llm.decontaminate import find_items, hit_words
from tidemart.llm.neardup import near_duplicates
from tidemart.llm.rows import held_out
from tidemart.session import work_dir
from tidemart.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with the benchmark items whose windows of ten words occur in them."""
    found = find_items(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))
    n_hit = hit_words(F.col("spans"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


@_query
def op4_neardup(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose sets of two-word shingles are at least 80 % alike."""
    found = near_duplicates(read_table(spark, folder, "documents"), shingle=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@_query
def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from four fifths of them."""
    docs = read_table(spark, folder, "documents")
    model = langid.train(docs)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return langid.predict(rows, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


@_query
def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document, each different text scanned once."""
    found = secret_ledger.scan(read_table(spark, folder, "documents"), work_dir(spark, "secret-ledger"))
    spans = F.col("spans")
    number = lambda kind: F.size(secret_ledger.of_kinds(spans, (kind,))).cast("bigint")
    base = tuple(rule.kind for rule in secret_ledger.BASE)
    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(secret_ledger.span_text(secret_ledger.of_kinds(spans, base)), 256).alias("base_sha256"),
        secret_ledger.span_text(spans).alias("spans"),
    )


@_query
def op9_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces of every document, and whether they decode to its text."""
    vocabulary = pieces.load()
    docs = read_table(spark, folder, "documents").select("doc_id", F.col("text").cast("string").alias("text"))
    encoded = pieces.encode(docs, vocabulary).withColumnRenamed("text", "_text")
    back = pieces.decode(encoded, vocabulary)
    asked = F.translate(F.coalesce("_text", F.lit("")), pieces.SPACE, " ")
    return back.select(
        "doc_id",
        F.size("pieces").cast("bigint").alias("n_pieces"),
        "pieces",
        (F.col("text") == asked).alias("round_trip"),
    )


@_query
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learned from confirmed examples and unlabelled text."""
    docs = read_table(spark, folder, "documents")
    model = toxicity.train(docs, read_table(spark, folder, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@_query
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Documents drawn by how much they resemble those labelled as good; as many as the
    labels say are good."""
    docs, labels = read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    ratios = resample.train(docs, labels.where("quality = 1"))
    share = labels.agg(F.avg(F.col("quality").cast("double")).alias("s")).first()["s"]
    return resample.resample(docs, ratios, 1.0 if share is None else share)


@_query
def op5_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of an edited version of it."""
    return fingerprints.fingerprint_edits(read_table(spark, folder, "documents"))


@_query
def op1_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Licence notices in every document."""
    return licenses.scan_licenses(read_table(spark, folder, "documents"))


@_query
def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Captures of every page, each revisit with the response it stands for."""
    records = warc.captures(read_table(spark, folder, "pages"))
    told = warc.resolve_revisits(records)
    header = F.transform(
        F.array_sort(F.map_entries("merged")), lambda e: F.concat(e["key"], F.lit(": "), e["value"])
    )
    return told.select(
        "record_id",
        "kind",
        "canonical_url",
        "status",
        "response_id",
        F.array_join(header, "\n").alias("headers"),
        F.md5(F.coalesce("payload", F.lit(""))).alias("payload_md5"),
        F.char_length(F.coalesce("payload", F.lit(""))).cast("bigint").alias("n_chars"),
    )


@_query
def op11_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The ten greatest inner products of every hundredth vector with all others."""
    return innerproduct.top_products(read_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@_query
def op12_vectorcodes(spark: SparkSession, folder: str) -> DataFrame:
    """Codes of all vectors in eight parts of sixteen entries, and what they lose."""
    coded, books = vectorcodes.compress(read_table(spark, folder, "embeddings"))
    digits = F.transform("code", lambda e: F.lpad(F.lower(F.hex(e)), 2, "0"))
    return vectorcodes.with_label_error(coded).select(
        "vec_id",
        F.array_join(digits, "").alias("code"),
        "error",
        "label_error",
        F.lit(vectorcodes.codebook_digest(books)).alias("codebooks_sha256"),
    )


@_query
def op13_fillmiddle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document cut at two lines and rearranged, and the text rebuilt from that."""
    moved = fillmiddle.fill_in_middle(read_table(spark, folder, "documents"))
    restored = fillmiddle.restore(F.col("output"), F.col("form"))
    return moved.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored, 256).alias("restored_sha256"),
    )
