"""Secrets in every version of every document, by an incremental ledger of blobs.

A version's text is addressed by its SHA-256. The ledger holds one row per blob and rule
version with the spans found, so a text that was scanned before, under whatever path,
is not scanned again until the rules change; findings are joined back to all paths.

Everything is a DataFrame expression. Where matches lie follows from the lengths of the
matches and of the text between them, summed along the text.

Results for odd input: a null text is the empty text and has no findings; copies share
one blob; repeated rows count as they stand; rows without id are scanned like others; an
empty table gives an empty result and leaves the ledger as it is. Columns other than the
ones named are not looked at, and `redact` returns them as they are.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm.rows import packed, unpacked
from tidemart.sources.tables import ensure_folder


@dataclass(frozen=True)
class Rule:
    """Leftmost, non-overlapping matches of `pattern` whose `group` has `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The base rules in their order, then the added ones. The run of hex digits
# and the access key have their least length in the pattern: a match of the bare run is
# maximal, so both forms find the same spans.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
RULES = (
    *BASE,
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
)

SPANS = "array<struct<start: bigint, rank: int, end: bigint, kind: string>>"
_LEDGER = f"blob string, rule_version string, spans {SPANS}"


def rule_version(rules: tuple[Rule, ...]) -> str:
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def find_spans(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, spans) of unique (blob, text); spans in order of start and rule, counted in
    code points from 0, end excluded."""
    text = F.col("text")

    def cut(rank: int, rule: Rule) -> Column:
        parts = F.struct(
            F.lit(rank).alias("rank"),
            F.transform(F.split(text, rule.pattern, -1), F.char_length).alias("gaps"),
            F.transform(
                F.arrays_zip(
                    F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)).alias("m"),
                    F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)).alias("g"),
                ),
                lambda z: F.struct(F.char_length(z["m"]).alias("n"), F.char_length(z["g"]).alias("g")),
            ).alias("matches"),
        )
        return F.when(text.rlike(rule.pattern), parts)

    # A row without rank stands for the blob itself, so that clean blobs are kept too.
    none = F.struct(
        F.lit(None).cast("int").alias("rank"),
        F.array(F.lit(0)).alias("gaps"),
        F.array(F.struct(F.lit(0).alias("n"), F.lit(0).alias("g"))).alias("matches"),
    )
    cuts = F.array(none, *[cut(rank, rule) for rank, rule in enumerate(rules)])
    hits = texts.select("blob", F.explode(F.filter(cuts, lambda c: c.isNotNull())).alias("c"))
    rows = hits.select(
        "blob", F.col("c.rank").alias("rank"), F.posexplode(F.arrays_zip("c.gaps", "c.matches"))
    ).select(
        "blob",
        "rank",
        "pos",
        F.col("col.gaps").cast("bigint").alias("gap"),
        F.col("col.matches.n").cast("bigint").alias("n"),
        F.col("col.matches.g").alias("g"),
    )
    # The window and the grouping below share one shuffle by blob.
    along = Window.partitionBy("blob", "rank").orderBy("pos")
    placed = (
        rows.repartition("blob")
        .withColumn("_end", F.sum(F.col("gap") + F.coalesce("n", F.lit(0))).over(along))
        .withColumn("start", F.col("_end") - F.col("n"))
    )
    table = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.least).alias("least")) for r in rules])
    rule = table[F.col("rank")]
    # The text after the last match has no match of its own: n and g are null there.
    span = F.when(
        F.col("rank").isNotNull() & (F.col("g") >= rule["least"]),
        F.struct("start", "rank", F.col("_end").alias("end"), rule["kind"].alias("kind")),
    )
    return placed.groupBy("blob").agg(F.sort_array(F.collect_list(span)).cast(SPANS).alias("spans"))


def read_ledger(spark: SparkSession, ledger: str, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, spans) of the blobs scanned under these rules. Two scans at the same time may
    both have written a blob; its rows are equal then."""
    rows = spark.read.schema(_LEDGER).option("recursiveFileLookup", "true").parquet(ensure_folder(spark, ledger))
    return rows.where(F.col("rule_version") == rule_version(rules)).drop("rule_version")


def scan_new(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> None:
    """Scan the texts of `versions` (blob, text) that the ledger lacks, and add them to it."""
    spark = versions.sparkSession
    known = read_ledger(spark, ledger, rules).select("blob")
    # One text per blob: copies merge before the shuffle.
    unseen = versions.select("blob", F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["blob"])
    unseen = unseen.join(known, "blob", "left_anti")
    found = find_spans(unseen, rules)
    found.select("blob", F.lit(rule_version(rules)).alias("rule_version"), "spans").write.parquet(
        f"{ledger}/scan-{uuid.uuid4().hex}"
    )


def scan(
    docs: DataFrame,
    ledger: str,
    rules: tuple[Rule, ...] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, blob, spans) of every row, after bringing the ledger up to date."""
    versions = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    versions = versions.withColumn("blob", blob_id(F.col("text")))
    scan_new(versions, ledger, rules)
    return _with_spans(versions.select("doc_id", "blob"), ledger, rules)


def _with_spans(rows: DataFrame, ledger: str, rules: tuple[Rule, ...]) -> DataFrame:
    """Rows with a blob, beside the spans of that blob. Rows are the left side: a text with
    very many paths is split by AQE."""
    found = read_ledger(rows.sparkSession, ledger, rules).where(F.size("spans") > 0).dropDuplicates(["blob"])
    return rows.join(found, "blob", "left").withColumn("spans", F.coalesce("spans", F.array().cast(SPANS)))


def span_text(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def of_kinds(spans: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def masked(text: Column, spans: Column, mark: str) -> Column:
    """The text with `mark` in place of every span; spans that overlap share one mark."""
    before = lambda i: F.aggregate(  # noqa: E731  where the spans before the i-th end
        F.slice(spans, F.lit(1), i - 1), F.lit(0).cast("bigint"), lambda e, s: F.greatest(e, s["end"])
    )
    sub = lambda a, b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int"))
    piece = lambda i: F.when(
        F.element_at(spans, i)["start"] >= before(i),
        F.concat(sub(before(i), F.element_at(spans, i)["start"]), F.lit(mark)),
    ).otherwise(F.lit(""))
    end = F.aggregate(spans, F.lit(0).cast("bigint"), lambda e, s: F.greatest(e, s["end"]))
    parts = F.transform(F.sequence(F.lit(1), F.size(spans)), piece)
    tail = sub(end, F.char_length(text).cast("bigint"))
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(F.array_join(parts, ""), tail))


def redact(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """The documents with all their columns, secrets masked; n_chars, if there is one,
    counts the new text."""
    rows = packed(docs).withColumn("blob", blob_id(F.col("text")))
    scan_new(rows, ledger, rules)
    out = _with_spans(rows, ledger, rules).withColumn("text", masked(F.col("text"), F.col("spans"), mark))
    out = unpacked(out, docs.columns)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), F.col("n_chars")))
    return out
