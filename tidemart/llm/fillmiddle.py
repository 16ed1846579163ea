"""Fill-in-the-middle texts: a text cut in three, with the middle moved to the end.

A text is a run of units (lines unless asked otherwise). `regexp_count` gives their number n;
two numbers drawn from a hash of the id, both from 0 to n, are the cuts, and their order
gives a and b. A pattern of the row's own, unit{a}+ unit{b-a}+ rest, captures prefix, middle
and suffix in one match, and its replacement is the text in its new order. The quantifiers
are possessive: the regular expression walks the units once, without stack or backtracking,
so texts of any length and number of units pass. Everything is Spark's own functions, without
a shuffle.

Forms: `psm` is prefix, suffix, middle behind their marks; `spm` suffix, prefix, middle;
`plain` the text itself, taken where the text is empty, holds one of the marks, or is left
out by the rate. A mark begins with "<" and ends with ">", so none can arise where text and
marks meet, and the text is rebuilt from the marks alone.

Results for odd input: a null text is the empty one, which is plain with n = 0; a null id
draws as the empty id; equal ids draw equally, whatever their texts; copies come out alike; an
empty table gives an empty result; other columns pass as they are, but those with the name of
a result column, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Marks, and the unit of lines.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
LINES = r"[^\n]*\n|[^\n]+"


def draws(seed: int, doc_id: Column) -> list[Column]:
    """Four numbers of 32 bits from the hash of seed and id."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digest = F.sha2(named, 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]


def fill_in_middle(
    docs: DataFrame,
    unit: str = LINES,
    seed: int = 7,
    rate: int = 100,
    spm_rate: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`docs` with n (units, long), form, output, prefix_chars and middle_chars (code points;
    null if plain).

    Of 100 texts about `rate` are rearranged, and of 100 of those about `spm_rate` as spm.
    Every character must belong to one unit: `unit` is a pattern that matches somewhere in
    any text that is left, and never the empty text.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    h1, h2, h3, h4 = draws(seed, F.col(f"`{id_col}`"))
    kept = [c for c in docs.columns if c.lower() not in ("n", "form", "output", "prefix_chars", "middle_chars")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), text.alias("t"), h1, h2, h3, h4)
    rows = rows.toDF("row", "t", "h1", "h2", "h3", "h4")
    rows = rows.withColumn("n", F.regexp_count("t", F.lit(unit)).cast("bigint"))
    cuts = [F.col(h) % (F.col("n") + 1) for h in ("h1", "h2")]
    rows = rows.withColumns({"a": F.least(*cuts), "b": F.greatest(*cuts)})
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("t", F.lit(mark))
    plain = (F.col("t") == "") | marked | (F.col("h3") % 100 >= rate)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm_rate, "spm").otherwise("psm")
    # (?s): the rest may hold line ends.
    counted = lambda n: F.concat(F.lit(f"((?:{unit}){{"), n.cast("string"), F.lit("}+)"))
    pattern = F.concat(F.lit(r"(?s)\A"), counted(F.col("a")), counted(F.col("b") - F.col("a")), F.lit(r"(.*+)\z"))
    order = F.when(F.col("form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(
        f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2"
    )
    moved = F.regexp_replace("t", pattern, order)
    rows = rows.withColumn("form", form).withColumn("output", F.when(F.col("form") == "plain", F.col("t")).otherwise(moved))
    prefix, middle, _ = _pieces(F.col("output"), F.col("form"))
    return rows.select(
        *[F.col(f"row.`{c}`").alias(c) for c in kept],
        "n",
        "form",
        "output",
        F.char_length(prefix).cast("bigint").alias("prefix_chars"),
        F.char_length(middle).cast("bigint").alias("middle_chars"),
    )


def _pieces(output: Column, form: Column) -> tuple[Column, Column, Column]:
    """(prefix, middle, suffix) of an output; null if plain. Each mark stands there once."""
    after = lambda mark: F.substring_index(output, mark, -1)
    upto = lambda text, mark: F.substring_index(text, mark, 1)
    spm = form == "spm"
    some = lambda value: F.when(form != "plain", value)
    prefix = F.when(spm, upto(after(PREFIX), MIDDLE)).otherwise(upto(after(PREFIX), SUFFIX))
    suffix = F.when(spm, upto(after(SUFFIX), PREFIX)).otherwise(upto(after(SUFFIX), MIDDLE))
    return some(prefix), some(after(MIDDLE)), some(suffix)


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made from."""
    prefix, middle, suffix = _pieces(output, form)
    return F.when(form == "plain", output).otherwise(F.concat(prefix, middle, suffix))
