"""Column expressions for text: masking, highlighting, identifiers, JSON."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def mask_cols(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Hide sensitive text: letters become x or X and digits become n."""
    return df.withColumns({c: F.mask(F.col(c)) for c in cols})


def highlight(text: Column, term: str) -> Column:
    """Wrap every occurrence of the term, in any case, in <em> tags."""
    quoted = "".join(c if c.isalnum() or c == " " else "\\" + c for c in term)
    return F.regexp_replace(text, f"(?i)({quoted})", "<em>$1</em>")


def stable_id(*cols: Column) -> Column:
    """A 60-bit number that depends on the values alone.

    It needs no counter and no sort, so ids are given where the row is read,
    in a batch and in a stream alike.
    """
    digest = F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def computed_once(df: DataFrame, row: Column, *keep: str) -> DataFrame:
    """The kept columns and the fields of a struct that is costly to compute.

    A filter on a projected column is moved below the projection with the column's
    expression inside, and JSON is then parsed once per mention. A generator is a
    border such filters do not cross.
    """
    return df.select(*keep, F.inline(F.array(row)))


def parse_marked(
    df: DataFrame, schema: T.StructType, col: str = "value", keep: Iterable[str] = (), valid: Column | None = None
) -> DataFrame:
    """JSON text as typed rows, parsed once: the columns of `schema`, those to `keep`, the
    text as `value`, and `rejected`: whether it did not parse, or is not `valid`, a condition
    on the typed columns."""
    keep = list(keep)
    probe = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    text = df.select(F.col(col).alias("_text"), *keep)
    whole = F.struct(F.from_json("_text", probe, options).alias("_json"))
    parsed = computed_once(text, whole, "_text", *keep).select("_text", *keep, "_json.*", F.isnull("_json").alias("_none"))
    # An empty text, or one that is JSON but no object, gives no row at all.
    broken = F.col("_text").isNull() | F.col("_corrupt").isNotNull() | F.col("_none")
    if valid is not None:
        broken = broken | ~F.coalesce(valid, F.lit(False))
    return parsed.select(*schema.names, *keep, F.col("_text").alias("value"), broken.alias("rejected"))


def parse_json(
    df: DataFrame, schema: T.StructType, col: str = "value", keep: Iterable[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Split JSON text into typed rows and rejects (`value` of what did not parse).
    Further columns to `keep` follow the typed ones."""
    keep = list(keep)
    marked = parse_marked(df, schema, col, keep)
    return marked.where(~F.col("rejected")).select(*schema.names, *keep), marked.where("rejected").select("value")


def json_text(*cols: str | Column) -> Column:
    """One JSON object of the columns; a null field is left out."""
    return F.to_json(F.struct(*cols) if cols else F.struct("*"))


def to_json_rows(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """The rows as JSON text in a column `value`."""
    return df.select(json_text(*(cols or df.columns)).alias("value"))


def _object_pattern(depth: int) -> str:
    """A JSON object with objects nested up to `depth` times; braces in text do not count."""
    inner = "" if depth == 0 else "|" + _object_pattern(depth - 1)
    return r'\{(?:[^{}"]++|"(?:[^"\\]++|\\.)*+"' + inner + r")*+\}"


_OBJECT = _object_pattern(4)
_ARRAY = r"\[(?:[^\[\]{}\"]++|\"(?:[^\"\\]++|\\.)*+\"|" + _OBJECT + r")*+\]"


# The parts of JSON text: strings, marks, and what lies between; together they are the text.
_TOKEN = r'"(?:[^"\\]++|\\.)*+"|[{}\[\],:]|[^"{}\[\],:]++'


def _walk(value: Column, kept: str, step: Callable[[Column, Column], dict[str, Column]], out: str) -> Column:
    """Go through the parts of JSON text with their depth, for nesting of any depth. `step`
    gives the fields of the state (`kept` as DDL) after a part; `out` is returned."""

    def merge(state: Column, part: Column) -> Column:
        change = F.when(part.isin("{", "["), 1).when(part.isin("}", "]"), -1).otherwise(0)
        fields = step(state, part)
        return F.struct((state["depth"] + change).alias("depth"), *[v.alias(k) for k, v in fields.items()])

    start = F.from_json(F.lit('{"depth":0}'), f"depth int, {kept}")
    return F.aggregate(F.regexp_extract_all(value, F.lit(_TOKEN), F.lit(0)), start, merge, lambda s: s[out])


def _deep_member(value: Column, name: str) -> Column:
    """The text of a member of an object; the last one if the name is repeated."""

    def step(s: Column, part: Column) -> dict[str, Column]:
        top = s["depth"] == 1
        begins = top & (part == ":") & (s["last"] == f'"{name}"')
        inside = s["inside"].eqNullSafe(True) & ~(top & part.isin(",", "}"))
        text = F.when(begins, "").when(inside, F.concat(s["text"], part)).otherwise(s["text"])
        last = F.when(top & (F.trim(part) != ""), part).otherwise(s["last"])
        return {"inside": begins.eqNullSafe(True) | inside, "text": text, "last": last}

    return F.trim(_walk(value, "inside boolean, text string, last string", step, "text"))


def _deep_elements(value: Column) -> Column:
    """The texts of the elements of an array."""

    def step(s: Column, part: Column) -> dict[str, Column]:
        ends = (s["depth"] == 1) & part.isin(",", "]")
        piece = F.coalesce(s["piece"], F.lit(""))
        out = F.coalesce(s["out"], F.array().cast("array<string>"))
        return {
            "piece": F.when(ends | (s["depth"] == 0), "").otherwise(F.concat(piece, part)),
            "out": F.when(ends, F.concat(out, F.array(F.trim(piece)))).otherwise(out),
        }

    return _walk(value, "piece string, out array<string>", step, "out")


def raw_member(value: Column, name: str, parsed: Column) -> Column:
    """The text of a member of a JSON object exactly as it was written, given the text
    that a JSON function made of it.

    JSON functions write numbers anew (1.20 becomes 1.2, long decimals lose digits),
    so the text is cut out. Objects nested deeper than the pattern goes are cut by
    counting brackets. Only a member that is no object or array, or whose name is written
    with escapes, is the rewritten text.
    """
    cut = F.regexp_extract(value, rf'(?<!\\)"{name}"\s*:\s*({_OBJECT}|{_ARRAY})', 1)
    deep = _deep_member(value, name)
    same = lambda c: F.get_json_object(c, "$") == parsed
    nested = parsed.startswith("{") | parsed.startswith("[")
    return F.when(same(cut), cut).when(nested & same(deep), deep).otherwise(parsed)


def raw_elements(value: Column) -> Column:
    """The objects of a JSON array, each exactly as it was written; null if not an array.

    Where the whole text is a list of objects as flat as the pattern, its cuts are taken;
    otherwise objects and arrays are cut by counting brackets.
    """
    cuts = F.regexp_extract_all(value, F.lit(_OBJECT), F.lit(0))
    objects = rf"^\s*\[\s*(?:{_OBJECT}(?:\s*,\s*{_OBJECT})*+)?\s*\]\s*$"
    parsed = F.from_json(value, "array<string>")
    exact = F.transform(
        F.arrays_zip(parsed.alias("parsed"), _deep_elements(value).alias("cut")),
        lambda e: F.when(e["cut"].startswith("{") | e["cut"].startswith("["), e["cut"]).otherwise(e["parsed"]),
    )
    deep = F.when(F.size(parsed) == F.size(_deep_elements(value)), exact).otherwise(parsed)
    return F.when(value.rlike(objects), cuts).otherwise(deep)
