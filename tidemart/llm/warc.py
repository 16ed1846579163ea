"""WARC records, and what a not-modified revisit stands for.

A crawler that is answered "not modified" stores a revisit record: headers, no body. Its
content is that of the latest earlier full response for the same canonical URL, if the
validators agree: the entity tag by weak comparison, or else the time of last
modification. The headers a 304 answer may carry replace those of the response.

The as-of join works in two levels. Time is cut into slices of about equal numbers of
records; inside a slice a window finds the latest earlier response, and for the first
records of a slice the last response of the earlier slices is carried over, from one row
per URL and slice. A URL with very many captures is spread over all slices.

Results for odd input: records without URL or time are kept and never resolved
(`no_earlier`); of responses at the same time the greatest record id is the later one (of
several under one id, the one with the greatest hash), and a response at the very time of a
revisit is not earlier; a revisit without validators is `no_validator`, one that disagrees
`changed`. Record ids may be missing or repeated: records are told apart by all they hold,
and those alike in everything are resolved alike. An empty table gives an empty result.
Further columns pass through, but for those with the name of a result column, which are
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The headers that a 304 answer may update.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
LINE = "\r\n"
VERSION = "WARC/1.1"


def canonical_url(url: Column) -> Column:
    """The URL without scheme, user, leading www, default port, fragment and closing slash;
    host in lower case, parameters in order."""
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    secure = F.lower(bare).startswith("https:")
    rest = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^(?:[^/?@]*@)?([^/?]*)", 1))
    host = F.regexp_replace(host, r"^www[0-9]*\.", "")
    host = F.regexp_replace(host, F.when(secure, F.lit(":443$")).otherwise(F.lit(":80$")), F.lit(""))
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(rest, r"\?(.*)$", 1)
    sorted_query = F.array_join(F.array_sort(F.split(query, "&")), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), sorted_query)).otherwise(F.lit("")))


def lower_keys(headers: Column) -> Column:
    """Header names in lower case; of several spellings of one name the last counts."""
    names = F.array_distinct(F.transform(F.map_keys(headers), F.lower))
    last = lambda name: F.element_at(
        F.map_values(F.map_filter(headers, lambda k, _: F.lower(k) == name)), -1
    )
    return F.map_from_arrays(names, F.transform(names, last))


def _slice(at: Column, splits: list) -> Column:
    if not splits:
        return F.lit(0)
    table = F.split(F.lit(",".join(map(str, splits))), ",").cast("array<bigint>")
    return F.size(F.filter(table, lambda s: s <= at))


def latest_earlier(records: DataFrame, slices: int = 64) -> DataFrame:
    """`records` (uid, url, at, record_id, full, facts with uid) with `found`: the facts of the latest
    response of the same URL that is earlier, null if there is none."""
    shares = [k / slices for k in range(1, slices)]
    time = F.unix_micros("at")
    splits = records.agg(F.percentile_approx(time, shares, 10_000)).first()[0] or []
    cut = records.withColumn("slice", _slice(time, sorted(set(splits))))
    response = F.when(F.col("full"), F.struct("at", "record_id", "facts"))
    # Revisits stand before responses of the same time.
    inside = Window.partitionBy("url", "slice").orderBy("at", "full", "record_id", "uid")
    near = cut.withColumn("_near", F.last(response, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    last = cut.where("full").groupBy("url", "slice").agg(F.max_by(F.struct("at", "record_id", "facts"), F.struct("at", "record_id", "uid")).alias("_last"))
    # One row per URL and slice, those without a response included.
    grid = cut.select("url", "slice").distinct().join(last, ["url", "slice"], "left")
    along = Window.partitionBy("url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = grid.select("url", "slice", F.last("_last", ignorenulls=True).over(along).alias("_before"))
    both = near.join(before, ["url", "slice"], "left")
    earlier = F.coalesce("_near", "_before")
    # A response of the same time as the revisit is not earlier; the order above sees to it.
    return both.withColumn("found", earlier["facts"]).drop("_near", "_before", "slice")


def weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def resolve_revisits(records: DataFrame, slices: int = 64) -> DataFrame:
    """Every record with `canonical_url`, `status`, `response_id`, `merged` headers and the
    `payload` it stands for.

    `records`: record_id, kind ('response' or 'revisit'), url, at (time), headers (map),
    payload. status is 'full' for a response and 'resolved', 'no_earlier', 'no_validator'
    or 'changed' for a revisit.
    """
    extra = [c for c in records.columns if c not in ("record_id", "kind", "url", "at", "headers", "payload")]
    rows = records.select(
        "record_id",
        "kind",
        "at",
        canonical_url(F.col("url")).alias("url"),
        F.col("url").alias("_url"),
        lower_keys(F.coalesce("headers", F.create_map().cast("map<string,string>"))).alias("headers"),
        F.struct(*[F.col(f"`{c}`") for c in extra] or [F.lit(None).cast("int").alias("_")]).alias("row"),
        "payload",
    )
    known = F.col("url").isNotNull() & F.col("at").isNotNull()
    full = F.coalesce(F.col("kind") == "response", F.lit(False))
    # Names a record by all it holds, since ids may be missing or repeated: missing values
    # are told from empty ones, and headers stand in the order of their names.
    text = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("-"))
    held = F.to_json(F.array_sort(F.map_entries("headers")))
    parts = [F.col("record_id").cast("string"), F.col("kind"), F.col("_url"), F.unix_micros("at").cast("string"), held]
    body = F.md5(F.col("payload"))
    rows = rows.withColumn("uid", F.unhex(F.md5(F.concat_ws("\n", *[text(p) for p in (*parts, body)]))))
    slim = rows.where(known).select(
        "uid", "record_id", "url", "at", full.alias("full"), F.struct("uid", "record_id", "headers").alias("facts")
    )
    found = latest_earlier(slim, slices).where(~F.col("full"))
    own, theirs = F.col("facts.headers"), F.col("found.headers")
    by_tag = weak(own["etag"]) == weak(theirs["etag"])
    by_time = own["last-modified"] == theirs["last-modified"]
    status = (
        F.when(F.col("found").isNull(), "no_earlier")
        .when(own["etag"].isNull() & own["last-modified"].isNull(), "no_validator")
        .when(F.coalesce(F.when(own["etag"].isNotNull(), by_tag).otherwise(by_time), F.lit(False)), "resolved")
        .otherwise("changed")
    )
    allowed = F.map_filter(own, lambda k, _: k.isin(*PERMITTED))
    kept = F.map_filter(theirs, lambda k, _: ~F.map_contains_key(allowed, k))
    answers = (
        found.select("uid", status.alias("status"), "found", F.map_concat(kept, allowed).alias("_merged"))
        .select(
            "uid",
            "status",
            F.when(F.col("status") == "resolved", F.col("found.uid")).alias("_body_of"),
            F.when(F.col("status") == "resolved", F.col("found.record_id")).alias("response_id"),
            F.when(F.col("status") == "resolved", F.col("_merged")).alias("_merged"),
        )
        # Repeated records have one answer.
        .dropDuplicates(["uid"])
    )
    def told(df: DataFrame, status: Column, response: Column, merged: Column, payload: Column) -> DataFrame:
        return df.select(
            "record_id",
            "kind",
            F.col("_url").alias("url"),
            "at",
            F.col("url").alias("canonical_url"),
            status.alias("status"),
            response.alias("response_id"),
            merged.alias("merged"),
            payload.alias("payload"),
            *[F.col(f"row.`{c}`").alias(c) for c in extra if c not in ("canonical_url", "status", "response_id", "merged")],
        )

    # Responses stand for themselves and are not moved.
    none = F.lit(None).cast(rows.schema["record_id"].dataType)
    responses = told(rows.where(full), F.lit("full"), none, F.col("headers"), F.col("payload"))
    # A record without a response has a key of its own, so that such records do not meet in
    # one task. Records are the left side of both joins: a response that very many revisits
    # stand for is split by AQE.
    asked = rows.where(~full).join(answers, "uid", "left").withColumn("_key", F.coalesce("_body_of", "uid"))
    bodies = (
        rows.where(full)
        .select(F.col("uid").alias("_key"), F.col("payload").alias("_body"))
        .dropDuplicates(["_key"])
    )
    resolved = F.col("_body_of").isNotNull()
    others = told(
        asked.join(bodies, "_key", "left"),
        F.coalesce("status", F.lit("no_earlier")),
        F.col("response_id"),
        F.coalesce("_merged", "headers"),
        F.when(resolved, F.col("_body")).otherwise(F.col("payload")),
    )
    return responses.unionByName(others)


# Files ----------------------------------------------------------------------------------


def record_text(record_id: Column, kind: Column, url: Column, at: Column, headers: Column, payload: Column) -> Column:
    """One record without its version line, as `read_warc` splits files."""
    http = F.concat(
        F.when(kind == "revisit", "HTTP/1.1 304 Not Modified").otherwise("HTTP/1.1 200 OK"),
        F.lit(LINE),
        F.array_join(F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), e["value"], F.lit(LINE))), ""),
        F.lit(LINE),
        F.coalesce(payload, F.lit("")),
    )
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", F.concat(F.lit("<urn:record:"), record_id.cast("string"), F.lit(">"))),
        ("WARC-Target-URI", url),
        ("WARC-Date", F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        ("Content-Type", F.lit("application/http")),
        ("Content-Length", F.octet_length(http).cast("string")),
    ]
    head = F.concat_ws(LINE, *[F.concat(F.lit(f"{name}: "), value) for name, value in fields])
    return F.concat(head, F.lit(LINE * 2), http, F.lit(LINE * 2))


def write_warc(records: DataFrame, path: str) -> None:
    """The records as uncompressed WARC files, one per partition."""
    text = record_text(*[F.col(c) for c in ("record_id", "kind", "url", "at", "headers", "payload")])
    records.select(F.concat(F.lit(VERSION + LINE), text)).write.option("lineSep", "\n").text(path)


def combined(entries: Column) -> Column:
    """Entries (key, value) as a map; the values of a repeated name stand in order, joined by a
    comma."""
    names = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    values = lambda n: F.transform(F.filter(entries, lambda e: e["key"] == n), lambda e: e["value"])
    return F.map_from_arrays(names, F.transform(names, lambda n: F.array_join(values(n), ", ")))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, kind, url, at, headers, payload) of the response and revisit records of
    uncompressed WARC files. Spark splits a file at the version lines, so one file is read
    by many tasks. Text that is no UTF-8 is replaced. A body that itself holds the version
    line is cut there, and files of other versions are not told apart."""
    raw = spark.read.option("lineSep", VERSION + LINE).text(path).where(F.length("value") > 0)
    value = F.col("value")
    field = lambda name: F.regexp_extract(F.col("_head"), rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)
    parts = raw.select(
        F.split(value, "\r\n\r\n", 2)[0].alias("_head"), F.split(value, "\r\n\r\n", 2)[1].alias("_block")
    )
    split = parts.select("_head", F.split("_block", "\r\n\r\n", 2).alias("_p"))
    http = F.split(F.col("_p")[0], LINE)
    lines = F.filter(F.slice(http, 2, F.size(http)), lambda x: F.instr(x, ":") > 0)
    entries = F.transform(
        "_lines",
        lambda x: F.struct(
            F.trim(F.substring_index(x, ":", 1)).alias("key"),
            F.trim(F.substr(x, F.instr(x, ":") + 1)).alias("value"),
        ),
    )
    return (
        split.withColumn("_lines", lines)
        .select(
            F.regexp_extract(field("WARC-Record-ID"), r"<(?:urn:record:)?([^>]*)>", 1).alias("record_id"),
            field("WARC-Type").alias("kind"),
            field("WARC-Target-URI").alias("url"),
            F.to_timestamp(field("WARC-Date")).alias("at"),
            combined(entries).alias("headers"),
            F.regexp_replace(F.coalesce(F.col("_p")[1], F.lit("")), r"\r\n\r\n\n?$", "").alias("payload"),
        )
        .where(F.col("kind").isin("response", "revisit"))
    )


def captures(pages: DataFrame) -> DataFrame:
    """Records that a crawler would have stored for the table of pages: the page itself at
    its turn, and a revisit some turns later. Most revisits repeat the page's validators;
    by page number some carry a weak tag, only the time, another tag, or none."""
    page = F.col("page_id")
    turn = lambda n: F.timestamp_seconds(F.lit(1_700_000_000) + n)
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    # In UTC whatever the zone of the session.
    stamp = lambda t: F.date_format(F.to_utc_timestamp(t, F.current_timezone()), "yyyy-MM-dd HH:mm:ss")
    first, later = turn(page * 60), turn(page * 60 + 30 + 3600 * (1 + page % 7))
    changed = stamp(turn(page * 60 - 86400))
    text_map = lambda *pairs: F.create_map(*[x for k, v in pairs for x in (F.lit(k), v)])
    response = text_map(
        ("ETag", tag), ("Last-Modified", changed), ("Date", stamp(first)), ("Content-Type", F.lit("text/html")),
        ("Content-Length", F.octet_length(F.coalesce("html", F.lit(""))).cast("string")),
    )
    sent = text_map(
        ("ETag", F.when(page % 11 == 3, '"other"').when(page % 5 == 0, F.concat(F.lit("W/"), tag)).when(page % 4 != 1, tag)),
        ("Last-Modified", F.when((page % 4 == 1) & (page % 9 != 1), changed)),
        ("Date", stamp(later)), ("Cache-Control", F.lit("max-age=60")), ("Content-Length", F.lit("0")),
    )
    revisit = F.map_filter(sent, lambda _, v: v.isNotNull())
    full = pages.select(
        (page * 2).alias("record_id"), F.lit("response").alias("kind"), "url", first.alias("at"),
        response.alias("headers"), F.col("html").alias("payload"),
    )
    again = pages.select(
        (page * 2 + 1).alias("record_id"), F.lit("revisit").alias("kind"), "url", later.alias("at"),
        revisit.alias("headers"), F.lit(None).cast("string").alias("payload"),
    )
    return full.unionByName(again)
