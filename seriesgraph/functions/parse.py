"""Columns from dirty text: numbers, dates, versions, links, hashes. Bad input gives NULL, never an error."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
#: Python's float() also takes nan, inf and 1_000; here they count as not numeric.
OFFSET = r"(Z|[+-]\d{2}:?\d{2})$"


def permissive_double(text: Column, scraped: bool = False) -> Column:
    """Trimmed number or NULL; scraped values may also be '-' for none and carry a leading '+'."""
    t = F.trim(text)
    if scraped:
        t = F.regexp_replace(t, r"^\+", "")
    return F.when(t.rlike(NUMBER), t.try_cast("double"))


def whole_int(text: Column, scraped: bool = False) -> Column:
    """'13.0' is 13, '13.5' is NULL."""
    x = permissive_double(text, scraped)
    return F.when(x == F.floor(x), x.try_cast("int"))


def percent(text: Column) -> Column:
    return permissive_double(F.regexp_replace(F.trim(text), "%$", ""), scraped=True)


def iso_date(text: Column) -> Column:
    """yyyy-MM-dd as midnight UTC."""
    t = F.trim(text)
    return F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(t, F.lit("T00:00:00Z")).try_cast("timestamp"))


def iso_timestamp(text: Column, naive: str = "utc") -> Column:
    """ISO 8601; Z and offsets are honoured. Times without an offset are UTC, or NULL with naive='null'."""
    t = F.regexp_replace(F.trim(text), " ", "T")
    shaped = t.rlike(r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}(:\d{2}(\.\d+)?)?" + OFFSET[:-1] + "?)?$")
    known = t.rlike(OFFSET) if naive == "null" else F.lit(True)
    # What has no offset gets that of UTC, so that the session's zone has no say.
    full = F.when(t.rlike(OFFSET) & t.contains("T"), t).when(t.contains("T"), F.concat(t, F.lit("Z"))).otherwise(F.concat(t, F.lit("T00:00:00Z")))
    return F.when(shaped & known, full.try_cast("timestamp"))


#: Fixed value of the source: how a title names a version, as the words before it and its own parts.
VERSION_WORDS, VERSION_PARTS = ("patch", "notes"), (r"\d+", r"[.]\d+", r"(?:[.]\d+)?", r"[a-z]?")


def patch_version(title: Column) -> Column:
    """The version in a title such as 'Patch Notes 8.05b' or 'Patch 8.05.1'; a third part is part of it."""
    first, second = VERSION_WORDS
    found = F.regexp_extract(F.lower(title), rf"\b{first}\s+(?:{second}\s+)?({''.join(VERSION_PARTS)})", 1)
    return F.when(found != "", found)


def profile_id(href: Column, kind: str) -> Column:
    found = F.regexp_extract(href, rf"(?:^|//[^/]+)/{kind}/(\d+)(?:/|$)", 1)
    return F.when(found != "", found)


def profile_slug(href: Column, kind: str) -> Column:
    found = F.regexp_extract(href, rf"(?:^|//[^/]+)/{kind}/\d+/([^/?#]+)", 1)
    return F.when(found != "", found)


def namespaced(kind: Column, number: Column) -> Column:
    """type-id."""
    return F.concat_ws("-", kind, number)


def rekeyed(kind: Column, key: Column) -> Column:
    """Namespaced once: keys that already have a dash stay."""
    return F.when(key.contains("-"), key).otherwise(namespaced(kind, key))


def normal_name(name: Column) -> Column:
    """Lower case, everything but letters and digits as blanks, trimmed."""
    return F.trim(F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]", " "))


def _canonical(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    def text(source: str | None, payload: str | None) -> str:
        try:
            value = json.loads(payload)
            return json.dumps({"source": source, "payload": value}, sort_keys=True, separators=(",", ":"))
        except (TypeError, ValueError, RecursionError):
            return "\x00".join(("", source or "", *([] if payload is None else [payload])))

    for sources, payloads in pairs:
        yield pd.Series([text(x, y) for x, y in zip(sources, payloads)], dtype="object")


def content_hash(source: Column, payload: Column) -> Column:
    """SHA-256 of a JSON payload and its source: equal values hash alike whatever the order of keys at any depth.

    Hashed is one JSON text with sorted keys, so types, nulls, escapes and the order of lists count. What is no JSON
    (or NULL) is hashed as it is, apart from all JSON. Parsed once a row, in Arrow batches.
    """
    return F.sha2(F.pandas_udf(_canonical, "string")(source.cast("string"), payload.cast("string")), 256)


def json_object(reply: Column, schema: str) -> Column:
    """The object in a reply that may be fenced; NULL if it is no object or misses its shape."""
    body = F.trim(F.regexp_replace(F.regexp_replace(F.trim(reply), r"(?s)^```[a-zA-Z]*\s*", ""), r"(?s)\s*```$", ""))
    parsed = F.from_json(body, f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    return F.when(body.startswith("{") & parsed["_bad"].isNull(), parsed)


def request_text(title: Column, body: Column, blog: Column | None = None) -> Column:
    """Headings, trimmed notes, and a blog part where there is one."""
    parts = [F.concat(F.lit("# "), F.trim(title)), F.lit("## Notes"), F.trim(body)]
    if blog is not None:
        has = F.length(F.trim(blog)) > 0
        parts += [F.when(has, F.lit("## Blog")), F.when(has, F.trim(blog))]
    return F.concat_ws("\n", *parts)


def segment_text(segments: Column) -> Column:
    """Trimmed texts of array<struct<start,end,text,...>>, blanks skipped, joined by single blanks."""
    return F.array_join(F.filter(F.transform(segments, lambda s: F.trim(s["text"])), lambda t: t != ""), " ")


def segment_seconds(segments: Column) -> Column:
    return F.aggregate(segments, F.lit(0.0), lambda acc, s: acc + (s["end"] - s["start"]))


def word_chunks(text: Column, size: int = 180) -> Column:
    """Chunks of size words, joined by single blanks, as array<string>; no shuffle, one pass over the text."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"\S+(?:\s+\S+){{0,{size - 1}}}"), F.lit(0))
    return F.transform(found, lambda c: F.regexp_replace(c, r"\s+", " "))


def slim_rounds(rounds: Column, focal: Column) -> Column:
    """Per round: the focal player's stats and the ids of the others."""
    return F.transform(
        rounds,
        lambda r: F.struct(
            r["roundNum"].alias("round_num"), r["roundResult"].alias("result"), r["winningTeam"].alias("winning_team"),
            F.try_element_at(F.filter(r["playerStats"], lambda p: p["puuid"] == focal), F.lit(1)).alias("own"),
            F.transform(F.filter(r["playerStats"], lambda p: p["puuid"] != focal), lambda p: p["puuid"]).alias("others"),
        ),
    )
