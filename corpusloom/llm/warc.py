"""Not-modified revisits: as-of join by canonical URL to the latest earlier full response.

A revisit (status 304) says that a page has not changed since it was fetched. It is resolved against the
latest response of status 200 for the same canonical URL that is strictly earlier: if the validators
agree, it gets that response's payload, and its headers where a 304 may renew them.

The as-of step works on narrow rows. Time is cut into even ranges; the last response of each URL and
range is an aggregate, is carried on over at most ``RANGES`` rows per URL, and completes the look back
inside each range. A URL that fills a third of the table is thus spread over the ranges, and payloads
only move in the join by record id at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import materialize

RANGES = 1024
TRACKING = r"^(utm_[a-z]*|ref|fbclid|gclid|sessionid)(=.*)?$"
# Headers that a 304 may renew in the stored response (RFC 9110, 15.4.5, and RFC 9111, 3.2).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary", "age", "warning")
ADDRESS = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def canonical_url(url: Column) -> Column:
    """``host/path?query``: scheme, ``www.``, default port, fragment, tracking parameters and the slash or
    index page at the end are dropped, the host is in lower case and parameters are sorted.

    Text that is no absolute address is trimmed and otherwise kept; NULL stays NULL.
    """
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(url, ADDRESS, 1)), r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(url, ADDRESS, 2), r"/(index\.html?)?$", "")
    asked = F.split(F.regexp_extract(url, ADDRESS, 3), "&")
    kept = F.sort_array(F.filter(asked, lambda p: (p != "") & ~p.rlike(TRACKING)))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(url.rlike(ADDRESS), F.concat(host, path, query)).otherwise(F.trim(url))


def lower_headers(headers: Column) -> Column:
    """Header names in lower case; of repeated names the last one counts, NULL is no header."""
    entries = F.coalesce(F.map_entries(headers), F.array())
    named = F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    last = F.filter(
        named,
        lambda e, i: ~F.exists(F.slice(named, i + 2, F.size(named)), lambda later: later["key"] == e["key"]),
    )
    return F.map_from_entries(last)


def merged_headers(stored: Column, renewed: Column) -> Column:
    """``stored`` with the permitted headers of ``renewed`` in their place."""
    allowed = F.map_filter(renewed, lambda k, v: k.isin(*PERMITTED))
    others = F.map_filter(stored, lambda k, v: ~F.map_contains_key(allowed, k))
    return F.map_concat(others, allowed)


def _outcome(response: Column, stored: Column, renewed: Column) -> Column:
    """Entity tags are compared where both sides have one, weakly; else the modification dates."""
    def tag(headers: Column) -> Column:
        return F.regexp_replace(headers["etag"], "^W/", "")

    dates = (stored["last-modified"], renewed["last-modified"])
    return (
        F.when(response.isNull(), "no earlier response")
        .when(tag(stored).isNotNull() & tag(renewed).isNotNull(), F.when(tag(stored) == tag(renewed), "resolved").otherwise("changed"))
        .when(dates[0].isNotNull() & dates[1].isNotNull(), F.when(dates[0] == dates[1], "resolved").otherwise("changed"))
        .otherwise("no validator")
    )


def _found(record: Column, own: Column | None = None) -> Column:
    """The key of a record; where there is none, one of ``own`` that meets nothing, so that no task gets all of these."""
    key = F.concat(F.lit("r"), record.cast("string"))
    return key if own is None else F.coalesce(key, F.concat(F.lit("n"), own.cast("string")))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit: ``record_id, canonical_url, time, response_id, outcome, headers, payload``.

    ``records`` has ``record_id, url, time`` (a whole number), ``status, headers`` (a map) and
    ``payload``; other columns are ignored. ``outcome`` is ``resolved``, ``changed`` (validators
    differ), ``no validator`` or ``no earlier response``; only resolved rows get headers and a payload.
    Rows without a record id, URL or time are left out, as nothing can be said about them; so are other
    statuses than 200 and 304. Of responses of one URL and time the greatest id counts. Record ids must be
    unique; of repeated ids one row counts. Payloads of any length move once; an empty table gives an empty table.
    """
    usable = records.filter("record_id IS NOT NULL AND url IS NOT NULL AND time IS NOT NULL AND status IN (200, 304)")
    narrow = materialize(
        usable.select("record_id", canonical_url(F.col("url")).alias("key"), "time", "status", lower_headers(F.col("headers")).alias("headers"))
        .dropDuplicates(["record_id"]),
        "captures",
    )
    bounds = narrow.agg(F.min("time").alias("low"), F.max("time").alias("high")).first()
    low, width = bounds["low"] or 0, ((bounds["high"] or 0) - (bounds["low"] or 0)) // RANGES + 1
    full = F.when(F.col("status") == 200, F.struct("time", "record_id"))
    ranged = narrow.select("record_id", "key", "time", "status", F.floor((F.col("time") - low) / width).alias("range"))
    lasts = ranged.groupBy("key", "range").agg(F.max(full).alias("last"))
    earlier = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select("key", "range", F.max("last").over(earlier).alias("carried"))
    inside = Window.partitionBy("key", "range").orderBy("time").rangeBetween(Window.unboundedPreceding, -1)
    looked = ranged.withColumn("near", F.max(full).over(inside)).join(carried, ["key", "range"])
    pairs = looked.filter("status = 304").select(
        "record_id", F.coalesce("near", "carried")["record_id"].alias("response_id")
    )
    revisits = pairs.join(narrow, "record_id")
    stored = narrow.filter("status = 200").select(_found(F.col("record_id")).alias("_met"), F.col("headers").alias("stored"))
    met = revisits.withColumn("_met", _found(F.col("response_id"), F.col("record_id")))
    judged = met.join(stored, "_met", "left").drop("_met").withColumn(
        "outcome", _outcome(F.col("response_id"), F.col("stored"), F.col("headers"))
    )
    good = F.col("outcome") == "resolved"
    payloads = usable.filter("status = 200").select(_found(F.col("record_id")).alias("_from"), "payload").dropDuplicates(["_from"])
    wanted = judged.withColumn("_from", _found(F.when(good, F.col("response_id")), F.col("record_id")))
    return wanted.join(payloads, "_from", "left").select(
        "record_id", F.col("key").alias("canonical_url"), "time", "response_id", "outcome",
        F.when(good, merged_headers(F.col("stored"), F.col("headers"))).alias("headers"), "payload",
    )
