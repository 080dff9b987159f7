"""Not-modified revisits of a web archive, resolved to the responses they stand for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from conform.llm.staging import check_columns, staged, text_or_empty

# Header fields that a 304 response may renew (RFC 9110), and query fields that only track visitors.
_RENEWED = "cache-control content-location date etag expires last-modified vary".split()
_TRACKING = "utm_[a-z]+|ref|fbclid|gclid|msclkid"


def canonical_url(url: str | Column) -> Column:
    """Host in lower case without default port, path without closing slashes, query fields sorted and without tracking.

    Scheme and fragment do not count. A null url is empty.
    """
    bare = F.regexp_replace(F.regexp_replace(text_or_empty(url), r"(?s)#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^[^/?]*", 0)), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    fields = F.split(F.regexp_extract(bare, r"(?s)^[^?]*\?(.*)$", 1), "&")
    kept = F.filter(fields, lambda field: (field != "") & ~field.rlike(rf"^({_TRACKING})(=|$)"))
    query = F.array_join(F.array_sort(kept), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


#: Microseconds of the spans in which the as-of join looks one after the other: a second, an hour, all time.
_SPANS = (1_000_000, 3_600_000_000)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit: record_id, url_key, response_id, state and headers.

    ``records`` has record_id, kind (``response``, a full one, or ``revisit``; others are ignored), url, date
    (timestamp) and headers (a map with field names in lower case). A revisit stands for the latest response of the same
    canonical url strictly before it; of several at that time, the one of largest id. ``state`` is ``resolved``;
    ``mismatch`` if both have an etag, or without one on either side a last-modified, and these differ (weak and strong
    etags count as equal); or ``missing`` if there is no earlier response. Resolved headers are the response's, with
    the fields that a 304 may renew taken from the revisit; others keep the revisit's own.

    Records without a date are never earlier than anything: a revisit without one is missing, a response without one unused. Null headers are
    empty, null urls one address of their own, and repeated rows are resolved each for itself.

    One address may hold any part of all records: those of one time are combined before they are shuffled, and the
    as-of join goes by address and second, then over one row for each second of an hour, then over one for each hour. So
    no task orders more than the microseconds of a second, the seconds of an hour or the hours of the archive.
    """
    check_columns(records, "record_id", "kind", "url", "date", "headers")
    empty = F.create_map().cast("map<string,string>")
    events = records.where("kind in ('response', 'revisit')").select(
        "record_id",
        F.struct(F.col("url").isNull().alias("none"), canonical_url("url").alias("key")).alias("address"),
        "date",
        (F.col("kind") == "response").alias("full"),
        F.coalesce("headers", empty).alias("headers"),
    )
    dated = staged(events.where("date is not null").withColumn("at", F.unix_micros("date")).drop("date"), "captures")
    response = F.struct(F.col("record_id").alias("id"), "headers")
    # A null id is the smallest, but not left out.
    largest = F.struct(F.col("record_id").isNotNull(), "record_id")
    latest = F.max_by(response, largest).alias("latest")
    times = dated.where("full").groupBy("address", "at").agg(latest)
    asked = dated.where("not full").groupBy("address", "at").agg(F.lit(True).alias("asked"))
    times = staged(asked.join(times, ["address", "at"], "full"), "times")
    bases = _carried(times, _SPANS).select("address", "at", F.col("before").alias("base"))
    revisits = dated.where("not full").select("record_id", "address", "at", "headers")
    found = revisits.join(bases, ["address", "at"], "left").drop("at")
    undated = events.where("date is null and not full").select("record_id", "address", "headers")
    found = found.unionByName(undated, allowMissingColumns=True)
    theirs = F.col("base.headers")
    etags = [F.regexp_replace(F.try_element_at(side, F.lit("etag")), "^W/", "") for side in (F.col("headers"), theirs)]
    dates = [F.try_element_at(side, F.lit("last-modified")) for side in (F.col("headers"), theirs)]
    agree = F.coalesce(etags[0] == etags[1], dates[0] == dates[1], F.lit(True))
    state = F.when(F.col("base").isNull(), "missing").when(agree, "resolved").otherwise("mismatch")
    renewed = F.map_filter("headers", lambda name, _: name.isin(_RENEWED))
    unchanged = F.map_filter(theirs, lambda name, _: ~F.array_contains(F.map_keys(renewed), name))
    merged = F.when(F.col("state") == "resolved", F.map_concat(unchanged, renewed)).otherwise(F.col("headers"))
    return found.withColumn("state", state).select(
        "record_id", F.col("address.key").alias("url_key"), F.col("base.id").alias("response_id"), "state", merged.alias("headers")
    )


def _carried(times: DataFrame, spans: tuple[int, ...]) -> DataFrame:
    """The rows of ``times`` (address, at, asked, latest; one for each address and time) that are asked, with ``before``:
    the last ``latest`` of their address at an earlier time. They look within their span first; the rest is asked of spans, each
    with the last that it has, in the same way."""
    keys, order = ["address"], "at"
    if spans:
        times, keys = times.withColumn("span", F.expr(f"(at - pmod(at, {spans[0]})) div {spans[0]}")), ["address", "span"]
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    seen = times.withColumn("before", F.last("latest", ignorenulls=True).over(earlier)).where("asked").drop("latest")
    if not spans:
        return seen
    seen = staged(seen, "asked")
    lasting = times.where("latest is not null").groupBy(*keys).agg(F.max_by("latest", "at").alias("latest"))
    asked = seen.where("before is null").groupBy(*keys).agg(F.lit(True).alias("asked"))
    coarser = asked.join(lasting, keys, "full").withColumnRenamed("span", "at")
    # The spans above are counted in spans of this level.
    carried = _carried(staged(coarser, "spans"), tuple(width // spans[0] for width in spans[1:]))
    carried = carried.select("address", F.col("at").alias("span"), F.col("before").alias("__far"))
    met = seen.join(carried, keys, "left")
    return met.select("address", "at", F.coalesce("before", "__far").alias("before"))


def captures(pages: DataFrame) -> DataFrame:
    """Archive records of a crawl of ``pages``: each page fetched in full once, and asked for again at another time.

    Validators of the second visit are those of the page, except where the page had changed in between.
    """
    etag = F.concat(F.lit('"'), F.md5(F.coalesce(F.col("html"), F.lit("")).cast("binary")), F.lit('"'))
    first = F.lit(1_700_000_000) + F.pmod(F.col("page_id") * 7_919, F.lit(31_536_000))
    again = F.lit(1_700_000_000) + F.pmod(F.col("page_id") * 104_729 + 15_768_000, F.lit(31_536_000))

    def header(**fields: Column) -> Column:
        parts = [part for name, value in fields.items() for part in (F.lit(name.replace("_", "-")), value.cast("string"))]
        return F.create_map(*parts)

    full = pages.select(
        (F.col("page_id") * 2).alias("record_id"),
        F.lit("response").alias("kind"),
        "url",
        F.timestamp_seconds(first).alias("date"),
        header(
            content_length=F.octet_length(text_or_empty("html")), content_type=F.lit("text/html"), date=first, etag=etag
        ).alias("headers"),
    )
    changed = F.when(F.col("page_id") % 5 == 0, F.lit('"changed"')).otherwise(etag)
    revisit = pages.select(
        (F.col("page_id") * 2 + 1).alias("record_id"),
        F.lit("revisit").alias("kind"),
        "url",
        F.timestamp_seconds(again).alias("date"),
        header(cache_control=F.lit("max-age=60"), content_length=F.lit(0), date=again, etag=changed).alias("headers"),
    )
    return full.unionByName(revisit)
