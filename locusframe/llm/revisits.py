"""Not-modified captures of an archive, resolved to the response they stand for.

A revisit takes the latest earlier full response of the same canonical URL. The as-of join cuts a
URL's captures into blocks of time: inside a block a window carries the last response on, and blocks pass
theirs to later ones by an equi-join of one small row per block, so a URL with most captures is no hot group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusframe.llm.common import stored

# Header fields that a not-modified answer may update (RFC 9110, 15.4.5, and validators).
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
# Query parameters that only track the way to a page.
TRACKING = r"^(utm_[^=]*|ref|gclid|fbclid)(=|$)"
FACTS = "response_id bigint, ts bigint, etag string, last_modified string, digest string, headers map<string,string>"


def canonical_url(url: Column) -> Column:
    """Host without ``www.`` and default port, path without a closing slash, sorted query without tracking; no scheme and no fragment.

    Null without ``://``.
    """
    plain = F.regexp_replace(url, "#.*$", "")
    host = F.lower(F.regexp_extract(plain, r"^[^:/?]*://([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(plain, r"^[^:/?]*://[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(plain, r"\?(.*)$", 1)
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.when(plain.rlike(r"^[^:/?]*://"), F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def lower_keys(headers: Column) -> Column:
    """Header names in lower case; the first in text order stays where two differ only by case."""
    entries = F.array_sort(F.map_entries(headers))
    names = F.transform(entries, lambda e: F.lower(e["key"]))
    first = F.filter(F.sequence(F.lit(1), F.size(entries)), lambda i: F.array_position(names, F.get(names, i - 1)) == i)
    return F.when(F.size(entries) > 0, F.map_from_entries(F.transform(first, lambda i: F.struct(F.get(names, i - 1).alias("key"), F.get(entries, i - 1)["value"].alias("value"))))).otherwise(
        F.expr("map_from_entries(cast(array() as array<struct<key:string,value:string>>))"))


def merged_headers(response: Column, revisit: Column) -> Column:
    """The response's headers, updated by the permitted ones of the revisit; names in lower case."""
    new = F.map_filter(lower_keys(revisit), lambda k, v: k.isin(*PERMITTED))
    old = F.map_filter(lower_keys(response), lambda k, v: ~F.map_contains_key(new, k))
    return F.map_concat(old, new)


def resolve_revisits(captures: DataFrame, block_seconds: int = 86_400) -> DataFrame:
    """One row per revisit: record_id, url_key, response_id, outcome, headers.

    ``captures``: record_id, kind (``response`` or ``revisit``), url, ts (seconds), status, etag, last_modified, digest, headers
    (map). Full responses are those of status 200. Earlier means a smaller ts; among equal ones the
    largest record_id is the latest. ``outcome`` is ``etag``, ``last-modified`` or ``digest``, the first
    validator that both sides have, when it agrees; ``changed`` when it does not; ``no-validator`` when they share none;
    ``no-response`` without an earlier response, a URL or a time. Only the first three give a response_id and merged headers.
    Validators are compared without the weak mark. Repeated records are all resolved; empty tables give no rows.
    URLs of any length are read whole. Other columns of the input, whatever their names, are neither read nor returned.
    """
    own = captures.select("record_id", "kind", canonical_url(F.col("url")).alias("url_key"), F.col("ts").cast("long").alias("ts"), "status",
                          "etag", "last_modified", "digest", "headers")
    own = own.where((F.col("kind") == "revisit") | ((F.col("kind") == "response") & (F.col("status") == 200)))
    full = F.when(F.col("kind") == "response", F.struct(
        F.col("record_id").cast("long").alias("response_id"), "ts", "etag", "last_modified", "digest", "headers").cast(f"struct<{FACTS.replace(' ', ':').replace(',:', ',')}>"))
    placed = stored(own.withColumns({"full": full, "block": F.floor(F.col("ts") / block_seconds)}))
    known = placed.where("url_key is not null and ts is not null")
    keys = ["url_key", "block"]
    # at equal times revisits come first, as a response must be earlier
    inside = Window.partitionBy(*keys).orderBy("ts", F.when(F.col("kind") == "revisit", 0).otherwise(1), "record_id").rowsBetween(Window.unboundedPreceding, -1)
    revisits = known.withColumn("near", F.last("full", ignorenulls=True).over(inside)).where("kind = 'revisit'")
    last = known.groupBy(*keys).agg(F.max_by("full", F.when(F.col("full").isNotNull(), F.struct("ts", "record_id"))).alias("last"))
    before = Window.partitionBy("url_key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(*keys, F.last("last", ignorenulls=True).over(before).alias("far"))
    found = revisits.join(carried, keys, "left").withColumn("r", F.coalesce("near", "far")).drop("near", "far")
    lost = placed.where("kind = 'revisit' and (url_key is null or ts is null)").withColumn("r", F.lit(None).cast(f"struct<{FACTS.replace(' ', ':').replace(',:', ',')}>"))
    plain = lambda c: F.regexp_replace(c, "^W/", "")
    pairs = [("etag", plain(F.col("etag")), plain(F.col("r.etag"))), ("last-modified", F.col("last_modified"), F.col("r.last_modified")), ("digest", F.col("digest"), F.col("r.digest"))]
    outcome = F.when(F.col("r").isNull(), "no-response")
    for name, mine, theirs in pairs:
        both = mine.isNotNull() & theirs.isNotNull()
        outcome = outcome.when(both & (mine == theirs), name).when(both, "changed")
    good = F.col("outcome").isin("etag", "last-modified", "digest")
    return found.select(*lost.columns).unionByName(lost).withColumn("outcome", outcome.otherwise("no-validator")).select(
        "record_id", "url_key", F.when(good, F.col("r.response_id")).alias("response_id"), "outcome",
        F.when(good, merged_headers(F.col("r.headers"), F.col("headers"))).alias("headers"))


def captures_of(pages: DataFrame) -> DataFrame:
    """Captures of crawled pages: the response of each, later visits answered "not modified", partial and early ones.

    Visits come by other spellings of the URL; some carry another etag, none at all, or only a digest.
    """
    md5 = F.md5(F.coalesce("html", F.lit("")).cast("binary"))
    base = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), md5.alias("md5"), (F.lit(1_700_000_000) + F.col("page_id") * 7).cast("long").alias("ts"))
    pid = F.col("page_id")
    etag = F.concat(F.lit('"'), F.substring("md5", 1, 16), F.lit('"'))
    none = F.lit(None).cast("string")
    same_place = F.regexp_replace(F.regexp_replace("url", "#.*$", ""), "^http:", "https:")
    tracked = F.concat(same_place, F.when(F.instr(same_place, "?") > 0, "&").otherwise("?"), F.lit("utm_medium=x#top"))

    def capture(n, kind, url, ts, status, tag, modified, digest, headers):
        fields = {"record_id": pid * 8 + n, "kind": F.lit(kind), "url": url, "ts": ts, "status": F.lit(status), "etag": tag, "last_modified": modified, "digest": digest,
                  "headers": F.create_map(*[x for k, v in headers.items() for x in (F.lit(k), v)])}
        return F.struct(*[v.alias(k) for k, v in fields.items()])

    ts, modified = F.col("ts"), (F.col("ts") - pid % 1000).cast("string")
    at = lambda shift: (ts + shift).cast("string")
    rows = F.array(
        capture(0, "response", F.col("url"), ts, 200, etag, modified, F.col("md5"), {
            "Content-Type": F.lit("text/html"), "ETag": etag, "Cache-Control": F.lit("max-age=60"), "Date": at(0), "Set-Cookie": F.lit("a=1")}),
        capture(1, "revisit", tracked, ts + 3600 * (1 + pid % 50), 304, etag, none, none, {
            "Date": at(3600), "cache-control": F.lit("max-age=120"), "Set-Cookie": F.lit("b=2"), "Content-Length": F.lit("0"), "ETag": etag}),
        capture(2, "revisit", F.col("url"), ts + 90_000 + pid % 7, 304, F.when(pid % 7 == 0, F.lit('"other"')), F.when(pid % 3 == 0, modified), F.when(pid % 2 == 0, F.col("md5")), {
            "Date": at(90_000), "Expires": at(99_000), "X-Cache": F.lit("hit")}),
        F.when(pid % 5 == 0, capture(3, "response", F.col("url"), ts + 1800, 206, F.lit('"part"'), none, none, {"Date": at(1800)})),
        F.when(pid % 11 == 0, capture(4, "revisit", same_place, ts - 1_000_000, 304, etag, none, none, {"Date": at(-1_000_000)})))
    return base.select(F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("c")).select("c.*")
