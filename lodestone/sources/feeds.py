"""Feeds and filings in XML or HTML text: one document in a column, parsed by Spark's own functions into rows and gap codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ATOM = "entry array<struct<id: string, title: string, updated: string>>"
RSS = "channel struct<title: string, item: array<struct<title: string, link: string, pubDate: string>>>"
HALTS = "item array<struct<symbol: string, haltDate: string, haltTime: string, resumeTime: string, reason: string>>"
OWNERSHIP = "reportingOwner array<struct<cik: string>>, transaction array<struct<code: string, shares: double>>"


def element(name: str, *inside: Column) -> Column:
    """An XML element of text or elements; the characters that markup needs are escaped by escaped()."""
    return F.concat(F.lit(f"<{name}>"), *inside, F.lit(f"</{name}>"))


def escaped(text: Column) -> Column:
    for raw, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(name))
    return text


def atom(feeds: DataFrame, key: str, body: str, cap: int) -> tuple[DataFrame, DataFrame]:
    """Feeds -> entries (key, id, title, updated; the newest of each id) and gaps (key, code).

    capped: as many entries as a feed can hold, so older ones may be lost; duplicate: an id twice; undated: an entry
    without a date, which is kept; unreadable: no entry can be read.
    """
    parsed = feeds.select(key, F.from_xml(body, ATOM)["entry"].alias("entries"))
    rows = parsed.select(key, F.explode("entries").alias("e")).select(key, "e.id", "e.title", F.try_to_date("e.updated").alias("updated"))
    entries = rows.groupBy(key, "id").agg(F.max(F.struct(F.coalesce("updated", F.lit("0001-01-01").cast("date")), "title", "updated")).alias("m")).select(key, "id", "m.title", "m.updated")
    n = F.coalesce(F.size("entries"), F.lit(0))
    codes = F.array_compact(
        F.array(
            F.when(n < 1, "unreadable"),
            F.when(n >= cap, "capped"),
            F.when(F.size(F.array_distinct(F.transform("entries", lambda e: e["id"]))) < n, "duplicate"),
            F.when(F.exists("entries", lambda e: F.try_to_date(e["updated"]).isNull()), "undated"),
        )
    )
    return entries, parsed.select(key, F.explode(codes).alias("code"))


def mail_time(text: Column) -> Column:
    """A date of mail headers in GMT, with or without a weekday; null where it is none."""
    return F.try_to_timestamp(F.regexp_replace(F.regexp_replace(F.trim(text), "^[A-Za-z]{3}, ", ""), " (GMT|UTC|\\+0000)$", ""), F.lit("d MMM yyyy HH:mm:ss")).cast("timestamp_ntz")


def rss(feeds: DataFrame, key: str, body: str) -> DataFrame:
    """Feeds -> items (key, title, link, published); items without a title or link are no records."""
    items = feeds.select(key, F.explode(F.from_xml(body, RSS)["channel"]["item"]).alias("i"))
    out = items.select(key, F.trim("i.title").alias("title"), F.trim("i.link").alias("link"), mail_time(F.col("i.pubDate")).alias("published"))
    return out.filter("title <> '' and link <> ''")


def halts(feeds: DataFrame, body: str) -> DataFrame:
    """Trading halts: symbol, halted_at, resumed_at and state; an unreadable halt time is no record."""
    items = feeds.select(F.explode(F.from_xml(body, HALTS)["item"]).alias("i")).select("i.*")
    at = lambda time: F.try_to_timestamp(F.concat_ws(" ", "haltDate", time), F.lit("MM/dd/yyyy HH:mm:ss")).cast("timestamp_ntz")
    out = items.select(F.trim("symbol").alias("symbol"), at("haltTime").alias("halted_at"), at("resumeTime").alias("resumed_at"), "reason")
    return out.filter("halted_at is not null").withColumn("state", F.when(F.col("resumed_at").isNull(), "halted").otherwise("resumed"))


def ownership(filings: DataFrame, key: str, body: str) -> DataFrame:
    """Insider forms -> key, codes (distinct, sorted, joined), owners (distinct), shares by the sum of all transactions."""
    d = filings.select(key, F.from_xml(body, OWNERSHIP).alias("d"))
    codes = F.array_join(F.array_sort(F.array_distinct(F.transform("d.transaction", lambda t: F.upper(F.trim(t["code"]))))), "+")
    owners = F.size(F.array_distinct(F.transform("d.reportingOwner", lambda o: F.lpad(F.trim(o["cik"]), 10, "0"))))
    shares = F.aggregate(F.col("d.transaction"), F.lit(0.0), lambda s, t: s + t["shares"])
    return d.select(key, codes.alias("codes"), owners.alias("owners"), shares.alias("shares"))


def page_text(html: Column) -> tuple[Column, Column]:
    """The text of a page without scripts, styles and markup, and its gaps (empty, unclosed), joined."""
    bare = F.regexp_replace(html, "(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    bare = F.regexp_replace(bare, "(?s)<[^>]*>", " ")
    for raw, name in ((" ", "&nbsp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("&", "&amp;")):
        bare = F.replace(bare, F.lit(name), F.lit(raw))
    text = F.trim(F.regexp_replace(F.coalesce(bare, F.lit("")), "[ \\t\\r\\n]+", " "))
    closed = F.coalesce(F.lower(html).contains("</html>"), F.lit(False))
    return text, F.concat_ws("+", F.when(text == "", "empty"), F.when(~closed, "unclosed"))


def newest_per_form(filings: DataFrame, keys: list[str], accession: str, filed: str, floor: str, limit: int) -> DataFrame:
    """The newest `limit` filings of each key from `floor` on; a repeated accession counts once."""
    kept = filings.filter(F.col(filed) >= F.lit(floor).cast("date")).dropDuplicates([accession])
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(filed).desc(), accession))
    return kept.withColumn("_n", n).filter(F.col("_n") <= limit).drop("_n")
