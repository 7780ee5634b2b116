"""Column functions: times, names, urls, ladders and identities.  Missing stays missing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Query parameters that only track, and funds by symbol.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "ref", "fbclid", "gclid")


def oldest(*columns: Column) -> Column:
    """The least, or NULL if any is NULL."""
    unknown = F.lit(False)
    for c in columns:
        unknown = unknown | c.isNull()
    return F.when(~unknown, F.least(*columns))


def newest(*columns: Column) -> Column:
    """The greatest of those known."""
    return F.greatest(*columns)


def to_utc(text: Column) -> Column:
    """ISO or RFC-2822 text -> UTC second; without an offset only the day counts; epoch seconds only between 1e8 and 1e11."""
    # RFC-2822 names the day of the week first, which says nothing more, and the zone by a word or an offset.
    mail = F.regexp_replace(F.regexp_replace(text, "^[A-Za-z]{3}, *", ""), " (GMT|UTC?|Z)$", " +0000")
    zoned = mail.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    formats = ("yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "yyyy-MM-dd HH:mm:ssXXX", "d MMM yyyy HH:mm:ss xx", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")
    parsed = F.coalesce(*[F.try_to_timestamp(mail, F.lit(f)) for f in formats])
    number = F.when(text.rlike(r"^\d+(\.\d+)?$"), F.try_to_number(text, F.lit("999999999999999")).cast("double"))
    epoch = F.when((number > 1e8) & (number < 1e11), F.timestamp_seconds(number))
    return F.coalesce(epoch, F.when(zoned, F.date_trunc("second", parsed)), F.date_trunc("day", parsed))


def interval_order(a_low: Column, a_high: Column, b_low: Column, b_high: Column) -> Column:
    """before, not_before or undetermined, for instants known only as intervals."""
    return F.when(a_high < b_low, "before").when(a_low >= b_high, "not_before").otherwise("undetermined")


def finite_positive(x: Column) -> Column:
    return F.when(~F.isnan(x) & (x > 0) & (x < float("inf")), x)


def asset_class(symbol: Column, funds: tuple[str, ...]) -> Column:
    return F.when(symbol.startswith("^"), "index").when(symbol.endswith("=F"), "future").when(symbol.isin(*funds), "etf").otherwise("equity")


def bucket(x: Column, cuts: tuple[float, ...], names: tuple[str, ...]) -> Column:
    """The name of the first cut above |x|, the last one beyond all."""
    out = F.lit(names[-1])
    for cut, name in reversed(list(zip(cuts, names[:-1], strict=True))):
        out = F.when(F.abs(x) < cut, name).otherwise(out)
    return F.when(x.isNotNull(), out)


def runway(cash: Column, burn: Column) -> tuple[Column, Column]:
    """Quarters of cash at this burn, and RED below 4, YELLOW to 6, GREEN above; no burn is no runway."""
    quarters = F.when((cash > 0) & (burn > 0), cash / burn)
    return quarters, F.when(quarters < 4, "RED").when(quarters <= 6, "YELLOW").when(quarters > 6, "GREEN").when(burn <= 0, "not_burning").otherwise("unknown")


def trade_cost(notional: Column, side: Column, buy_bps: float, sell_bps: float, fixed: float) -> Column:
    return F.when(notional > 0, notional * F.when(side == "buy", buy_bps).otherwise(sell_bps) / 10_000 + fixed).otherwise(0.0)


def record_id(section: str, *keys: Column) -> Column:
    """First 16 hex digits of the SHA-256 of section and keys joined by pipes; NULL reads None."""
    parts = [F.coalesce(k.cast("string"), F.lit("None")) for k in keys]
    return F.substring(F.sha2(F.concat_ws("|", F.lit(section), *parts), 256), 1, 16)


def domain(url: Column, publishers: tuple[str, ...] = ()) -> Column:
    """The host in lower case, without www., m. or amp. and port; a publisher's own domain for any host below it."""
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(url, r"^[a-zA-Z]+://(?:[^/?#@]*@)?([^/?#]*)", 1)), r":\d+$", ""), r"^(www|m|amp)\.", "")
    return F.coalesce(*[F.when((host == p) | host.endswith(f".{p}"), F.lit(p)) for p in publishers], host)


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, single slashes, none at the end, no fragment, no tracking parameters, the others by name and value.

    What has no scheme and host stays as it is, trimmed; a blank is NULL.  Of character references &amp; is resolved.
    """
    raw = F.trim(F.replace(url, F.lit("&amp;"), F.lit("&")))
    scheme, host = F.lower(F.regexp_extract(raw, r"^([a-zA-Z][a-zA-Z0-9+.-]*)://", 1)), F.lower(F.regexp_extract(raw, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))
    path = F.regexp_replace(F.regexp_extract(raw, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1), "/+", "/")
    path = F.when(path == "/", path).otherwise(F.regexp_replace(path, "/$", ""))
    key = lambda p: F.lower(F.substring_index(p, "=", 1))
    pairs = F.filter(F.split(F.regexp_extract(raw, r"\?([^#]*)", 1), "&"), lambda p: (p != "") & ~key(p).startswith("utm_") & ~key(p).isin(*TRACKING))
    sided = F.transform(pairs, lambda p: F.when(F.contains(p, F.lit("=")), p).otherwise(F.concat(p, F.lit("="))))
    ordered = F.array_sort(F.transform(sided, lambda p: F.struct(key(p).alias("k"), F.regexp_replace(p, "^[^=]*=", "").alias("v"), p.alias("p"))))
    asked = F.array_join(F.transform(ordered, lambda x: x["p"]), "&")
    whole = F.concat(scheme, F.lit("://"), host, path, F.when(asked != "", F.concat(F.lit("?"), asked)).otherwise(""))
    return F.when(raw != "", F.when((scheme != "") & (host != ""), whole).otherwise(raw))


def title_key(title: Column) -> Column:
    """Lower case, letters and digits only, one space between words, without a leading breaking, update or exclusive."""
    words = F.trim(F.regexp_replace(F.lower(title), r"[^\p{L}\p{N}]+", " "))
    return F.regexp_replace(words, r"^(?:(?:breaking|update|exclusive) )+", "")


def precision_interval(text: Column) -> tuple[Column, Column]:
    """A date of day, month, quarter or year precision -> its half-open interval; NULL for anything else."""
    year = F.substring(text, 1, 4).try_cast("int")
    day = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, "yyyy-MM-dd"))
    month = F.when(text.rlike(r"^\d{4}-\d{2}$"), F.try_to_date(F.concat(text, F.lit("-01")), "yyyy-MM-dd"))
    quarter = F.when(text.rlike(r"^\d{4}-Q[1-4]$"), F.make_date(year, F.substring(text, 7, 1).try_cast("int") * 3 - 2, F.lit(1)))
    whole = F.when(text.rlike(r"^\d{4}$"), F.make_date(year, F.lit(1), F.lit(1)))
    return F.coalesce(day, month, quarter, whole), F.coalesce(F.date_add(day, 1), F.add_months(month, 1), F.add_months(quarter, 3), F.add_months(whole, 12))


def name_key(name: Column, common: tuple[str, ...]) -> Column:
    """The first two words of a name that aren't common ones; NULL without any."""
    words = F.filter(F.split(F.regexp_replace(F.lower(name), "[^a-z0-9]+", " "), " "), lambda x: (x != "") & ~x.isin(*common))
    return F.when(F.size(words) > 0, F.array_join(F.slice(words, 1, 2), " "))


def canonical_json(**fields: Column) -> Column:
    """A JSON object with its keys in alphabetical order and NULLs kept."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def finite_columns(rows, names: list[str]):
    """rows with NaN and infinities of these columns as NULL, and `nulled`: which ones were, joined by +."""
    odd = {n: F.isnan(n) | (F.abs(F.col(n)) == float("inf")) for n in names}
    nulled = F.concat_ws("+", *[F.when(odd[n], n) for n in names])
    return rows.select(*[c for c in rows.columns if c not in names], *[F.when(~odd[n], F.col(n)).alias(n) for n in names], nulled.alias("nulled"))
