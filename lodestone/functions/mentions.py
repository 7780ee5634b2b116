"""Dates near keywords, subjects named in a text, and projections of JSON.  Missing text names nothing."""

from __future__ import annotations

import bisect
import contextlib
import datetime as dt
import json
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a dated regulatory event is called, and its type; and the months' names.
CATALYSTS = {
    "PDUFA": "PDUFA_DATE", "action date": "PDUFA_DATE", "advisory committee": "ADCOM", "AdCom": "ADCOM", "complete response letter": "CRL", "CRL": "CRL",
    "NDA acceptance": "ACCEPTANCE", "BLA acceptance": "ACCEPTANCE", "filing acceptance": "ACCEPTANCE", "priority review": "PRIORITY_REVIEW",
    "breakthrough therapy": "DESIGNATION", "fast track designation": "DESIGNATION",
}
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]

FOUND = "array<struct<start:int,kind:string,day:date>>"


@dataclass(frozen=True)
class Token:
    """A run of letters and digits, or a single other character that is no white space."""

    text: str
    start: int
    stop: int


def tokens(body: str) -> list[Token]:
    """All tokens of a text, in lower case (one character stays one), in order."""
    out, start = [], None
    for at, c in enumerate(body):
        if c.isalnum() or c == "_":
            start = at if start is None else start
            continue
        if start is not None:
            out.append(Token(body[start:at].lower(), start, at))
            start = None
        if not c.isspace():
            out.append(Token(c, at, at + 1))
    return out if start is None else [*out, Token(body[start:].lower(), start, len(body))]


def _number(token: Token | None, digits: tuple[int, ...], endings: tuple[str, ...] = ("",)) -> int | None:
    """The number that a token is, if it has so many digits and then one of the endings."""
    for ending in endings:
        body = token.text.removesuffix(ending) if token else ""
        if len(body) in digits and body.isdecimal() and token.text == body + ending:
            return int(body)
    return None


def _day_at(run: list[Token]) -> tuple[int, int, int, int, Token] | None:
    """What the tokens begin with, if it is a day: (form, year, month, day, last token)."""
    first, *rest = run
    after = [*rest, *[None] * 5]
    apart = lambda a, b: a is not None and b is not None and b.start > a.stop
    if first.text in MONTHS and apart(first, after[0]):
        day = _number(after[0], (1, 2), ("", "st", "nd", "rd", "th"))
        k = 2 if after[1] and after[1].text == "," and after[1].start == after[0].stop else 1
        year = _number(after[k], (4,))
        if day is not None and year is not None and apart(after[k - 1], after[k]):
            return 0, year, MONTHS.index(first.text) + 1, day, after[k]
    if after[0] is None:
        return None
    day = _number(first, (1, 2))
    if day is not None and after[0].text in MONTHS and apart(first, after[0]) and apart(after[0], after[1]) and (year := _number(after[1], (4,))) is not None:
        return 1, year, MONTHS.index(after[0].text) + 1, day, after[1]
    joined = [first, *after[:4]]
    if None not in joined and all(a.stop == b.start for a, b in zip(joined, joined[1:], strict=False)) and joined[1].text == joined[3].text == "-":
        year, month, day = _number(first, (4,)), _number(joined[2], (2,)), _number(joined[4], (2,))
        if None not in (year, month, day):
            return 2, year, month, day, joined[4]
    return None


def _days(run: list[Token]) -> list[tuple]:
    """(start, form, stop, day) of every real calendar day written in the text, by start."""
    found = []
    for k in range(len(run)):
        at = _day_at(run[k : k + 6]) if run[k].text in MONTHS or run[k].text[0].isdecimal() else None
        if at:
            with contextlib.suppress(ValueError):  # no day of the calendar
                found.append((run[k].start, at[0], at[4].stop, dt.date(*at[1:4])))
    return found


def _named(run: list[Token], phrases: dict[str, list[tuple[list[str], str]]]) -> list[tuple[int, int, str]]:
    """(start, stop, kind) of every phrase: its words follow each other, apart by white space alone."""
    found = []
    for k, first in enumerate(run):
        for words, kind in phrases.get(first.text, ()):
            part = run[k : k + len(words)]
            if [x.text for x in part] == words and all(b.start > a.stop for a, b in zip(part, part[1:], strict=False)):
                found.append((first.start, part[-1].stop, kind))
    return found


def dated_keywords(text: Column, kinds: dict[str, str], reach: int = 200) -> Column:
    """Every whole-word hit of a keyword with the nearest day written within reach characters around it, NULL without one.

    Days are written "March 5, 2024", "5 March 2024" or "2024-03-05"; of equally near ones that in the earlier form counts.
    The cost is linear in the text; a NULL or empty text has no hit.
    """
    phrases: dict[str, list[tuple[list[str], str]]] = {}
    for phrase, kind in kinds.items():
        words = phrase.lower().split()
        phrases.setdefault(words[0], []).append((words, kind))

    def around(body: str) -> list[dict]:
        run = tokens(body)
        hits = _named(run, phrases)
        days = _days(run) if hits else []
        out = []
        for start, end, kind in sorted(hits):
            near = days[bisect.bisect_left(days, (start - reach,)) : bisect.bisect_left(days, (end + reach,))]
            best = min(((abs(at - start), form, at, day) for at, form, stop, day in near if stop <= end + reach), default=None)
            out.append({"start": start, "kind": kind, "day": best and best[3]})
        return out

    @F.pandas_udf(FOUND)
    def f(bodies: pd.Series) -> pd.Series:
        return bodies.map(lambda body: around(body) if body else [])

    return f(text)


def named_subjects(text: Column, aliases: dict[str, list[str]]) -> tuple[Column, Column]:
    """Symbols a text names, sorted, and its relevance: 1.0 by cashtag, 0.8 by a bare symbol, 0.6 by a lower-case alias, else 0.0.

    The universe of symbols is the caller's and goes into the plan as literals.  Symbols are upper-case letters and digits.
    """
    body = F.coalesce(text, F.lit(""))
    universe = F.array(*map(F.lit, sorted(aliases)))
    tagged = F.array_intersect(universe, F.transform(F.regexp_extract_all(body, F.lit(r"\$([A-Za-z]{1,5})\b"), F.lit(1)), F.upper))
    bare = F.array_intersect(universe, F.split(body, "[^A-Za-z0-9]+"))
    spoken = F.array_compact(F.array(*[F.when(F.contains(F.lower(body), F.lit(a)), s) for s, names in aliases.items() for a in names], F.lit(None).cast("string")))
    relevance = F.when(F.size(tagged) > 0, 1.0).when(F.size(bare) > 0, 0.8).when(F.size(spoken) > 0, 0.6).otherwise(0.0)
    return F.array_sort(F.array_union(F.array_union(tagged, bare), spoken)), relevance


def without_keys(document: Column, dropped: set[str]) -> Column:
    """Canonical JSON (sorted keys, no blanks) without the dropped keys at any depth; NULL for what is no JSON."""

    def bare(value):
        if isinstance(value, dict):
            return {k: bare(v) for k, v in value.items() if k not in dropped}
        return [bare(v) for v in value] if isinstance(value, list) else value

    def one(body):
        try:
            return json.dumps(bare(json.loads(body)), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
        except (TypeError, ValueError, RecursionError):
            return None

    @F.pandas_udf("string")
    def f(bodies: pd.Series) -> pd.Series:
        return bodies.map(one)

    return f(document)
