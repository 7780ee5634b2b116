"""Hypothetical portfolio accounts: sequential within an account, parallel over accounts and scenarios."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame

RESULT = "account string, session date, nav double, wealth double, drawdown double, cost double, turnover double"
EPSILON, STEPS = 1e-12, 64


def rebalanced(cash: float, held: dict[str, float], prices: dict[str, float], weights: dict[str, float], bps: float, fixed: float, least: float) -> tuple[float, dict[str, float], float, float]:
    """Sells first, then buys scaled down until cash suffices (bisection); trades below `least` are left out."""
    nav = cash + sum(q * prices[s] for s, q in held.items())
    held, cost, traded = dict(held), 0.0, 0.0
    wanted = {s: nav * w for s, w in weights.items() if s in prices}
    for s in sorted(held):
        excess = held[s] * prices[s] - wanted.get(s, 0.0)
        if excess > least:
            fee = excess * bps / 1e4 + fixed
            held[s] -= excess / prices[s]
            cash, cost, traded = cash + excess - fee, cost + fee, traded + excess
    buys = {s: v - held.get(s, 0.0) * prices[s] for s, v in sorted(wanted.items()) if v - held.get(s, 0.0) * prices[s] > least}
    spend = lambda k: sum(v * k * (1 + bps / 1e4) + fixed for v in buys.values())
    low, high = 0.0, 1.0
    if buys and spend(1.0) > cash:
        for _ in range(STEPS):
            mid = (low + high) / 2
            low, high = (mid, high) if spend(mid) <= cash else (low, mid)
        scale = low
    else:
        scale = 1.0
    for s, v in buys.items():
        v *= scale
        if v > max(least, EPSILON):
            fee = v * bps / 1e4 + fixed
            held[s] = held.get(s, 0.0) + v / prices[s]
            cash, cost, traded = cash - v - fee, cost + fee, traded + v
    return cash, {s: q for s, q in held.items() if q > EPSILON}, cost, traded


def simulate(days: DataFrame) -> DataFrame:
    """account, session, symbol, open, close, weight (NULL: no decision), bps, fixed, contribution -> RESULT, one row a session.

    A decision trades at the session's open; a contribution comes before it and is no return: wealth chains the growth
    between flows.  Drawdown is from the running peak over open, post-trade and close points.
    """

    def account(pdf: pd.DataFrame) -> pd.DataFrame:
        out, cash, held, wealth, peak, before = [], 0.0, {}, 1.0, 1.0, None
        last: dict[str, float] = {}  # a held symbol without a bar keeps its last price
        bps, fixed = float(pdf["bps"].iloc[0]), float(pdf["fixed"].iloc[0])
        for session, day in pdf.sort_values(["session", "symbol"]).groupby("session", sort=True):
            opens, closes = last | dict(zip(day["symbol"], day["open"], strict=True)), last | dict(zip(day["symbol"], day["close"], strict=True))
            last = closes
            at_open = cash + sum(q * opens[s] for s, q in held.items())
            worst = 0.0
            if before:
                wealth *= at_open / before
            peak = max(peak, wealth)
            worst = min(worst, wealth / peak - 1)
            cash += float(day["contribution"].iloc[0])
            base = at_open + float(day["contribution"].iloc[0])
            cost = traded = 0.0
            if day["weight"].notna().any() and base > 0:
                weights = {s: w for s, w in zip(day["symbol"], day["weight"], strict=True) if w == w and w is not None}
                cash, held, cost, traded = rebalanced(cash, held, opens, weights, bps, fixed, 1.0)
            after = cash + sum(q * opens[s] for s, q in held.items())
            nav = cash + sum(q * closes[s] for s, q in held.items())
            for value, start in ((after, base), (nav, after)):
                if start > EPSILON:
                    wealth *= value / start
                peak = max(peak, wealth)
                worst = min(worst, wealth / peak - 1)
            before = nav if nav > EPSILON else None
            out.append((pdf["account"].iloc[0], session, nav, wealth, worst, cost, traded / base if base > 0 else 0.0))
        return pd.DataFrame(out, columns=["account", "session", "nav", "wealth", "drawdown", "cost", "turnover"])

    return days.groupBy("account").applyInPandas(account, RESULT)


def annualised(total: float, days: int) -> float | None:
    """Only for a year or more."""
    years = days / 365.25
    return math.pow(total, 1 / years) - 1 if years >= 1 and total > 0 else None
