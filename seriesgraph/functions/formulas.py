"""Formulas as columns: decay, strengths, distances, costs, normalisers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Weekly decay rates by kind of edge.
DECAY_RATES = {"teammate": 0.020, "ex_teammate": 0.010, "rival": 0.015, "friend": 0.012, "mentor": 0.005, "manager_of": 0.008}
#: Multiples of the input price.
CACHE_WRITE_5M, CACHE_WRITE_1H, CACHE_READ = 1.25, 2.00, 0.10
WEEK_MICROS = 7 * 86_400 * 1_000_000
UNIT_SLACK = 1e-6


def micros(ts: Column) -> Column:
    """Timestamps with or without zone; those without are read as UTC."""
    return F.unix_micros(ts.cast("timestamp"))


def weeks_between(a: Column, b: Column) -> Column:
    """Fractional weeks from a to b, never negative."""
    return F.greatest(F.lit(0.0), (micros(b) - micros(a)) / F.lit(float(WEEK_MICROS)))


def decay_rate(kind: Column, rates: Mapping[str, float] = DECAY_RATES) -> Column:
    """NULL for an unknown kind."""
    out = F.when(F.lit(False), F.lit(0.0))
    for name, rate in rates.items():
        out = out.when(kind == name, F.lit(rate))
    return out


def decay_strength(strength: Column, kind: Column, weeks: Column, rates: Mapping[str, float] = DECAY_RATES) -> Column:
    """strength * exp(-rate * weeks), held to 0..1. An unknown kind or a strength outside 0..1 stops the job."""
    rate = decay_rate(kind, rates)
    bad = (rate.isNull() & strength.isNotNull()) | (strength < 0) | (strength > 1)
    value = F.least(F.lit(1.0), F.greatest(F.lit(0.0), strength * F.exp(-rate * weeks)))
    return F.when(bad, F.raise_error(F.concat_ws(" ", F.lit("no decay for"), kind, strength.cast("string"))).cast("double")).when(strength.isNotNull(), value)


def shared_strength(maps: Column, full: int = 20) -> Column:
    return F.least(F.lit(1.0), maps / F.lit(float(full)))


def pair_kind(last: Column, reference: Column, days: int = 90) -> Column:
    return F.when(micros(last) >= micros(reference) - days * 86_400_000_000, "teammate").otherwise("ex_teammate")


def cosine_distance(x: Column, y: Column) -> Column:
    """1 - cosine of two arrays of the same length, in double; NULL if one is a zero vector."""
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(x, x)) * F.sqrt(dot(y, y))
    return F.when(norm > 0, 1 - dot(x, y) / norm)


def usage_cost(input_price: Column, output_price: Column, input_tokens: Column, output_tokens: Column, cache_write_5m: Column, cache_write_1h: Column, cache_read: Column) -> Column:
    """USD; prices are per million tokens."""
    million = F.lit(1_000_000.0)
    written = cache_write_5m * CACHE_WRITE_5M + cache_write_1h * CACHE_WRITE_1H + cache_read * CACHE_READ
    return (input_tokens * input_price + output_tokens * output_price + written * input_price) / million


def worst_case_cost(input_price: Column, output_price: Column, input_tokens: Column, max_output_tokens: Column, cached: Column) -> Column:
    """Full output; with caching, all input at the rate of a five-minute cache write."""
    factor = F.when(cached, F.lit(CACHE_WRITE_5M)).otherwise(F.lit(1.0))
    return (input_tokens * input_price * factor + max_output_tokens * output_price) / F.lit(1_000_000.0)


def percent_of_cap(spend: Column, cap: Column) -> Column:
    return F.when(cap > 0, spend / cap * 100)


def finite(x: Column) -> Column:
    """The number, or NULL for text, NaN and infinities."""
    d = x.try_cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != float("inf")), d)


def clip(x: Column, lo: float, hi: float) -> Column:
    """greatest and least skip NULL, so NULL needs a case of its own."""
    return F.when(x.isNotNull(), F.least(F.lit(hi), F.greatest(F.lit(lo), x)))


def normalised(x: Column, kind: str, lo: Column, hi: Column, mean: Column, std: Column) -> Column:
    """x (finite or NULL) by minmax, zscore, log1p_minmax or passthrough; lo and hi are of log1p for the third.

    Where the fit is degenerate every cell is 0.5, missing ones included.
    """
    if kind == "passthrough":
        bad = (x < -UNIT_SLACK) | (x > 1 + UNIT_SLACK)
        return F.when(bad, F.raise_error(F.concat(F.lit("passthrough value outside 0..1: "), x.cast("string"))).cast("double")).otherwise(clip(x, 0.0, 1.0))
    if kind == "zscore":
        z = clip((x - mean) / std, -50.0, 50.0)
        return F.when(std.isNull() | (std < 1e-9), F.lit(0.5)).otherwise(1 / (1 + F.exp(-z)))
    if kind not in ("minmax", "log1p_minmax"):
        raise ValueError(f"no normaliser named {kind}")
    value = F.log1p(F.when(x.isNotNull(), F.greatest(x, F.lit(0.0)))) if kind == "log1p_minmax" else x
    return F.when(lo.isNull() | (hi <= lo), F.lit(0.5)).otherwise(clip((value - lo) / (hi - lo), 0.0, 1.0))
