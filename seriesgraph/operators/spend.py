"""Usage ledgers: price lookup, digests over a window, and the audit of caps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.formulas import micros, percent_of_cap, usage_cost
from ..sources.shared import whole_if_small
from .scans import carried, ranged, within

#: USD caps of the governor.
WEEKLY_CAP = 30.00
PURPOSE_CAPS = {"personality": 15.00, "patch_intent": 3.00}
WEEK = 7 * 86_400 * 1_000_000


def priced(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """usage with usd_cost; prices (model, input_per_mtok, output_per_mtok) has a row a model. An unknown model stops the job.

    Models are few and each has many rows, so the usage stays where it is and the price list goes to it.
    """
    known = usage.join(whole_if_small(prices), "model", "left")
    price = F.coalesce("input_per_mtok", F.raise_error(F.concat(F.lit("no price for "), F.coalesce("model", F.lit("NULL")))).cast("double"))
    tokens = [F.coalesce(F.col(c), F.lit(0)) for c in ("input_tokens", "output_tokens", "cache_write_5m_tokens", "cache_write_1h_tokens", "cache_read_tokens")]
    return known.withColumn("usd_cost", usage_cost(price, F.col("output_per_mtok"), *tokens)).drop("input_per_mtok", "output_per_mtok")


def spend_since(ledger: DataFrame, since: Column, purpose: str | None = None) -> DataFrame:
    """One row: spend from since on (inclusive), 0.0 if there is none."""
    rows = ledger.where(F.col("timestamp") >= since)
    return (rows if purpose is None else rows.where(F.col("purpose") == purpose)).agg(F.coalesce(F.sum("usd_cost"), F.lit(0.0)).alias("spend"))


def _caps(caps: dict[str, float]) -> Column:
    out = F.when(F.lit(False), F.lit(0.0))
    for name, cap in caps.items():
        out = out.when(F.col("purpose") == name, F.lit(cap))
    return out


def digest_by_purpose(ledger: DataFrame, since: Column, caps: dict[str, float] = PURPOSE_CAPS) -> DataFrame:
    """Per purpose: spend, calls, blocked, tokens, percent_of_cap. Blocked rows count only as blocked, errors as calls and spend."""
    call = F.col("phase") != "blocked"
    of = lambda c: F.coalesce(F.sum(F.when(call, F.col(c))), F.lit(0))
    out = ledger.where(F.col("timestamp") >= since).groupBy("purpose").agg(
        F.coalesce(F.sum(F.when(call, F.col("usd_cost"))), F.lit(0.0)).alias("spend"),
        F.count_if(call).alias("calls"), F.count_if(~call).alias("blocked"),
        of("input_tokens").alias("input_tokens"), of("output_tokens").alias("output_tokens"), of("cache_read_input_tokens").alias("cache_read_tokens"),
    )
    return out.withColumn("percent_of_cap", percent_of_cap(F.col("spend"), _caps(caps))).orderBy(F.desc("spend"), "purpose")


def digest_by_model(ledger: DataFrame, since: Column) -> DataFrame:
    return ledger.where((F.col("timestamp") >= since) & (F.col("phase") != "blocked")).groupBy("model").agg(F.sum("usd_cost").alias("spend"), F.count(F.lit(1)).alias("calls"))


def digest_totals(ledger: DataFrame, since: Column, now: Column) -> DataFrame:
    """One row: total and today's spend (from midnight UTC), blocked and failed calls, percent of the weekly cap."""
    call = F.col("phase") != "blocked"
    money = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("usd_cost"))), F.lit(0.0))
    out = ledger.where(F.col("timestamp") >= since).agg(money(call).alias("total"), money(call & (F.col("timestamp") >= F.date_trunc("day", now))).alias("today"), F.count_if(~call).alias("blocked"), F.count_if(F.col("phase") == "error").alias("errors"))
    return out.withColumn("percent_of_cap", percent_of_cap(F.col("total"), F.lit(WEEKLY_CAP)))


def _trailing(ledger: DataFrame, keys: list[str], ts: str, cost: str, name: str) -> DataFrame:
    """Each call with what its keys' calls spent in the seven days before it (the call's own instant excluded).

    A call adds its cost from the next instant on and takes it away seven days later: one running sum, in decimals, so
    what is added is taken away in full. The sum is cut by ranges of (keys, time), each beginning with the sum of those
    before, so no task sorts all calls of a key or a day, and twice the calls take twice the time.
    """
    exact = "decimal(28,9)"
    money = F.coalesce(F.col(cost).cast(exact), F.lit(0).cast(exact))
    at = micros(F.col(ts))
    by = [f"_k{i}" for i in range(len(keys))]
    own = ledger.select(*[F.col(k).alias(b) for k, b in zip(keys, by)], at.alias("_at"), F.lit(0).cast(exact).alias("_delta"), F.struct(*ledger.columns).alias("_row"))
    change = F.explode(F.array(F.struct((at + 1).alias("at"), money.alias("by")), F.struct((at + WEEK + 1).alias("at"), (-money).alias("by"))))
    changes = ledger.select(*[F.col(k).alias(b) for k, b in zip(keys, by)], change.alias("_c")).where("_c.by != 0")
    changes = changes.select(*by, F.col("_c.at").alias("_at"), F.col("_c.by").cast(exact).alias("_delta"))
    placed = ranged(own.unionByName(changes, allowMissingColumns=True), by, "_at")
    running = F.sum("_delta").over(within(by, "_at").rangeBetween(Window.unboundedPreceding, 0))
    rows = carried(placed, by, _before=(F.sum("_delta"), "sum")).withColumn("_within", running).where("_row is not null")
    return rows.select("_row.*", (F.col("_within") + F.coalesce(F.col("_before"), F.lit(0).cast(exact))).cast("double").alias(name))


def trailing_spend(ledger: DataFrame, purpose: str = "purpose", ts: str = "timestamp", cost: str = "usd_cost") -> DataFrame:
    """Each call with what its purpose spent in the seven days before it (the call's own instant excluded)."""
    return _trailing(ledger, [purpose], ts, cost, "purpose_trailing")


def trailing_total(ledger: DataFrame, ts: str = "timestamp", cost: str = "usd_cost") -> DataFrame:
    """Each call with what all purposes spent in the seven days before it."""
    return _trailing(ledger, [], ts, cost, "total_trailing")


def audit_caps(ledger: DataFrame, weekly_cap: float = WEEKLY_CAP, caps: dict[str, float] = PURPOSE_CAPS) -> DataFrame:
    """Each call with breach: purpose if it takes its purpose over its cap, else weekly if it takes all over theirs, else NULL."""
    both = trailing_total(trailing_spend(ledger))
    over = F.when(F.col("purpose_trailing") + F.col("usd_cost") > _caps(caps), "purpose").when(F.col("total_trailing") + F.col("usd_cost") > weekly_cap, "weekly")
    return both.withColumn("breach", over)
