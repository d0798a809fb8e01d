"""Currency conversion (E24) and the rate random-walk as a cumulative product."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import cumulative_product


def rates_from_changes(changes: DataFrame, base: DataFrame) -> DataFrame:
    """Rate per currency × week = base rate × running product of (1 + weekly change)."""
    return (changes.join(base, "currency_code")
            .withColumn("rate_to_usd", F.col("base_rate") * cumulative_product("change", ["currency_code"], "week_id"))
            .select("currency_code", "week_id", "rate_to_usd"))


def to_usd(df: DataFrame, amount_col: str, rates: DataFrame, currency_col: str = "currency_code",
           week_col: str = "week_id") -> DataFrame:
    """Amount in USD by an equi-join on (currency, week); unknown pairs give NULL, never a drop."""
    r = rates.select(F.col("currency_code").alias(currency_col), F.col("week_id").alias(week_col), "rate_to_usd")
    return df.join(r, [currency_col, week_col], "left").withColumn(f"{amount_col}_usd",
                                                                  F.col(amount_col) * F.col("rate_to_usd"))


def weekly_shock(week_id: Column, currency_no: Column) -> Column:
    """Deterministic weekly rate change in [-0.004, 0.004] (fixture rule; replaces the generator's
    normal draw): ((week × 5 + currency number × 7) mod 9 − 4) per mille."""
    return ((week_id * 5 + currency_no * 7) % 9 - 4).cast("double") / 1000.0


def rate_walk(weeks: DataFrame, base_rates: dict[str, float], band: float, shock=weekly_shock) -> DataFrame:
    """W6 + dim_fx_rate: per currency × week, base × running product of (1 + shock), clipped to
    base × (1 ± band); the base currency (rate 1.0) does not move.

    The currency list is a literal, so it is exploded onto the calendar (no cross join); the result
    has (currencies × weeks) rows whatever the data size.
    """
    cur = F.array(*[F.struct(F.lit(c).alias("currency_code"), F.lit(i).alias("currency_no"),
                             F.lit(float(r)).alias("base_rate")) for i, (c, r) in enumerate(base_rates.items())])
    g = weeks.select("week_id", F.explode(cur).alias("c")).select("week_id", "c.*")
    g = g.withColumn("change", F.when(F.col("base_rate") == 1.0, F.lit(0.0))
                     .otherwise(shock(F.col("week_id"), F.col("currency_no"))))
    walk = F.col("base_rate") * cumulative_product("change", ["currency_code"], "week_id")
    lo, hi = F.col("base_rate") * (1 - band), F.col("base_rate") * (1 + band)
    return g.select("currency_code", "week_id", F.least(F.greatest(walk, lo), hi).alias("rate_to_usd"))
