"""Column expressions shared by the operators.

All of them are built-in Catalyst expressions, so they stay inside
whole-stage codegen; none is a Python UDF.
"""
from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import SIZE_ORDER


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def case_map(key, mapping: dict, default) -> Column:
    """Dictionary lookup with a default, as a CASE chain (no map column materialised)."""
    key = col(key)
    out = None
    for k, v in mapping.items():
        out = F.when(key == F.lit(k), F.lit(v)) if out is None else out.when(key == F.lit(k), F.lit(v))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def initcap_word(c) -> Column:
    """Upper-case the first letter, lower-case the rest (one word)."""
    c = col(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 20)))


def money(c) -> Column:
    """Exact two-decimal money: decimal arithmetic rounds half-up identically on every engine."""
    return F.round(col(c).cast("decimal(18,4)"), 2).cast("decimal(12,2)")


def whole(c, kind: str = "long") -> Column:
    """``round(c).cast(kind)`` of a double, half away from zero, to the same numbers and errors: the cast cuts the
    fraction off, which is exact in doubles and decides the last unit. Spark's own ``round`` goes through a decimal
    string for every value, several times the cost of the rest of a line."""
    cut = col(c).cast(kind)
    rest = col(c) - cut.cast("double")
    return cut + F.when((rest >= 0.5) & (rest < 1), 1).when((rest <= -0.5) & (rest > -1), -1).otherwise(0)


def all_of(preds: list[Column]) -> Column:
    """AND of the filters actually given (TRUE when none)."""
    preds = [p for p in preds if p is not None]
    return reduce(and_, preds) if preds else F.lit(True)


def any_of(preds: list[Column]) -> Column:
    preds = [p for p in preds if p is not None]
    return reduce(or_, preds) if preds else F.lit(False)


def contains_any(c, fragments) -> Column:
    """The string holds any of the fragments (null string -> false)."""
    c = F.coalesce(col(c), F.lit(""))
    return any_of([c.contains(f) for f in fragments])


def exact_sum(c, scale: int = 9) -> Column:
    """Sum of per-row doubles as fixed-point decimals: every row is rounded to ``scale`` places first, so
    the total is exact and does not depend on partitioning or summation order (a double sum can land on
    either side of a rounding tie). Returns a decimal; round or cast it where it is reported."""
    return F.sum(col(c).cast(f"decimal(20,{scale})"))


def safe_div(num, den) -> Column:
    """NULL instead of an error (ANSI) or inf when the divisor is 0 or NULL."""
    return F.try_divide(col(num), F.nullif(col(den), F.lit(0)))


def clip(c, lo=None, hi=None) -> Column:
    """Clip to bounds."""
    c = col(c)
    if lo is not None:
        c = F.greatest(c, F.lit(lo))
    if hi is not None:
        c = F.least(c, F.lit(hi))
    return c


def ladder(c, steps: list[tuple], default) -> Column:
    """Threshold ladder ``[(bound, value), ...]`` -> value of the first ``c < bound``."""
    c = col(c)
    out = None
    for bound, value in steps:
        out = F.when(c < bound, F.lit(value)) if out is None else out.when(c < bound, F.lit(value))
    return out.otherwise(F.lit(default))


def size_rank(size) -> Column:
    """Business size order; numeric sizes after letters as 100 + n; unknown -> NULL (sorted last)."""
    s = col(size)
    known = case_map(s, SIZE_ORDER, None)
    return F.coalesce(known.cast("int"), F.lit(100) + s.try_cast("int"))


def lifecycle_mult(t) -> Column:
    """ramp 0.3 + 0.175 t (t<4), 1 (t<17), 1 - (t-17)·0.65/14 (t<31), else 0.455."""
    t = col(t)
    return (F.when(t < 4, F.lit(0.3) + F.lit(0.175) * t)
            .when(t < 17, F.lit(1.0))
            .when(t < 31, F.lit(1.0) - (t - 17) * F.lit(0.65 / 14))
            .otherwise(F.lit(0.455)))


def christmas_ramp(days_to_christmas) -> Column:
    """F22 (second factor): 1 + 0.4 · clip(1 - |d| / 21, 0, 1)."""
    d = col(days_to_christmas)
    return F.lit(1.0) + F.lit(0.4) * clip(F.lit(1.0) - F.abs(d) / F.lit(21.0), 0.0, 1.0)


def weather_mult(category, warmth, temp_dev, warmth_threshold: int = 3) -> Column:
    """warm outerwear only: clip(1 - 0.05 · max(temp, 0) · warmth / 5, 0.4, 1.05)."""
    effect = F.lit(1.0) - F.lit(0.05) * F.greatest(col(temp_dev), F.lit(0.0)) * col(warmth) / F.lit(5.0)
    warm_outerwear = (col(category) == "Outerwear") & (col(warmth) >= warmth_threshold)
    return F.when(warm_outerwear, clip(effect, 0.4, 1.05)).otherwise(F.lit(1.0))


def event_window_mult(week, trigger_week, spike_weeks, spike_mult, settle_mult, extra=1.0) -> Column:
    """spike weeks from the trigger, then a settle plateau; ``extra`` weights both."""
    w = col(week)
    return (F.when(w < trigger_week, F.lit(1.0))
            .when(w < F.lit(trigger_week) + spike_weeks, F.lit(spike_mult) * extra)
            .otherwise(F.lit(settle_mult) * extra))


def stock_status(on_hand, warning: int = 5) -> Column:
    """STOCKOUT at 0, WATCH under ``warning``, else HEALTHY."""
    c = col(on_hand)
    return F.when(c <= 0, F.lit("STOCKOUT")).when(c < warning, F.lit("WATCH")).otherwise(F.lit("HEALTHY"))


def first_n_text(names: Column, n: int = 5) -> Column:
    """'a, b, c, d, e (+k more)' from an array column."""
    total = F.size(names)
    head = F.array_join(F.slice(names, 1, n), ", ")
    return F.when(total > n, F.concat(head, F.lit(" (+"), (total - n).cast("string"), F.lit(" more)"))).otherwise(head)


def cumulative_product(x, partition_by: list[str], order_by: str) -> Column:
    """Running product of (1 + x) per partition as exp(sum(ln(1 + x))); needs x > -1."""
    from pyspark.sql import Window
    w = Window.partitionBy(*partition_by).orderBy(order_by).rowsBetween(Window.unboundedPreceding, 0)
    return F.exp(F.sum(F.log1p(col(x))).over(w))


def zero_padded_id(prefix: str, n, width: int = 4) -> Column:
    """'DEC-0001' style ids."""
    return F.format_string(f"{prefix}%0{width}d", col(n))
