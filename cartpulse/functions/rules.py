"""Numeric and ordering rules shared by every analysis.

* Rates round half-to-even (``bround``), like pandas ``round``.
* Division never throws under ANSI: ``try_divide`` yields NULL on zero.
* Every limit gets a total order, so top-k answers are deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ratio_pct(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    """round_half_even(num / den * 100, digits) in double; NULL when den = 0."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return F.bround(F.try_divide(num.cast("double"), den.cast("double")) * F.lit(100.0), digits)


def ratio(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    """round_half_even(num / den, digits); NULL when den = 0."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return F.bround(F.try_divide(num.cast("double"), den.cast("double")), digits)


def count_where(cond: Column) -> Column:
    """Conditional count as a bigint (algebraic: partial-aggregates map side)."""
    return F.count_if(cond)


def half_up_mean(total_col: str, n_col: str, digits: int = 2) -> Column:
    """Exact half-up rounding of total / n for non-negative integer columns.

    Matches a decimal ``ROUND(AVG(x), 2)``; integer arithmetic, so no binary
    floating point intermediate can tip a tie. NULL when n = 0.
    """
    scale = 10 ** digits
    return F.expr(
        f"CASE WHEN {n_col} > 0 THEN "
        f"cast(({total_col} * {2 * scale} + {n_col}) div (2 * {n_col}) as double) / {scale} END")


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """Global top-k; planned as TakeOrderedAndProject (per-task top-k, then merge)."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, keys: Sequence[str], k: int,
                    order: Sequence[Column], rank_col: str | None = None) -> DataFrame:
    """Top-k within each group by ``row_number``.

    The ``rank <= k`` filter lets Catalyst insert a WindowGroupLimit on both
    sides of the shuffle, so a group never ships more than k rows per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    rn = rank_col or "__rn"
    out = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= k)
    return out if rank_col else out.drop(rn)


# Prices are summed as integers of this many decimal digits, so that a sum does
# not depend on the order of its rows.
PRICE_DIGITS = 10


def price_units(price: Column | str) -> Column:
    """Price in integer units of 10 ** -PRICE_DIGITS, from the double's shortest
    decimal form."""
    price = F.col(price) if isinstance(price, str) else price
    scaled = price.cast(f"decimal(28,{PRICE_DIGITS})") * F.lit(10 ** PRICE_DIGITS)
    return scaled.cast("decimal(28,0)")


def mean_half_even(total_units: str, n: str, digits: int = 2) -> Column:
    """round_half_even(total / n, digits) from a sum of ``price_units``; exact,
    rounded once; NULL when n = 0.

    Floor division in integers: rem = pmod(total, step) in [0, step) with
    step = n * 10 ** (PRICE_DIGITS - digits); round up when 2 rem > step, or
    = step and the quotient is odd.
    """
    step = f"(cast({n} as decimal(20,0)) * {10 ** (PRICE_DIGITS - digits)})"
    rem = f"pmod({total_units}, {step})"
    quot = f"cast(({total_units} - {rem}) / {step} as decimal(20,0))"
    return F.expr(f"""
        CASE WHEN {n} > 0 THEN
          cast({quot} + CASE WHEN 2 * {rem} > {step}
                               OR (2 * {rem} = {step} AND pmod({quot}, 2) = 1)
                             THEN 1 ELSE 0 END
               AS double) / {10 ** digits}
        END""")
