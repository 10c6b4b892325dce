"""Order measures and report arithmetic, shared by batch and order entry.

Money is computed in decimals: price and cost are taken to DECIMAL(27,12)
before multiplying, and the result is rounded half-up to two places.  The
margin is computed in double and then rounded.  A value that does not fit its
type is NULL, never an error; ``out_of_range`` says which orders that holds
for, so they can be named and set aside.  The same expressions serve the batch
fact and registered orders, so one order always gets one value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MARGIN, MONEY, MONEY_SUM, RATIO

_WORK = "decimal(27,12)"
_COUNT = "decimal(10,0)"


def _dec(c: Column) -> Column:
    return c.try_cast(_WORK)


def _money(quantity: Column, each: Column) -> Column:
    """DECIMAL(10,0) x DECIMAL(27,12) = DECIMAL(38,12), NULL beyond it."""
    return F.round(F.try_multiply(quantity.try_cast(_COUNT), each), 2).try_cast(MONEY)


def _gap(unit_price: Column, cost: Column) -> Column:
    return F.try_subtract(_dec(unit_price), _dec(F.coalesce(cost, F.lit(0.0)))).try_cast(_WORK)


def revenue(quantity: Column, unit_price: Column) -> Column:
    """round(quantity * unit_price, 2)."""
    return _money(quantity, _dec(unit_price))


def gross_profit(quantity: Column, unit_price: Column, cost: Column) -> Column:
    """round(quantity * (unit_price - coalesce(cost, 0)), 2)."""
    return _money(quantity, _gap(unit_price, cost))


def margin_pct(unit_price: Column, cost: Column) -> Column:
    """(unit_price - coalesce(cost, 0)) / unit_price * 100 when price > 0, else NULL."""
    p = unit_price.cast("double")
    share = F.try_divide(p - F.coalesce(cost.cast("double"), F.lit(0.0)), p) * F.lit(100.0)
    # 15 significant digits, as a database prints a double that becomes numeric
    exact = F.format_string("%.15g", share).try_cast("decimal(38,12)")
    return F.when(p > 0, F.round(exact, 2)).try_cast(MARGIN)


def out_of_range(quantity: Column, unit_price: Column, cost: Column) -> Column:
    """True where a price that is there has no revenue, profit or margin that
    fits, or lies below the working scale."""
    lost = (
        _dec(unit_price).isNull()
        | (_dec(unit_price) == 0)
        | revenue(quantity, unit_price).isNull()
        | gross_profit(quantity, unit_price, cost).isNull()
        | margin_pct(unit_price, cost).isNull()
    )
    return F.when((unit_price > 0) & quantity.isNotNull(), lost).otherwise(F.lit(False))


def date_parts(d: Column) -> dict[str, Column]:
    """Zero-padded year, month and year_month text of a date."""
    return {
        "year": F.date_format(d, "yyyy"),
        "month": F.date_format(d, "MM"),
        "year_month": F.date_format(d, "yyyy-MM"),
    }


def order_measures(quantity: Column, unit_price: Column, cost: Column, order_date: Column) -> dict[str, Column]:
    """All derived fact columns of one order line."""
    out = date_parts(order_date)
    out["revenue"] = revenue(quantity, unit_price)
    out["gross_profit"] = gross_profit(quantity, unit_price, cost)
    out["margin_pct"] = margin_pct(unit_price, cost)
    return out


# ---- report arithmetic -------------------------------------------------------


# Operands are narrowed to DECIMAL(24,2) before dividing so the quotient
# keeps 10 fractional digits before the final half-up rounding.
_OPERAND = "decimal(24,2)"


def money_sum(c: Column) -> Column:
    """ROUND(SUM(x), 2) as DECIMAL(38,2)."""
    return F.round(F.sum(c), 2).cast(MONEY_SUM)


def pct_of(part: Column, whole: Column) -> Column:
    """ROUND(part * 100 / NULLIF(whole, 0), 2) in exact decimals."""
    num = part.cast(_OPERAND) * F.lit(100).cast("decimal(3,0)")
    return F.round(num / F.nullif(whole.cast(_OPERAND), F.lit(0)), 2).cast(RATIO)


def ratio(num: Column, den: Column, scale: int = 2) -> Column:
    """ROUND(num / NULLIF(den, 0), scale) -- also the BI ``DIVIDE``."""
    q = num.cast(_OPERAND) / F.nullif(den.cast(_OPERAND), F.lit(0))
    return F.round(q, scale).cast(f"decimal(18,{scale})")
