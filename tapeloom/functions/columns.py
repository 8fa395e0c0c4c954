"""Expressions shared by the plans.

Means and sums of values that are already rounded run on scaled integers. The
result then does not depend on the order in which partitions are merged, which a
sum of doubles does, and it stays inside hash aggregation.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

Moment = Column | datetime | str | None


def moment(as_of: Moment) -> Column:
    """The clock of a query: an explicit instant, or now."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def div(a: Column, b: Column) -> Column:
    """Integer division, truncating."""
    return F.call_function("div", a, b)


def floor_div(a: Column, b: Column) -> Column:
    return div(a - F.pmod(a, b), b)


def bps_from(price: Column, reference: Column) -> Column:
    """Distance from a reference price in basis points; NULL unless it is positive."""
    return F.when(reference > 0, (price - reference) / reference * 10000)


def scaled(value: Column | str, places: int) -> Column:
    """A value rounded to `places` decimals as an integer count of its last place."""
    return F.rint(_col(value) * 10**places).cast("long")


def exact_sum(value: Column | str, places: int = 2) -> Column:
    """Sum in units of the last place, as a decimal: a table may hold more than 2^63 of them."""
    return F.sum(scaled(value, places).cast("decimal(28,0)"))


def sum_of_rounded(value: Column | str, places: int = 2) -> Column:
    return exact_sum(value, places).cast("double") / 10**places


def mean_of_rounded(value: Column | str, places: int = 2) -> Column:
    """Mean rounded half away from zero to the precision of its input; NULL over nothing."""
    return mean_of_units(exact_sum(value, places), F.count(_col(value)), places)


def mean_of_units(total: Column, n: Column, places: int) -> Column:
    """The same from a sum in units of the last place and a count."""
    magnitude = div(2 * F.abs(total) + n, 2 * n)
    return F.when(n > 0, F.when(total < 0, -magnitude).otherwise(magnitude) / 10**places)


def half_up(numerator: Column, denominator: Column, places: int) -> Column:
    """floor(x * 10^places + 1/2) / 10^places of an integer ratio: ties go up, also below zero."""
    shifted = 2 * numerator * 10**places + denominator
    return F.when(denominator > 0, floor_div(shifted, 2 * denominator) / 10**places)


def half_up_value(value: Column, places: int = 1) -> Column:
    """The same rounding of one double."""
    return F.floor(value * 10**places + 0.5) / 10**places


def number_or_zero(value: Column | str) -> Column:
    return F.coalesce(F.nanvl(_col(value).cast("double"), F.lit(0.0)), F.lit(0.0))


def or_default(value: Column | str, default) -> Column:
    """The value unless it is missing or zero."""
    value = _col(value)
    return F.when(value.isNotNull() & (value != 0), value).otherwise(F.lit(default))


def category(value: Column | str, missing: str = "UNKNOWN") -> Column:
    return F.coalesce(F.nullif(_col(value), F.lit("")), F.lit(missing))


def slippage_band(value: Column | str) -> Column:
    """Blotter colour of one order: more than 3 bps lost is bad, more than 1 won is good."""
    value = _col(value)
    return (
        F.when(value.isNull(), "none")
        .when(value > 3, "bad")
        .when(value < -1, "good")
        .otherwise("neutral")
    )


def slippage_grade(value: Column | str) -> Column:
    """Grade of the desk average."""
    value = _col(value)
    return F.when(value <= 2, "good").when(value <= 5, "warn").otherwise("bad")


def slippage_side(value: Column | str) -> Column:
    return F.when(_col(value) >= 0, "vs arrival").otherwise("saved vs arrival")


def is_up(change_pct: Column | str) -> Column:
    return F.coalesce(_col(change_pct), F.lit(0.0)) >= 0


def json_object(*fields: Column) -> Column:
    """A JSON object that spells out its missing fields."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
