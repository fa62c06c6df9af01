"""Numbers: reading them from text, rounding them, comparing them.

Functions take a SQL expression, most often just a column name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Doubles pass through this type before rounding or ranking, so that the last
# bits of a sum, which depend on the order of its terms, never show.
EXACT = "decimal(28,10)"


def to_double_sql(value: str) -> str:
    return f"nullif(try_cast({value} AS double), double('NaN'))"


def to_double(value: str) -> Column:
    """The number a text holds; null when it holds none (NaN counts as none)."""
    return F.expr(to_double_sql(value))


def is_not_number(value: str) -> Column:
    """True for missing values and for text that is no plain decimal number."""
    java_suffix = rf"string({value}) RLIKE r'[0-9.][dDfF]\s*$'"
    return F.expr(f"{to_double_sql(value)} IS NULL OR {java_suffix}")


def rounded_sql(value: str, digits: int) -> str:
    return (
        f"coalesce(double(round(try_cast({value} AS {EXACT}), {digits})), double({value}))"
    )


def rounded(value: str, digits: int) -> Column:
    """Half-up rounding of the decimal value; infinities stay as they are."""
    return F.expr(rounded_sql(value, digits))


def percent(rate: str) -> Column:
    """A rate between 0 and 1 as a percentage with one digit."""
    return rounded(f"{rate} * 100", 1)


def exact_sql(value: str) -> str:
    number = f"nullif(double({value}), double('NaN'))"
    inside = f"try_cast({number} AS {EXACT})"
    return (
        f"if({number} IS NULL, NULL, named_struct("
        f"'side', if({inside} IS NULL, int(signum({number})), 0), "
        f"'near', {inside}, 'far', if({inside} IS NULL, {number}, NULL)))"
    )


def exact(value: str) -> Column:
    """Sort key of a double: equal up to summation noise means equal.

    Values beyond the decimal, infinities included, stand above or below all
    others and are ordered among themselves as doubles. NaN counts as null.
    """
    return F.expr(exact_sql(value))


#: Endings of the addends of one value: four whole numbers, and a double for what they cannot hold.
ADDENDS = ("_e10", "_e4", "_e2", "_e8", "_far")


def exact_addends(value: str) -> tuple[str, str, str, str, str]:
    """Addends, in the order of ``ADDENDS``, for a sum that does not depend on the order of its terms.

    A value below 1e15, to eight decimals, is
    ``e10 * 1e10 + e4 * 1e4 + e2 / 1e2 + e8 / 1e8``. None of the four longs is above a million,
    so each can be added up over nine trillion rows of one group before a carry is due;
    :func:`exact_units` carries. The fifth takes values from 1e15 on, infinities and NaN.
    """
    number = f"double({value})"
    inside = f"abs({number}) < 1e15D"
    whole = f"bigint(floor({number}))"
    rest = f"bigint(floor(({number} - floor({number})) * 1e8D + 0.5D))"
    high = f"bigint(floor({number} / 1e10D))"
    below = f"({whole} - {high} * 10000000000L)"
    middle = f"bigint(floor({below} / 1e4D))"
    hundredths = f"bigint(floor({rest} / 1e6D))"
    return (
        f"if({inside}, {high}, NULL)",
        f"if({inside}, {middle}, NULL)",
        f"if({inside}, ({below} - {middle} * 10000L) * 100L + {hundredths}, NULL)",
        f"if({inside}, {rest} - {hundredths} * 1000000L, NULL)",
        f"if({inside}, NULL, {number})",
    )


def exact_units(e10: str, e4: str, e2: str, e8: str) -> str:
    """The added-up whole numbers as one decimal, in units of 1e-8: the state that is stored and merged.

    Sums of this decimal hold up to 1e30 times the unit of one, more than any table has.
    """
    parts = ((e10, 10**18), (e4, 10**12), (e2, 10**6), (e8, 1))
    return "(" + " + ".join(
        f"CAST({part} AS decimal(19,0)) * CAST({unit} AS decimal(19,0))" for part, unit in parts
    ) + ")"


def exact_total(units: str, far: str) -> str:
    """The double of a sum kept as units and far values; null if there was nothing to add."""
    near = f"(double({units}) / 1e8D)"
    return f"coalesce({near} + {far}, {near}, {far})"


def _exact_sum(value: str) -> str:
    *whole, far = (f"sum({addend})" for addend in exact_addends(value))
    return exact_total(exact_units(*whole), far)


def exact_sum(value: str) -> Column:
    """The sum of a double column, the same in every run."""
    return F.expr(_exact_sum(value))


def exact_mean_sql(value: str) -> str:
    return f"try_divide({_exact_sum(value)}, count({value}))"


def exact_mean(value: str) -> Column:
    return F.expr(exact_mean_sql(value))


def exact_moments(value: str) -> tuple[Column, Column]:
    """The mean and the standard deviation of a population, the same in every run.

    Values below a million are taken to twelve decimals and added up, as are their squares, as
    decimals without rounding. Only if there are larger values, or squares beyond 1e14 in all, both come from doubles,
    whose last bits depend on the order of the rows.
    """
    number = f"double({value})"
    near = f"try_cast({number} AS decimal(18,12))"
    n = f"double(count({near}))"
    first, second = f"double(try_sum({near}))", f"double(try_sum({near} * {near}))"
    mean = f"({first} / nullif({n}, 0D))"
    # Equal values have no spread at all, not the rounding error of a difference.
    spread = f"if(min({near}) = max({near}), 0D, sqrt(greatest(0D, {second} / nullif({n}, 0D) - {mean} * {mean})))"
    whole = f"count({near}) = count({number}) AND {second} IS NOT NULL"
    return (
        F.expr(f"if({whole}, {mean}, avg({number}))"),
        F.expr(f"if({whole}, {spread}, stddev_pop({number}))"),
    )


def settle_doubles(frame: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column, for comparing results between runs and engines."""
    return frame.selectExpr(
        *(
            f"{rounded_sql(f'`{f.name}`', digits)} AS `{f.name}`"
            if isinstance(f.dataType, T.DoubleType)
            else f"`{f.name}`"
            for f in frame.schema.fields
        )
    )
