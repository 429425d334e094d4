"""Number parsing and money arithmetic as Column expressions.

Money follows the warehouse rule "double first, decimal second": per-row
arithmetic runs in the source type (DOUBLE), each row is then cast to a
decimal and the decimals are summed.  Rows are cast to DECIMAL(26,9) so that
a sum is DECIMAL(36,9) and up to three sums can be added without Spark
dropping scale; results are finished as DECIMAL(38,9).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Decimal shapes of one row and of a finished report value.
ROW_DECIMAL = T.DecimalType(26, 9)
RESULT_DECIMAL = T.DecimalType(38, 9)

# Fixed value: plain decimal text accepted as a number (sign, digits, one
# point, optional exponent).  Anything else is not a number.
NUMERIC_TEXT = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


# One row of a sum that is rounded to cents at its end.
SUM_DECIMAL = T.DecimalType(28, 15)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def tolerant_double(col: Column | str) -> Column:
    """Text to DOUBLE; blank or malformed text becomes NULL."""
    t = F.trim(_c(col))
    return F.when(t.rlike(NUMERIC_TEXT), t.try_cast(T.DoubleType()))


def strict_double(col: Column | str, what: str = "amount") -> Column:
    """Text to DOUBLE; NULL stays NULL, malformed text fails the job."""
    c = _c(col)
    t = F.trim(c)
    return (F.when(c.isNull(), F.lit(None).cast(T.DoubleType()))
            .when(t.rlike(NUMERIC_TEXT), t.try_cast(T.DoubleType()))
            .otherwise(F.raise_error(F.concat(F.lit(f"not a number in {what}: "), c))
                       .cast(T.DoubleType())))


def money(col: Column | str) -> Column:
    """One row's value as DECIMAL(26,9) (rounds half away from zero)."""
    return _c(col).cast(ROW_DECIMAL)


def finish(col: Column | str) -> Column:
    """A report value in its final DECIMAL(38,9) shape."""
    return _c(col).cast(RESULT_DECIMAL)


def sum_money(col: Column | str) -> Column:
    """SUM(CAST(x AS NUMERIC)): a decimal sum, NULL when every row is NULL."""
    return F.sum(money(col))


def round_sum2(col: Column | str) -> Column:
    """ROUND(SUM(double), 2) computed exactly: decimal sum, round, back to DOUBLE.

    Rounding the decimal removes summation-order noise, so the value is the
    same whatever the partitioning.  Fifteen decimals a row keep what many tiny
    amounts add up to.
    """
    return F.round(F.sum(_c(col).cast(SUM_DECIMAL)), 2).cast(T.DoubleType())
