"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Casting text that is no number is slow, so the form is checked first.
_WHOLE = r"^\s*[-+]?\d+\s*$"
_DECIMAL = r"^\s*[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?\s*$"
_INT_LIMIT = 2147483648.0


def lenient_int(c: Column) -> Column:
    """Whole-number text to integer; decimals and junk are null."""
    return F.when(c.rlike(_WHOLE), c.try_cast("int"))


def whole_number(c: Column) -> Column:
    """Number text to integer, cutting decimals off; junk is null."""
    value = F.when(c.rlike(_DECIMAL), c.try_cast("double"))
    cut = F.when(F.abs(value) < _INT_LIMIT, value.cast("int"))
    return F.when(c.rlike(_WHOLE), c.try_cast("int")).otherwise(cut)


def strict_int(c: Column) -> Column:
    """Whole-number text to integer; null stays null and junk fails the job."""
    return F.when(
        c.isNotNull(),
        F.coalesce(
            whole_number(c),
            F.raise_error(F.concat(F.lit("not a whole number: "), c)).cast("int"),
        ),
    )


def percent(c: Column) -> Column:
    """Cut to a whole number within 0 to 100; a missing value counts as 0, junk is null."""
    return F.when(c.isNull(), F.lit(0)).otherwise(
        clamp_percent(F.when(c.rlike(_DECIMAL), c.try_cast("double")))
    )


def clamp_percent(c: Column) -> Column:
    value = c.cast("double")
    return F.when(
        value.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(100.0), value)).cast("int")
    )
