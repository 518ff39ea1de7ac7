"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def whole_days(start: Column, end: Column) -> Column:
    """Completed 24-hour days from ``start`` to ``end``, rounded down.

    ``datediff`` counts midnights and is not the same thing.
    """
    days = F.timestamp_diff("DAY", start, end)
    # timestamp_diff truncates toward zero; a negative part day rounds down
    overshoot = F.timestamp_add("DAY", days, start) > end
    return F.when(overshoot, days - 1).otherwise(days)


def month_of(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "month")


def month_number(day: Column) -> Column:
    """A month count that can be subtracted."""
    return F.year(day) * 12 + F.month(day)


def ratio(part: Column, whole: Column) -> Column:
    """Double division; null for an empty or zero denominator."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * 100


def total_of(df: DataFrame, aggregate: Column) -> Column:
    """One aggregate of a whole table as a scalar subquery."""
    return df.agg(aggregate.alias("_total")).scalar()


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.CharType, T.VarcharType))]


def without_nan(df: DataFrame) -> DataFrame:
    """The same table with NaN as null: both are missing values."""
    doubles = [f for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({f.name: F.nanvl(quoted(f.name), F.lit(None).cast(f.dataType)) for f in doubles}) if doubles else df


def quoted(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")
