"""Cleaning and encoding operators for any table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.functions.joins import lookup
from basketlens.functions.ordering import exact_quantiles, rank_in_group
from basketlens.functions.scalars import numeric_columns, quoted, text_columns, without_nan
from basketlens.operators.profiling import iqr_bounds

UNKNOWN = "Unknown"
WEEKEND_FROM = 5  # fixed value: Saturday, with Monday as 0


def _one_row(found: DataFrame, value: Column, columns: list[str]) -> Column:
    """Per-column results as one struct scalar, a field per column."""
    fields = [F.max(F.when(F.col("column") == c, value)).alias(f"c{i}") for i, c in enumerate(columns)]
    return found.agg(F.struct(*fields)).scalar()


def impute(df: DataFrame, numbers: list[str] | None = None, texts: list[str] | None = None) -> DataFrame:
    """Numbers by their median, texts by "Unknown"."""
    numbers = numeric_columns(df) if numbers is None else numbers
    texts = text_columns(df) if texts is None else texts
    filled = df.na.fill(UNKNOWN, texts) if texts else df
    if not numbers:
        return filled
    medians = _one_row(exact_quantiles(df, numbers, [0.5]), F.get("quantiles", F.lit(0)), numbers)
    # medians are doubles: a whole-number column becomes a double, as it must
    return filled.withColumn("_m", medians).withColumns(
        {c: F.coalesce(F.nanvl(quoted(c).cast("double"), F.lit(None).cast("double")), F.col(f"_m.c{i}")) for i, c in enumerate(numbers)}
    ).drop("_m")


def drop_sparse_columns(df: DataFrame, max_missing: float = 0.5) -> DataFrame:
    """Without the columns that are missing in more than this share of rows.
    Which ones those are is table metadata: one small row to the driver."""
    shares = without_nan(df).agg(*[F.avg(quoted(c).isNull().cast("int")).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    sparse = [c for i, c in enumerate(df.columns) if (shares[i] or 0.0) > max_missing]
    return df.select(*[quoted(c) for c in df.columns if c not in sparse])


def _fences(df: DataFrame, columns: list[str]) -> Column:
    return _one_row(iqr_bounds(df, columns), F.struct("lower", "upper"), columns)


def winsorize(df: DataFrame, columns: list[str]) -> DataFrame:
    """Clip to the IQR fences; missing values are null."""
    df = without_nan(df)
    clipped = {
        c: F.when(quoted(c).isNotNull(), F.least(F.greatest(quoted(c).cast("double"), F.col(f"_f.c{i}.lower")), F.col(f"_f.c{i}.upper")))
        for i, c in enumerate(columns)
    }
    return df.withColumn("_f", _fences(df, columns)).withColumns(clipped).drop("_f")


def remove_outliers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep rows whose values lie within the fences; rows with missing
    values go."""
    df = without_nan(df)
    kept = df.withColumn("_f", _fences(df, columns))
    for i, c in enumerate(columns):
        kept = kept.filter(quoted(c).cast("double").between(F.col(f"_f.c{i}.lower"), F.col(f"_f.c{i}.upper")))
    return kept.drop("_f")


def cast_datetimes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text to timestamp; what does not parse becomes null."""
    return df.withColumns({c: F.try_to_timestamp(quoted(c)).cast("timestamp_ntz") for c in columns})


def date_features(df: DataFrame, column: str) -> DataFrame:
    """Year, month, day, hour, weekday (Monday is 0) and weekend flag."""
    ts = quoted(column)
    return df.withColumns(
        {
            f"{column}_year": F.year(ts),
            f"{column}_month": F.month(ts),
            f"{column}_day": F.day(ts),
            f"{column}_hour": F.hour(ts),
            f"{column}_day_of_week": F.weekday(ts),
            f"{column}_is_weekend": F.weekday(ts) >= WEEKEND_FROM,
        }
    )


def one_hot(df: DataFrame, column: str, limit: int = 10) -> DataFrame:
    """A 0/1 column per value, for columns of up to ``limit`` values; nulls
    are 0 everywhere.  The values name the new columns, so they are read."""
    values = [r[0] for r in df.select(quoted(column)).filter(quoted(column).isNotNull()).distinct().limit(limit + 1).collect()]
    if len(values) > limit:
        raise ValueError(f"{column} has more than {limit} values: use label_encode")
    return df.withColumns({f"{column}_{v}": F.coalesce((quoted(column) == v).cast("int"), F.lit(0)) for v in sorted(values)})


def label_encode(df: DataFrame, column: str) -> DataFrame:
    """Add ``<column>_encoded``: the value's position in alphabetical order.
    Values are numbered by a distributed rank, however many there are."""
    values = df.select(quoted(column).alias(column)).filter(quoted(column).isNotNull()).distinct().withColumn("_all", F.lit(0))
    codes = rank_in_group(values, "_all", [quoted(column)]).select(quoted(column), (F.col("rank") - 1).alias(f"{column}_encoded"))
    return lookup(df, codes, column)


def _moments(df: DataFrame, columns: list[str]) -> Column:
    cells = []
    for i, c in enumerate(columns):
        value = quoted(c).cast("double")
        cells.append(
            F.struct(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.min(value).alias("low"), F.max(value).alias("high")).alias(f"c{i}")
        )
    return df.agg(F.struct(*cells)).scalar()


def standard_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    """z-scores with the population deviation; a constant column becomes 0,
    missing values are null."""
    df = without_nan(df)
    scaled = {
        c: (quoted(c).cast("double") - F.col(f"_s.c{i}.mean")) / F.when(F.col(f"_s.c{i}.std") > 0, F.col(f"_s.c{i}.std")).otherwise(1.0)
        for i, c in enumerate(columns)
    }
    return df.withColumn("_s", _moments(df, columns)).withColumns(scaled).drop("_s")


def minmax_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    """To the range 0..1; a constant column becomes 0, missing values are
    null."""
    df = without_nan(df)
    scaled = {}
    for i, c in enumerate(columns):
        low, high = F.col(f"_s.c{i}.low"), F.col(f"_s.c{i}.high")
        scaled[c] = (quoted(c).cast("double") - low) / F.when(high > low, high - low).otherwise(1.0)
    return df.withColumn("_s", _moments(df, columns)).withColumns(scaled).drop("_s")


def dedupe(df: DataFrame) -> DataFrame:
    """Each distinct row once; copies collapse before the shuffle."""
    return df.dropDuplicates()
