"""Profile, quality score and improvement plan of any table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.functions.ordering import exact_quantiles, top_per_group
from basketlens.functions.scalars import numeric_columns, percent, quoted, ratio, text_columns, total_of, without_nan
from basketlens.operators.kpis import column_moments

LISTED_VALUES = 10  # fixed value: distinct values up to which a profile lists them
LOW_CARDINALITY = 20  # fixed value: distinct values up to which the top ones are shown

# Score limits of the ratings, best first.
RATINGS = [(90, "EXCELLENT"), (75, "GOOD"), (60, "FAIR"), (40, "POOR")]
WORST_RATING = "CRITICAL"

# Fixed value: what text must look like to be a number.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
DATE_WORDS = ("date", "time")  # fixed values: parts of names of date columns


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _per_column(df: DataFrame, columns: list[str], cells: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """One aggregate pass, then one row per column.  ``cells`` maps a name to
    a function of the column expression."""
    structs = [
        F.struct(F.lit(c).alias("column"), *[make(quoted(c)).alias(name) for name, make in cells.items()]) for c in columns
    ]
    return df.agg(F.array(*structs).alias("cells")).select(F.inline("cells"))


def text_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (column, value) of the text columns, without nulls."""
    cells = [F.struct(F.lit(c).alias("column"), quoted(c).alias("value")) for c in columns]
    return df.select(F.inline(F.array(*cells))).filter(F.col("value").isNotNull())


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n_distinct) of text columns.  A value travels as its 16-byte
    digest, and each task sends a digest once, so neither long texts nor
    heavily repeated ones are shuffled."""
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, n_distinct bigint")
    cells = [F.struct(F.lit(c).alias("column"), F.unhex(F.md5(quoted(c))).alias("digest")) for c in columns]
    digests = df.select(F.inline(F.array(*cells))).filter(F.col("digest").isNotNull()).distinct()
    return digests.groupBy("column").agg(F.count("*").alias("n_distinct"))


def value_lists(df: DataFrame, columns: list[str], counts: DataFrame, limit: int) -> DataFrame:
    """(column, value, n) for the columns with at most ``limit`` distinct values."""
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, value string, n bigint")
    few = counts.filter(F.col("n_distinct") <= limit).select("column")
    # one row per column on the right
    values = text_values(df, columns).join(F.broadcast(few), "column", "left_semi")
    return values.groupBy("column", "value").agg(F.count("*").alias("n"))


def profile_columns(df: DataFrame, approx: bool = False) -> DataFrame:
    """Type, nulls, distinct values and range of each column.  ``approx``
    estimates distinct values by a sketch and reads the table once."""
    if approx:
        from basketlens.operators import sketches

        return sketches.profile_of(sketches.profile_sketch(df))
    df = without_nan(df)
    texts, numbers = text_columns(df), numeric_columns(df)
    types = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(t).alias("type")) for i, (c, t) in enumerate(df.dtypes)]
    kinds = df.sparkSession.range(0, 1, 1, 1).select(F.inline(F.array(*types)))
    nulls = _per_column(df, df.columns, {"rows": lambda c: F.count(F.lit(1)), "non_null": F.count})
    counts = distinct_counts(df, texts)
    listed = value_lists(df, texts, counts, LISTED_VALUES).groupBy("column").agg(F.array_sort(F.collect_list("value")).alias("values"))
    profile = kinds.join(nulls, "column").join(counts, "column", "left").join(listed, "column", "left")
    if numbers:
        ranges = column_moments(df, numbers).select(
            "column", F.col("min").alias("min_value"), F.col("max").alias("max_value"), F.col("mean").alias("mean_value")
        )
    else:
        ranges = df.sparkSession.createDataFrame([], "column string, min_value double, max_value double, mean_value double")
    missing = F.col("rows") - F.col("non_null")
    same = F.size(F.filter(F.array(*[F.lit(t) for _, t in df.dtypes]), lambda t: t == F.col("type")))
    return profile.join(ranges, "column", "left").select(
        "column",
        "type",
        same.alias("columns_of_type"),
        "rows",
        "non_null",
        missing.alias("missing"),
        F.coalesce(percent(missing, F.col("rows")), F.lit(0.0)).alias("missing_pct"),
        F.when(F.col("column").isin(texts), F.coalesce("n_distinct", F.lit(0))).alias("n_distinct"),
        F.array_join("values", "|").alias("listed_values"),
        "min_value",
        "max_value",
        "mean_value",
    )


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def sample_rows(df: DataFrame, order: list[str], n: int = 3) -> DataFrame:
    """The first rows in a given order."""
    return df.orderBy(*order).limit(n)


def iqr_bounds(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, q1, q3, lower, upper): the fences 1.5 IQR beyond the quartiles."""
    found = exact_quantiles(df, columns, [0.25, 0.75])
    q1, q3 = F.get("quantiles", F.lit(0)), F.get("quantiles", F.lit(1))
    return found.select("column", q1.alias("q1"), q3.alias("q3")).select(
        "*", (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("lower"), (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("upper")
    )


def iqr_outliers(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Fences, number, share and range of the outliers of each numeric column."""
    df = without_nan(df)
    columns = columns or numeric_columns(df)
    if not columns:
        return df.sparkSession.createDataFrame(
            [],
            "column string, q1 double, q3 double, lower double, upper double, outliers bigint, outlier_pct double, "
            "min_outlier double, max_outlier double",
        )
    cells = [F.struct(F.lit(c).alias("column"), quoted(c).cast("double").alias("x")) for c in columns]
    values = df.select(F.inline(F.array(*cells)))
    # one row per column on the right
    placed = values.join(F.broadcast(iqr_bounds(df, columns)), "column")
    beyond = (F.col("x") < F.col("lower")) | (F.col("x") > F.col("upper"))
    return placed.groupBy("column", "q1", "q3", "lower", "upper").agg(
        F.count_if(beyond).alias("outliers"),
        percent(F.count_if(beyond), F.count("*")).alias("outlier_pct"),
        F.min(F.when(beyond, F.col("x"))).alias("min_outlier"),
        F.max(F.when(beyond, F.col("x"))).alias("max_outlier"),
    )


def categorical_summary(df: DataFrame, top: int = 10) -> DataFrame:
    """Distinct values per text column, with the most frequent values of
    columns that have few of them."""
    texts = text_columns(df)
    counts = distinct_counts(df, texts)
    rows = total_of(df, F.count("*"))
    listed = value_lists(df, texts, counts, LOW_CARDINALITY)
    best = top_per_group(listed, ["column"], [F.desc("n"), F.asc("value")], top)
    return counts.join(best, "column", "left").select(
        "column", "n_distinct", "rank", "value", "n", percent(F.col("n"), rows).alias("pct")
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that equal an earlier row (nulls are equal), in number and share.

    Texts are compared by digest; copies collapse before the shuffle.
    """
    texts = set(text_columns(df))
    keys = [F.unhex(F.md5(quoted(c))).alias(c) if c in texts else quoted(c) for c in df.columns]
    distinct = df.select(*keys).groupBy(*[quoted(c) for c in df.columns]).agg(F.count("*").alias("_copies"))
    found = distinct.agg(F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"), F.count("*").alias("distinct_rows"))
    extra = F.col("rows") - F.col("distinct_rows")
    return found.select("rows", extra.alias("duplicates"), F.coalesce(percent(extra, F.col("rows")), F.lit(0.0)).alias("duplicate_pct"))


def _named_as_date(column: str) -> bool:
    return any(word in column.lower() for word in DATE_WORDS)


def _severity(pct: Column, high: float, medium: float) -> Column:
    return F.when(pct > high, "HIGH").when(pct > medium, "MEDIUM").otherwise("LOW")


def _issue(df: DataFrame, issue: str, column: Column, severity: Column, detail: Column, impact: Column) -> DataFrame:
    return df.select(
        F.lit(issue).alias("issue"),
        column.cast("string").alias("column_name"),
        severity.alias("severity"),
        detail.cast("double").alias("detail_value"),
        impact.cast("double").alias("impact"),
    )


def quality_issues(df: DataFrame) -> DataFrame:
    """One row per issue: (issue, column_name, severity, detail_value, impact).
    The impact is what the issue takes off a score of 100; names, severities
    and limits of impact are fixed values."""
    df = without_nan(df)
    texts, numbers = text_columns(df), numeric_columns(df)
    whole = F.lit(None)
    found = []

    nulls = _per_column(df, df.columns, {"rows": lambda c: F.count(F.lit(1)), "missing": lambda c: F.count_if(c.isNull())})
    missing = nulls.agg(percent(F.sum("missing"), F.sum("rows")).alias("pct")).filter("pct > 0")
    pct = F.col("pct")
    found.append(_issue(missing, "Missing Values", whole, _severity(pct, 20, 5), pct, -F.least(pct, F.lit(30))))

    copies = duplicate_rows(df).filter("duplicates > 0")
    pct = F.col("duplicate_pct")
    found.append(_issue(copies, "Duplicate Rows", whole, _severity(pct, 10, 1), pct, -F.least(2 * pct, F.lit(20))))

    if texts:
        medium, five = F.lit("MEDIUM"), F.lit(-5)
        looks = {
            "numeric": (texts, lambda c: c.rlike(NUMBER_PATTERN)),
            "temporal": ([c for c in texts if _named_as_date(c)], lambda c: F.try_to_timestamp(c).isNotNull()),
        }
        for columns, test in looks.values():
            if columns:
                passed = _per_column(df, columns, {"passed": lambda c, test=test: F.bool_and(c.isNull() | test(c))}).filter("passed")
                found.append(_issue(passed, "Incorrect Data Type", F.col("column"), medium, whole, five))

        counts = distinct_counts(df, texts).withColumn("unique_ratio", ratio(F.col("n_distinct"), total_of(df, F.count("*"))))
        wide = counts.filter((F.col("unique_ratio") > 0.5) & (F.col("n_distinct") > 100))
        found.append(
            _issue(wide, "High Cardinality", F.col("column"), F.lit("LOW"), F.col("unique_ratio") * 100, F.lit(-5))
        )

    if numbers:
        cells = total_of(df, F.count("*")) * len(df.columns)
        outliers = iqr_outliers(df, numbers).agg(percent(F.sum("outliers"), cells).alias("pct")).filter("pct > 0")
        pct = F.col("pct")
        found.append(_issue(outliers, "Outliers Detected", whole, _severity(pct, 5, 1), pct, -F.least(2 * pct, F.lit(15))))
        flat = column_moments(df, numbers).filter((F.col("count") > 0) & (F.col("min") == F.col("max")))
        found.append(_issue(flat, "Zero Variance", F.col("column"), F.lit("MEDIUM"), F.col("min"), F.lit(-10)))
    return _union(found)


def quality_score(df: DataFrame) -> DataFrame:
    """Score 0..100, rating and number of issues."""
    summed = quality_issues(df).agg(F.coalesce(F.sum("impact"), F.lit(0.0)).alias("impact"), F.count("*").alias("n_issues"))
    score = F.greatest(F.lit(0.0), 100 + F.col("impact"))
    rating = F.lit(WORST_RATING)
    for least, name in reversed(RATINGS):
        rating = F.when(score >= least, name).otherwise(rating)
    return summed.select(score.alias("score"), rating.alias("rating"), "n_issues")


def improvement_plan(df: DataFrame) -> DataFrame:
    """(column_name, problem, action) rows; the action names an operator of
    the cleaning module."""
    df = without_nan(df)
    texts, numbers = text_columns(df), numeric_columns(df)
    columns = df.columns
    rows = total_of(df, F.count("*"))
    steps = []

    def step(source: DataFrame, problem: str, action: Column | str, column: Column = F.col("column")) -> None:
        named = F.lit(action) if isinstance(action, str) else action
        steps.append(source.select(column.cast("string").alias("column_name"), F.lit(problem).alias("problem"), named.alias("action")))

    nulls = _per_column(df, columns, {"rows": lambda c: F.count(F.lit(1)), "missing": lambda c: F.count_if(c.isNull())})
    gaps = nulls.filter("missing > 0").withColumn("pct", percent(F.col("missing"), F.col("rows")))
    action = F.when(F.col("pct") > 50, "drop_sparse_columns").when(F.col("column").isin(texts), "impute: Unknown").otherwise("impute: median")
    step(gaps, "missing values", action)

    dated = [c for c in columns if _named_as_date(c)]
    spark = df.sparkSession

    def names(wanted: list[str]) -> DataFrame:
        return spark.range(0, 1, 1, 1).select(F.explode(F.array(*[F.lit(c) for c in wanted]).cast("array<string>")).alias("column"))

    if texts:
        counts = distinct_counts(df, texts)
        every = names(texts).join(counts, "column", "left").na.fill(0, ["n_distinct"])
        step(names([c for c in dated if c in texts]), "text holds dates", "cast_datetimes")
        step(every.filter(ratio(F.col("n_distinct"), rows) < 0.05), "few distinct values", "label_encode: category")
        encode = F.when(F.col("n_distinct") <= LISTED_VALUES, "one_hot").otherwise("label_encode")
        step(every, "categorical encoding", encode)
    if numbers:
        step(iqr_outliers(df, numbers).filter("outliers > 0"), "outliers", "winsorize or remove_outliers")
        step(names(numbers), "scaling", "standard_scale or minmax_scale")
    step(duplicate_rows(df).filter("duplicates > 0"), "duplicate rows", "dedupe", F.lit(None))
    step(names(dated), "date parts", "date_features")
    return _union(steps)
