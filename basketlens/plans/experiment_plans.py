"""A/B tests on the event stream: a user's variant by hash, a purchase event
as conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.operators import experiments
from basketlens.plans.base import Plan, rounded
from basketlens.sources.star_schema import read_table
from basketlens.streaming import conversions as stream

VARIANTS = ["control", "treatment"]
EXPERIMENTS = ["ranking_v2", "checkout_v1"]


def tracked(events: DataFrame, names: list[str]) -> DataFrame:
    """(event_id, ts, experiment, variant, converted, value)."""
    rows = events.select(
        "event_id",
        "ts",
        "user_id",
        (F.col("event_type") == "purchase").alias("converted"),
        "value",
        F.explode(F.array(*[F.lit(n) for n in names])).alias("experiment"),
    )
    return experiments.assign_variant(rows, F.col("experiment"), VARIANTS)


def _conversions(names):
    def load(spark, folder):
        return tracked(read_table(spark, folder, "events"), names)

    return load


def _assign(spark, folder):
    users = read_table(spark, folder, "events").select("user_id").distinct()
    return experiments.assign_variant(users, EXPERIMENTS[0], ["a", "b", "c"])


def _results(spark, folder):
    return rounded(experiments.experiment_results(_conversions(EXPERIMENTS[:1])(spark, folder), [*VARIANTS, "unused"]), 4)


def _significance(spark, folder):
    results = experiments.experiment_results(_conversions(EXPERIMENTS[:1])(spark, folder), VARIANTS)
    return rounded(experiments.significance(results, *VARIANTS).drop("experiment"), 6)


def _report(spark, folder):
    return rounded(experiments.experiment_report(_conversions(EXPERIMENTS)(spark, folder), VARIANTS), 4)


def _stream(spark, folder):
    schema = read_table(spark, folder, "events").schema
    events = stream.event_stream(spark, folder, schema, "events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    results = stream.run_to_table(stream.windowed_results(tracked(events, EXPERIMENTS)))
    day = F.col("window_start").cast("date").alias("day")
    return rounded(results.select(day, "experiment", "variant", "users", "conversions", "total_value"), 4)


def variant_sql(user: str, experiment: str, n: int) -> str:
    """The hash index in SQL, folded like the Spark expression."""
    digest = f"md5(CAST({user} AS VARCHAR) || '_' || {experiment})"
    index = "CAST(0 AS BIGINT)"
    for piece in range(4):
        index = f"(({index} * 4294967296 + CAST('0x' || substr({digest}, {1 + 8 * piece}, 8) AS BIGINT)) % {n})"
    return index


def tracked_sql(names: list[str]) -> str:
    rows = ", ".join(f"('{n}')" for n in names)
    return f"""SELECT event_id, ts, experiment, ['control', 'treatment'][{variant_sql('user_id', 'experiment', 2)} + 1] AS variant,
        event_type = 'purchase' AS converted, "value" FROM events, (VALUES {rows}) x(experiment)"""


def results_sql(names: list[str], variants: list[str], digits: int = 4) -> str:
    listed = ", ".join(f"('{v}')" for v in variants)
    experiments_ = ", ".join(f"('{n}')" for n in names)
    return f"""SELECT experiment, variant, coalesce(users, 0) AS users, coalesce(conversions, 0) AS conversions,
        round(coalesce(conversion_rate, 0), {digits}) AS conversion_rate, round(coalesce(avg_value, 0), {digits}) AS avg_value,
        round(coalesce(total_value, 0), {digits}) AS total_value FROM (SELECT experiment, variant FROM (VALUES {experiments_}) e(experiment),
        (VALUES {listed}) v(variant)) LEFT JOIN (SELECT experiment, variant, count(*) AS users,
        count(*) FILTER (WHERE converted) AS conversions, avg(CAST(converted AS INTEGER)) AS conversion_rate,
        avg("value") AS avg_value, CAST(sum(CAST("value" AS DECIMAL(28,6))) AS DOUBLE) AS total_value FROM ({tracked_sql(names)})
        GROUP BY ALL) USING (experiment, variant)"""


def test_sql(names: list[str]) -> str:
    """z-test per experiment.  DuckDB has no normal distribution either: the
    tail is summed by Simpson's rule."""
    steps = 4000
    return f"""SELECT *, 2 * (SELECT sum(w * exp(-x * x / 2)) * h / 3 / sqrt(2 * pi()) FROM (SELECT abs(z) + i * h AS x, h,
        CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w FROM (SELECT unnest(range(0, {steps + 1})) AS i,
        10.0 / {steps} AS h)) GROUP BY h) AS p FROM (SELECT *, (rate_b - rate_a) / se AS z FROM (SELECT *, sqrt(pool * (1 - pool)
        * (1.0 / n_a + 1.0 / n_b)) AS se FROM (SELECT experiment, n_a, n_b, CAST(x_a AS DOUBLE) / n_a AS rate_a,
        CAST(x_b AS DOUBLE) / n_b AS rate_b, CAST(x_a + x_b AS DOUBLE) / (n_a + n_b) AS pool FROM (SELECT experiment,
        count(*) FILTER (WHERE variant = 'control') AS n_a, count(*) FILTER (WHERE variant = 'treatment') AS n_b,
        count(*) FILTER (WHERE variant = 'control' AND converted) AS x_a,
        count(*) FILTER (WHERE variant = 'treatment' AND converted) AS x_b FROM ({tracked_sql(names)}) GROUP BY experiment))))"""


PLANS = {
    "assign_variant": Plan(
        _assign, f"SELECT DISTINCT user_id, ['a', 'b', 'c'][{variant_sql('user_id', repr(EXPERIMENTS[0]), 3)} + 1] AS variant FROM events"
    ),
    "experiment_results": Plan(_results, results_sql(EXPERIMENTS[:1], [*VARIANTS, "unused"])),
    "significance": Plan(
        _significance,
        f"""SELECT 'control' AS variant_a, 'treatment' AS variant_b, n_a, n_b, round(rate_a, 6) AS rate_a, round(rate_b, 6) AS rate_b,
        round((rate_b - rate_a) / rate_a * 100, 6) AS uplift_percent, round(z, 6) AS z_score, round(p, 6) AS p_value,
        p < 0.05 AS is_significant, round(rate_b - rate_a - 1.96 * se, 6) AS ci_lower, round(rate_b - rate_a + 1.96 * se, 6) AS ci_upper,
        CAST(NULL AS VARCHAR) AS note FROM ({test_sql(EXPERIMENTS[:1])})""",
    ),
    "experiment_report": Plan(
        _report,
        f"""SELECT r.*, round((rate_b - rate_a) / rate_a * 100, 4) AS uplift_percent, round(z, 4) AS z_score, round(p, 4) AS p_value,
        p < 0.05 AS is_significant, CAST(NULL AS VARCHAR) AS note FROM ({results_sql(EXPERIMENTS, VARIANTS)}) r
        JOIN ({test_sql(EXPERIMENTS)}) t USING (experiment)""",
    ),
    "conversions_stream": Plan(
        _stream,
        f"""SELECT CAST(ts AS DATE) AS day, experiment, variant, count(*) AS users, count(*) FILTER (WHERE converted) AS conversions,
        round(CAST(sum(CAST("value" AS DECIMAL(28,6))) AS DOUBLE), 4) AS total_value FROM ({tracked_sql(EXPERIMENTS)}) GROUP BY ALL""",
    ),
}
