"""Customer features: recency/frequency/monetary scores, segments, category
and price behaviour, preferred times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.dataset import Dataset
from basketlens.functions.joins import lookup
from basketlens.functions.ordering import exact_quantiles, global_rank
from basketlens.functions.scalars import ratio, total_of, whole_days
from basketlens.operators.facts import category_of_product, items_with_person, order_values, person_of_customer, purchases
from basketlens.operators.kpis import shares

PERSON = "customer_unique_id"

# Score ranges (recency, frequency, monetary) per segment, in
# the order in which they are tested; None stands for any score.
SEGMENT_RULES = [
    ("Champions", (4, 5), (4, 5), (4, 5)),
    ("Loyal Customers", None, (4, 5), None),
    ("Potential Loyalists", (4, 5), (2, 5), (2, 5)),
    ("New Customers", (4, 5), (1, 1), None),
    ("At Risk", (1, 2), (4, 5), None),
    ("Need Attention", (1, 3), (1, 3), None),
    ("About to Sleep", (1, 2), (1, 2), None),
    ("Can't Lose", (1, 2), None, (4, 5)),
]
OTHER_SEGMENT = "Other"

# Three of the rules above can never apply, because earlier ones cover them.
# In this order the narrower rule comes first.
NARROW_FIRST = [
    "Champions",
    "At Risk",
    "Loyal Customers",
    "Potential Loyalists",
    "New Customers",
    "Can't Lose",
    "About to Sleep",
    "Need Attention",
]


MOST_COLUMNS = 5_000

def orders_by_person(ds: Dataset, *aggregates: tuple[str, Column, str]) -> DataFrame:
    """Aggregate orders per person in two steps, customer id first, so that a
    customer with very many orders is one row when the person is looked up.
    Each aggregate is (name, first step, function of the second step)."""
    per_id = ds.orders.join(order_values(ds), "order_id", "left").groupBy("customer_id").agg(
        *[first.alias(name) for name, first, _ in aggregates]
    )
    per_person = per_id.join(person_of_customer(ds), "customer_id").filter(F.col(PERSON).isNotNull())
    return per_person.groupBy(PERSON).agg(
        *[F.call_function(second, F.col(name)).alias(name) for name, _, second in aggregates]
    )


def rfm(ds: Dataset, reference_date: str | None = None) -> DataFrame:
    """Days since the last order, number of orders and money spent."""
    last = F.max("order_purchase_timestamp")
    per_person = orders_by_person(
        ds, ("last_order", last, "max"), ("frequency", F.count("*"), "sum"), ("monetary", F.sum("order_value"), "sum")
    )
    reference = F.lit(reference_date).cast("timestamp_ntz") if reference_date else total_of(ds.orders, last)
    return per_person.select(
        PERSON,
        whole_days(F.col("last_order"), reference).alias("recency_days"),
        "frequency",
        F.coalesce(F.col("monetary").cast("double"), F.lit(0.0)).alias("monetary"),
    )


def _edges_below(value: str, edges: Column) -> Column:
    """How many of the four inner quintile edges lie below a value."""
    below = [(edges[i] < F.col(value)).cast("int") for i in range(4)]
    return below[0] + below[1] + below[2] + below[3]


def rfm_scores(ds: Dataset, reference_date: str | None = None) -> DataFrame:
    """Quintile scores 1..5: recency (5 is recent) and monetary by value,
    frequency by unique rank with ties in person order."""
    ranked = global_rank(rfm(ds, reference_date), [F.col("frequency"), F.col(PERSON)], "_rank")
    found = exact_quantiles(ranked, ["recency_days", "monetary"], [0.2, 0.4, 0.6, 0.8])
    edges = found.agg(F.map_from_entries(F.collect_list(F.struct("column", "quantiles")))).scalar()
    people = total_of(ranked, F.count("*"))
    position = F.ceil(F.try_divide(5 * (F.col("_rank") - 1), F.col("_people") - 1))
    return (
        ranked.withColumns({"_edges": edges, "_people": people})
        .withColumn("recency_score", 5 - _edges_below("recency_days", F.col("_edges")["recency_days"]))
        .withColumn("frequency_score", F.greatest(F.lit(1), F.coalesce(position, F.lit(1))).cast("int"))
        .withColumn("monetary_score", 1 + _edges_below("monetary", F.col("_edges")["monetary"]))
        .withColumn("rfm_score", F.col("recency_score") * 100 + F.col("frequency_score") * 10 + F.col("monetary_score"))
        .drop("_rank", "_edges", "_people")
    )


def segment_of(recency: Column, frequency: Column, monetary: Column, parity: bool = True) -> Column:
    """The segment of a triple of scores; ``parity=False`` tests narrow rules
    first, so that every segment can occur."""
    rules = {name: ranges for name, *ranges in SEGMENT_RULES}
    order: Sequence[str] = list(rules) if parity else NARROW_FIRST
    chosen = None
    for name in order:
        limits = [s.between(*r) for s, r in zip((recency, frequency, monetary), rules[name]) if r]
        condition = limits[0]
        for limit in limits[1:]:
            condition = condition & limit
        chosen = F.when(condition, name) if chosen is None else chosen.when(condition, name)
    return chosen.otherwise(OTHER_SEGMENT)


def rfm_segments(ds: Dataset, reference_date: str | None = None, parity: bool = True) -> DataFrame:
    scores = rfm_scores(ds, reference_date)
    names = [F.col(f"{part}_score") for part in ("recency", "frequency", "monetary")]
    return scores.withColumn("segment", segment_of(*names, parity=parity))


def segment_counts(segments: DataFrame) -> DataFrame:
    """People per segment and their share."""
    return shares(segments, "segment")


def category_affinity(ds: Dataset) -> DataFrame:
    """(person, category, purchase_count), long form."""
    named = lookup(purchases(ds), category_of_product(ds), "product_id").filter(F.col("category").isNotNull())
    return named.groupBy(PERSON, "category").agg(F.sum("n").alias("purchase_count"))


def category_affinity_wide(ds: Dataset, categories: Sequence[str] | None = None) -> DataFrame:
    """One column per category, 0 where nothing was bought.  The categories
    are those of the product table unless given; more than ``MOST_COLUMNS``
    raise an error, as a table that wide is of no use."""
    if categories is None:
        named = category_of_product(ds).filter(F.col("category").isNotNull()).select("category").distinct()
        categories = sorted(r["category"] for r in named.limit(MOST_COLUMNS + 1).collect())
        if len(categories) > MOST_COLUMNS:
            raise ValueError(f"more than {MOST_COLUMNS} categories; use the long form")
    wide = category_affinity(ds).groupBy(PERSON).pivot("category", list(categories)).agg(F.first("purchase_count"))
    return wide.na.fill(0)


def price_sensitivity(ds: Dataset) -> DataFrame:
    price = F.col("price").cast("double")
    spread = items_with_person(ds).groupBy(PERSON).agg(
        ratio(F.sum("price"), F.count("price")).alias("avg_price"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        F.coalesce(F.stddev_samp(price), F.lit(0.0)).alias("std_price"),
    )
    return spread.withColumn("price_range", F.col("max_price") - F.col("min_price"))


def temporal_preferences(orders: DataFrame, person: str = PERSON, ts: str = "order_purchase_timestamp") -> DataFrame:
    """The most frequent hour, weekday (Monday is 0) and month of each person;
    the smallest on a tie.  Counts every possible value in one aggregate row,
    so one shuffle of one row per person and task is all it takes."""
    parts = {
        "preferred_hour": (F.hour(ts), range(24)),
        "preferred_day_of_week": (F.weekday(ts), range(7)),
        "preferred_month": (F.month(ts), range(1, 13)),
    }
    known = orders.filter(F.col(person).isNotNull() & F.col(ts).isNotNull())
    counted = known.groupBy(person).agg(
        *[F.array(*[F.count_if(part == v) for v in values]).alias(name) for name, (part, values) in parts.items()]
    )
    return counted.select(
        person,
        *[
            (F.array_position(name, F.array_max(name)) - 1 + values.start).cast("int").alias(name)
            for name, (_, values) in parts.items()
        ],
    )


def order_times(ds: Dataset) -> DataFrame:
    """Orders with the person, for ``temporal_preferences``."""
    return lookup(ds.orders.select("customer_id", "order_purchase_timestamp"), person_of_customer(ds), "customer_id")


def customer_features(ds: Dataset, reference_date: str | None = None) -> DataFrame:
    """Scores, segment, price behaviour and preferred times per person."""
    people = rfm_segments(ds, reference_date)
    return people.join(price_sensitivity(ds), PERSON, "left").join(temporal_preferences(order_times(ds)), PERSON, "left")


def customer_feature_lookup(features: DataFrame, people: DataFrame) -> DataFrame:
    """The feature rows of the given people; unknown people give no row."""
    return features.join(people.select(PERSON).distinct(), PERSON, "left_semi")


def customer_lifetime(ds: Dataset) -> DataFrame:
    """Orders, first and last order, lifetime in days and number of distinct
    categories bought, per person."""
    ts = F.col("order_purchase_timestamp")
    spans = orders_by_person(
        ds,
        ("total_orders", F.count("*"), "sum"),
        ("first_purchase", F.min(ts), "min"),
        ("last_purchase", F.max(ts), "max"),
    )
    variety = category_affinity(ds).groupBy(PERSON).agg(F.count("*").alias("unique_categories_purchased"))
    days = whole_days(F.col("first_purchase"), F.col("last_purchase"))
    return spans.join(variety, PERSON, "left").select(
        PERSON,
        "total_orders",
        "first_purchase",
        "last_purchase",
        days.alias("customer_lifetime_days"),
        ratio(days, F.greatest("total_orders", F.lit(1))).alias("avg_days_between_orders"),
        F.coalesce("unique_categories_purchased", F.lit(0)).alias("unique_categories_purchased"),
    )
