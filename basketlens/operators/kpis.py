"""Business KPIs, summaries and distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketlens.dataset import Dataset
from basketlens.functions.joins import lookup
from basketlens.functions.ordering import exact_quantiles
from basketlens.functions.scalars import month_of, numeric_columns, percent, quoted, ratio, total_of, without_nan
from basketlens.functions.scalars import whole_days
from basketlens.operators.facts import category_of_product, order_values, person_of_customer

GOOD_REPORT_LIMIT = 1000  # fixed value: a report with fewer nulls is "Good"


def shares(df: DataFrame, key: str | Column, name: str | None = None) -> DataFrame:
    """(key, n, pct) of the non-null values of ``key``."""
    column = F.col(key) if isinstance(key, str) else key
    named = column.alias(name or key)
    counts = df.select(named).filter(F.col(name or key).isNotNull()).groupBy(name or key).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", percent(F.col("n"), total_of(counts, F.sum("n"))))


def orders_per_person(ds: Dataset) -> DataFrame:
    """(customer_unique_id, orders).  Counted per customer id before the
    person is looked up, so that a busy customer is one row in the join."""
    per_id = ds.orders.groupBy("customer_id").agg(F.count("*").alias("orders"))
    per_person = per_id.join(person_of_customer(ds), "customer_id").filter(F.col("customer_unique_id").isNotNull())
    return per_person.groupBy("customer_unique_id").agg(F.sum("orders").alias("orders"))


def dataset_stats(ds: Dataset) -> DataFrame:
    """Sizes and date range of the data set, in one row."""
    order_facts = ds.orders.agg(
        F.count("*").alias("total_orders"),
        F.min("order_purchase_timestamp").cast("date").alias("first_date"),
        F.max("order_purchase_timestamp").cast("date").alias("last_date"),
    )
    return order_facts.select(
        "total_orders",
        total_of(ds.customers, F.count_distinct("customer_unique_id")).alias("total_customers"),
        total_of(ds.products, F.count("*")).alias("total_products"),
        total_of(ds.products, F.count_distinct("product_category_name")).alias("total_categories"),
        "first_date",
        "last_date",
    )


def kpi_summary(ds: Dataset) -> DataFrame:
    values = order_values(ds).agg(
        F.struct(F.sum("order_value").alias("gmv"), ratio(F.sum("order_value"), F.count("order_value")).alias("aov"))
    ).scalar()
    orders = ds.orders.agg(
        F.count("*").alias("total_orders"), F.count_if(F.col("order_status") == ds.delivered_status).alias("delivered")
    )
    return orders.select(
        "total_orders",
        total_of(ds.customers, F.count_distinct("customer_unique_id")).alias("total_customers"),
        values["gmv"].cast("double").alias("total_gmv"),
        values["aov"].alias("avg_order_value"),
        percent(F.col("delivered"), F.col("total_orders")).alias("delivery_rate"),
    )


def repeat_purchase(ds: Dataset) -> DataFrame:
    per_person = orders_per_person(ds)
    counted = per_person.agg(
        F.count("*").alias("total_customers"),
        F.count_if(F.col("orders") > 1).alias("repeat_customers"),
        F.sum("orders").alias("orders"),
        F.max("orders").alias("max_orders_per_customer"),
    )
    total = F.col("total_customers")
    return counted.select(
        "total_customers",
        "repeat_customers",
        (total - F.col("repeat_customers")).alias("one_time_customers"),
        percent(F.col("repeat_customers"), total).alias("repeat_purchase_rate"),
        ratio(F.col("orders"), total).alias("avg_orders_per_customer"),
        "max_orders_per_customer",
    )


def order_count_distribution(ds: Dataset) -> DataFrame:
    """People per number of orders, with the single : repeat ratio."""
    per_person = orders_per_person(ds)
    counts = per_person.groupBy("orders").agg(F.count("*").alias("customers"))
    split = per_person.agg(
        F.struct(F.count_if(F.col("orders") == 1).alias("single"), F.count_if(F.col("orders") > 1).alias("repeat"))
    ).scalar()
    return counts.select(
        "orders",
        "customers",
        percent(F.col("customers"), split["single"] + split["repeat"]).alias("pct"),
        ratio(split["single"], split["repeat"]).alias("imbalance_ratio"),
    )


def top_categories(ds: Dataset, n: int = 10) -> DataFrame:
    """Orders, items, revenue and mean price of the ``n`` largest categories.

    Items are first added up per category and order, so that distinct orders
    become a plain count and the second step moves few rows.
    """
    items = lookup(
        ds.order_items.select("order_id", "product_id", "price"), category_of_product(ds, translated=True), "product_id"
    ).filter(F.col("category").isNotNull())
    per_order = items.groupBy("category", "order_id").agg(
        F.count("*").alias("items"), F.count("price").alias("priced"), F.sum("price").alias("gmv")
    )
    totals = per_order.groupBy("category").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("items").alias("total_items"),
        F.sum("gmv").alias("gmv"),
        ratio(F.sum("gmv"), F.sum("priced")).alias("avg_price"),
    )
    best = totals.orderBy(F.desc("gmv"), "category").limit(n)
    return best.select("category", "total_orders", "total_items", F.col("gmv").cast("double").alias("total_gmv"), "avg_price")


def category_revenue(ds: Dataset, n: int = 15) -> DataFrame:
    """Revenue of the ``n`` largest raw categories.  Items are added up per
    product before the category is looked up."""
    per_product = ds.order_items.groupBy("product_id").agg(F.sum("price").alias("revenue"))
    named = per_product.join(category_of_product(ds), "product_id").filter(F.col("category").isNotNull())
    totals = named.groupBy("category").agg(F.sum("revenue").alias("revenue"))
    return totals.orderBy(F.desc("revenue"), "category").limit(n).select("category", F.col("revenue").cast("double"))


def review_distribution(ds: Dataset) -> DataFrame:
    """Reviews per score, with the mean score on each row."""
    mean = total_of(ds.reviews, ratio(F.sum("review_score"), F.count("review_score")))
    return shares(ds.reviews, "review_score").withColumn("avg_score", mean)


def review_sentiment(ds: Dataset) -> DataFrame:
    score = F.col("review_score")
    counted = ds.reviews.agg(
        F.count("*").alias("total"),
        F.count_if(score >= 4).alias("positive"),
        F.count_if(score == 3).alias("neutral"),
        F.count_if(score <= 2).alias("negative"),
    )
    return counted.select(
        "*", *[percent(F.col(c), F.col("total")).alias(f"{c}_pct") for c in ("positive", "neutral", "negative")]
    )


def order_gaps(ds: Dataset) -> DataFrame:
    """Gaps between orders as one row per person and active day:
    (customer_unique_id, day, n, first_ts, last_ts, gap_days).

    Two orders of one calendar day are less than 24 hours apart, so their
    gap is 0 whole days.  Orders therefore shrink to one row per day before
    the window runs; a person can have only as many rows as there are days.
    """
    ts = F.col("order_purchase_timestamp")
    per_id = ds.orders.filter(ts.isNotNull()).groupBy("customer_id", ts.cast("date").alias("day")).agg(
        F.count("*").alias("n"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )
    per_day = (
        per_id.join(person_of_customer(ds), "customer_id")
        .filter(F.col("customer_unique_id").isNotNull())
        .groupBy("customer_unique_id", "day")
        .agg(F.sum("n").alias("n"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))
    )
    previous = F.lag("last_ts").over(W.partitionBy("customer_unique_id").orderBy("day"))
    return per_day.withColumn("gap_days", whole_days(previous, F.col("first_ts")))


def avg_days_between_orders(ds: Dataset) -> DataFrame:
    """Mean whole days between consecutive orders of one person."""
    gaps = order_gaps(ds).agg(
        F.sum("gap_days").alias("days"),
        (F.sum("n") - F.count("*") + F.count("gap_days")).alias("n_gaps"),
    )
    return gaps.select(
        ratio(F.when(F.col("n_gaps") > 0, F.coalesce("days", F.lit(0))), F.col("n_gaps")).alias("avg_days"),
        F.coalesce("n_gaps", F.lit(0)).alias("n_gaps"),
    )


def customer_summary(ds: Dataset) -> DataFrame:
    """Single and repeat buyers as a share of all known customers."""
    total = total_of(ds.customers, F.count_distinct("customer_unique_id"))
    counted = orders_per_person(ds).agg(
        F.count_if(F.col("orders") == 1).alias("single_customers"),
        F.count_if(F.col("orders") > 1).alias("repeat_customers"),
        ratio(F.sum("orders"), F.count("*")).alias("avg_orders"),
        F.max("orders").alias("max_orders"),
    )
    return counted.withColumn("total_customers", total).select(
        "total_customers",
        "single_customers",
        percent(F.col("single_customers"), F.col("total_customers")).alias("single_pct"),
        "repeat_customers",
        percent(F.col("repeat_customers"), F.col("total_customers")).alias("repeat_pct"),
        "avg_orders",
        "max_orders",
    )


def top_states(ds: Dataset, n: int = 5) -> DataFrame:
    return shares(ds.customers, "customer_state").orderBy(F.desc("n"), "customer_state").limit(n)


def product_summary(ds: Dataset) -> DataFrame:
    """Catalogue size, sales per sold product and products never sold."""
    sales = ds.order_items.groupBy("product_id").agg(F.count("*").alias("n"))
    sold = sales.agg(F.struct(ratio(F.sum("n"), F.count("*")).alias("avg_sales"))).scalar()
    unsold = total_of(ds.products.select("product_id").join(sales, "product_id", "left_anti"), F.count("*"))
    per_category = ds.products.groupBy("product_category_name").agg(F.count("*").alias("n"))
    counted = per_category.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_products"),
        F.count("product_category_name").alias("total_categories"),
        F.max(F.when(F.col("product_category_name").isNotNull(), F.col("n"))).alias("largest"),
    )
    return counted.withColumn("unsold_products", unsold).select(
        "total_products",
        "total_categories",
        sold["avg_sales"].alias("avg_sales_per_product"),
        "unsold_products",
        percent(F.col("unsold_products"), F.col("total_products")).alias("unsold_pct"),
        percent(F.col("largest"), F.col("total_products")).alias("top_category_pct"),
    )


def category_balance(ds: Dataset, n: int = 10) -> DataFrame:
    """Products per category, largest first, as a share of all products."""
    total = total_of(ds.products, F.count("*"))
    counts = ds.products.filter(F.col("product_category_name").isNotNull()).groupBy(
        F.col("product_category_name").alias("category")
    ).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "category").limit(n).withColumn("pct", percent(F.col("n"), total))


def order_status_distribution(ds: Dataset) -> DataFrame:
    """Orders per status, and whether the status means delivered."""
    delivered = F.col("order_status") == ds.delivered_status
    return shares(ds.orders, "order_status").withColumn("delivered", delivered)


def revenue_summary(ds: Dataset) -> DataFrame:
    """Revenue, freight and the three order values in use: per order with
    items, per order of any kind, and per item."""
    per_order = ds.order_items.groupBy("order_id").agg(
        F.sum("price").alias("price"), F.count("price").alias("items"), F.sum("freight_value").alias("freight")
    )
    sums = per_order.agg(
        F.sum("price").alias("revenue"),
        F.sum("freight").alias("freight"),
        F.sum("items").alias("items"),
        F.count("price").alias("orders_with_items"),
    )
    gmv = F.col("revenue") + F.col("freight")
    return sums.withColumn("orders", total_of(ds.orders, F.count("*"))).select(
        F.col("revenue").cast("double").alias("total_revenue"),
        F.col("freight").cast("double").alias("total_freight"),
        gmv.cast("double").alias("gmv"),
        percent(F.col("freight"), gmv).alias("freight_pct"),
        ratio(F.col("revenue"), F.col("orders_with_items")).alias("aov_orders_with_items"),
        ratio(F.col("revenue"), F.col("orders")).alias("aov_all_orders"),
        ratio(F.col("revenue"), F.col("items")).alias("avg_item_price"),
    )


def monthly_orders(ds: Dataset) -> DataFrame:
    """(month, orders) for the months that have orders."""
    ts = F.col("order_purchase_timestamp")
    return ds.orders.filter(ts.isNotNull()).groupBy(month_of(ts).alias("month")).agg(F.count("*").alias("orders"))


def temporal_summary(ds: Dataset) -> DataFrame:
    """Date range and orders per month; the earliest month wins a tie."""
    ts = F.col("order_purchase_timestamp")
    span = ds.orders.agg(F.struct(F.min(ts).alias("first"), F.max(ts).alias("last"))).scalar()
    age = -F.unix_date("month")  # larger for an earlier month
    months = monthly_orders(ds).agg(
        F.count("*").alias("months"),
        ratio(F.sum("orders"), F.count("*")).alias("avg_per_month"),
        F.max(F.struct("orders", age.alias("age"), "month")).alias("most"),
        F.min(F.struct("orders", "month")).alias("least"),
    )
    return months.select(
        span["first"].cast("date").alias("first_date"),
        span["last"].cast("date").alias("last_date"),
        whole_days(span["first"], span["last"]).alias("span_days"),
        "months",
        "avg_per_month",
        F.col("most.month").alias("max_month"),
        F.col("most.orders").alias("max_orders"),
        F.col("least.month").alias("min_month"),
        F.col("least.orders").alias("min_orders"),
    )


def seasonality(ds: Dataset, ts: str = "order_purchase_timestamp", rows: DataFrame | None = None) -> DataFrame:
    """Orders by month of the year and by day of the week, ranked."""
    when = F.col(ts)
    calendar = (rows if rows is not None else ds.orders).filter(when.isNotNull())
    per_day = calendar.groupBy(when.cast("date").alias("day")).agg(F.count("*").alias("n"))
    parts = F.array(
        F.struct(F.lit("month").alias("period"), F.date_format("day", "MMMM").alias("name")),
        F.struct(F.lit("weekday").alias("period"), F.date_format("day", "EEEE").alias("name")),
    )
    counts = per_day.select("n", F.inline(parts)).groupBy("period", "name").agg(F.sum("n").alias("orders"))
    return counts.withColumn("rank", F.row_number().over(W.partitionBy("period").orderBy(F.desc("orders"), "name")))


def describe_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """count, mean, std, min, quartiles and max of each numeric column."""
    columns = columns or numeric_columns(df)
    moments = column_moments(df, columns)
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).select(
        "column", *[F.get("quantiles", F.lit(i)).alias(name) for i, name in enumerate(["p25", "p50", "p75"])]
    )
    return moments.join(quartiles, "column", "left").select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def column_moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, std, min and max per column, in one pass over ``df``."""

    def stats(name: str) -> Column:
        value = F.nanvl(quoted(name).cast("double"), F.lit(None).cast("double"))
        return F.struct(
            F.lit(name).alias("column"),
            F.count(value).alias("count"),
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        )

    return df.agg(F.array(*[stats(c) for c in columns]).alias("stats")).select(F.inline("stats"))


def correlations(df: DataFrame, columns: list[str] | None = None, min_abs: float = 0.0, top: int | None = 10) -> DataFrame:
    """Pearson correlation of each pair of numeric columns, strongest first.
    A row counts for a pair when both values are present."""
    columns = columns or numeric_columns(df)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    if not pairs:
        return df.limit(0).select(
            F.lit("").alias("column_1"), F.lit("").alias("column_2"), F.lit(0.0).alias("correlation")
        )
    cells = [
        F.struct(
            F.lit(a).alias("column_1"),
            F.lit(b).alias("column_2"),
            F.corr(quoted(a).cast("double"), quoted(b).cast("double")).alias("correlation"),
        )
        for a, b in pairs
    ]
    found = df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
    strong = found.filter(F.abs("correlation") >= min_abs)
    ordered = strong.orderBy(F.desc(F.abs("correlation")), "column_1", "column_2")
    return ordered if top is None else ordered.limit(top)


def missing_values(tables: dict[str, DataFrame]) -> DataFrame:
    """Missing (null or NaN) count and share of every column of every table."""
    found = None
    for name, df in tables.items():
        df = without_nan(df)
        nulls = [F.struct(F.lit(c).alias("column"), F.count_if(quoted(c).isNull()).alias("missing")) for c in df.columns]
        one = df.agg(F.count("*").alias("rows"), F.array(*nulls).alias("nulls")).select(
            F.lit(name).alias("table"), "rows", F.inline("nulls")
        )
        found = one if found is None else found.unionByName(one)
    return found.select("table", "column", "rows", "missing", F.coalesce(percent(F.col("missing"), F.col("rows")), F.lit(0.0)).alias("missing_pct"))


def dataset_report(ds: Dataset) -> DataFrame:
    """Table sizes, repeat rate and nulls, with an overall status."""
    checked = {n: t for n, t in ds.tables().items() if n in ("orders", "order_items", "products")}
    nulls = missing_values(checked).agg(F.sum("missing").alias("total_missing"))
    repeat = orders_per_person(ds).agg(percent(F.count_if(F.col("orders") > 1), F.count("*")).alias("rate")).scalar()
    return nulls.select(
        *[
            total_of(getattr(ds, name), F.count("*")).alias(f"{name}_rows")
            for name in ("orders", "order_items", "products", "customers")
        ],
        repeat.alias("repeat_rate"),
        "total_missing",
        F.when(F.col("total_missing") < GOOD_REPORT_LIMIT, "Good").otherwise("Needs attention").alias("status"),
    )
