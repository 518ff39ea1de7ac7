import datetime as dt
import itertools

import pytest

from basketlens.dataset import Dataset
from basketlens.session import build_session
from basketlens.sources.retail_files import SCHEMAS


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    """Make every table too large to broadcast by size."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.fixture
def shop(spark):
    """A data set from short rows: orders (id, customer, time[, status]),
    items (order, product, price), products (id, category), customers
    (id, person)."""

    def make(orders=(), items=(), products=(), customers=(), reviews=()):
        def table(name, rows, columns):
            schema = SCHEMAS[name]
            keep = [f for f in schema.fields if f.name in columns]
            ordered = sorted(keep, key=lambda f: columns.index(f.name))
            return spark.createDataFrame(list(rows), type(schema)(ordered))

        full = [(o[0], o[1], dt.datetime.fromisoformat(o[2]), o[3] if len(o) > 3 else "delivered") for o in orders]
        priced = [(o, p, as_money(v), as_money(0)) for o, p, v in items]
        return Dataset(
            orders=table("orders", full, ["order_id", "customer_id", "order_purchase_timestamp", "order_status"]),
            order_items=table("order_items", priced, ["order_id", "product_id", "price", "freight_value"]),
            products=table("products", products, ["product_id", "product_category_name"]),
            customers=table("customers", [(c, p, "SP") for c, p in customers], ["customer_id", "customer_unique_id", "customer_state"]),
            reviews=table("reviews", reviews, ["order_id", "review_score"]),
        )

    return make


def as_money(value):
    from decimal import Decimal

    return None if value is None else Decimal(str(value)).quantize(Decimal("0.01"))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def one(df):
    found = df.collect()
    assert len(found) == 1
    return found[0].asDict()


def brute_pairs(lines, least):
    """Pair counts of (basket, item, n) rows by listing them all."""
    baskets, counts = {}, {}
    for basket, item, n in lines:
        baskets.setdefault(basket, []).append((item, n))
    for held in baskets.values():
        for (a, x), (b, y) in itertools.combinations(sorted(held), 2):
            counts[a, b] = counts.get((a, b), 0) + x * y
    return sorted(((a, b, n) for (a, b), n in counts.items() if n >= least), key=repr)
