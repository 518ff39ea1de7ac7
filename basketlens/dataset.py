"""The set of tables every retail operator works on."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Dataset:
    """Retail tables under their logical column names.

    ``customer_id`` in ``orders`` may differ per order; the person is
    ``customers.customer_unique_id``.  A table that is absent is ``None``.
    """

    orders: DataFrame | None = None
    order_items: DataFrame | None = None
    products: DataFrame | None = None
    customers: DataFrame | None = None
    payments: DataFrame | None = None
    reviews: DataFrame | None = None
    sellers: DataFrame | None = None
    category_translation: DataFrame | None = None
    delivered_status: str = "delivered"

    def tables(self) -> dict[str, DataFrame]:
        """The tables that are present, by name."""
        found = {f.name: getattr(self, f.name) for f in fields(self)}
        return {name: df for name, df in found.items() if isinstance(df, DataFrame)}

    def require(self, *names: str) -> None:
        missing = [name for name in names if getattr(self, name) is None]
        if missing:
            raise ValueError(f"tables not loaded: {', '.join(missing)}")

    def with_tables(self, **tables: DataFrame) -> "Dataset":
        """A copy with some tables replaced, e.g. orders cut to a period."""
        return replace(self, **tables)
