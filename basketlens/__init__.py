"""Retail analytics as Spark jobs: KPIs, customer features, baskets,
recommendations, churn, experiments and table profiling."""

from basketlens.dataset import Dataset
from basketlens.sources.retail_files import load_dataset
from basketlens.sources.star_schema import load_star_schema

__all__ = ["Dataset", "load_dataset", "load_star_schema"]
