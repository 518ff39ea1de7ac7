"""All registered queries."""

from __future__ import annotations

from importlib import import_module

from basketlens.plans.base import Plan

AREAS = ["kpi_plans", "feature_plans", "recommend_plans", "table_plans", "experiment_plans", "churn_plans", "content_plans"]


def all_plans() -> dict[str, Plan]:
    plans: dict[str, Plan] = {}
    for area in AREAS:
        plans.update(import_module(f"basketlens.plans.{area}").PLANS)
    return plans
