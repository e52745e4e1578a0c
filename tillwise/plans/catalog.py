"""The six tables and seven views as names that SQL can use."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from tillwise.plans import views


def all_views(tables: dict[str, DataFrame], as_of: datetime | str | None = None
              ) -> dict[str, DataFrame]:
    """The views by their SQL names; no job runs until one is read."""
    t = tables
    return {
        "v_revenue_by_region": views.revenue_by_region(t["orders"], t["clients"]),
        "v_inactive_clients": views.inactive_clients(t["orders"], t["clients"], as_of),
        "v_top_products": views.top_products(t["order_items"], t["products"], t["orders"]),
        "v_recurring_incidents": views.recurring_incidents(t["incidents"]),
        "v_navigation_funnel": views.navigation_funnel(t["page_views"]),
        "v_weekly_kpis": views.weekly_kpis(t["orders"]),
        "v_client_360": views.client_360(t["clients"], t["orders"], t["incidents"],
                                         t["page_views"]),
    }


def register(tables: dict[str, DataFrame], as_of: datetime | str | None = None) -> None:
    """Create or replace a temporary view for every table and every standing view."""
    for name, df in {**tables, **all_views(tables, as_of)}.items():
        df.createOrReplaceTempView(name)
