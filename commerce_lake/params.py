"""Business parameters shared by every model and analysis."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from decimal import Decimal

# Window, statuses, bounds and thresholds the results depend on.
ORDER_STATUSES = (
    "delivered", "shipped", "canceled", "unavailable",
    "invoiced", "processing", "created", "approved",
)
REVENUE_STATUSES = ("delivered", "shipped", "invoiced", "processing")
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
DASHBOARD_CATEGORIES = ("auto", "electronics", "drinks", "food", "baby")


@dataclass(frozen=True)
class Params:
    dataset_start: date = date(2016, 9, 1)
    dataset_end: date = date(2018, 12, 31)
    last_complete_month: date = date(2018, 8, 1)
    trend_start: date = date(2016, 10, 1)
    cohort_cutoff: date = date(2018, 6, 30)
    revenue_statuses: tuple[str, ...] = REVENUE_STATUSES
    latitude_bounds: tuple[int, int] = (-35, 6)
    longitude_bounds: tuple[int, int] = (-75, -34)
    payment_tolerance: Decimal = Decimal("0.01")
    plausible_delivery_days: int = 180
    category_min_customers: int = 500
    state_min_customers: int = 1000
    late_month_pct: float = 10.0
    repeat_targets: tuple[float, ...] = (0.04, 0.05, 0.06)
    dashboard_categories: tuple[str, ...] = DASHBOARD_CATEGORIES
    top_cities: int = 10
    pareto_cities: int = 20
    tail_orders: int = 5
    head_sizes: tuple[int, ...] = (1, 5, 10, 25, 50, 100)
    order_count_band: tuple[int, int] = (90_000, 110_000)
    installment_band: tuple[int, int] = (1, 24)
