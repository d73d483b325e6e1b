"""Run parameters and the business constants of the layered model."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal

# --- Fixed values: thresholds, labels and lookup lists that results must agree on. -------------

TAX_RATE = Decimal("0.18")
HIGH_RATING = 4.0
HOME_COUNTRY = "IN"
EMAIL_PATTERN = r"^[^@]+@[^@]+\.[^@]+$"

PRICE_BUCKETS = ([(20, "low"), (50, "medium")], "high")
PRICE_TIERS = ([(10, "Budget"), (50, "Mid-Range"), (100, "Premium")], "Luxury")
TENURE_BUCKETS = ([(30, "New"), (180, "Regular"), (365, "Loyal")], "Champion")
LOW_STOCK = 20
STOCK_LABELS = ("out_of_stock", "low_stock", "in_stock")

CATEGORY_GROUPS = {
    "Electronics": ["electronics", "gadgets", "tech"],
    "Footwear": ["footwear", "shoes", "sandals"],
    "Sports & Fitness": ["sports", "fitness", "outdoor"],
    "Kitchen": ["kitchen", "cookware", "appliances"],
}
REGIONS = {
    "Asia": ["IN", "SG", "JP", "CN"],
    "North America": ["US", "CA"],
    "Europe": ["UK", "DE", "FR", "IT"],
    "Oceania": ["AU", "NZ"],
}
SEASONS = {"Winter": [12, 1, 2], "Spring": [3, 4, 5], "Summer": [6, 7, 8]}
LAST_SEASON = "Autumn"
OTHER = "Other"
WEEKEND_DAYS = [1, 7]  # Sunday and Saturday when Sunday is day 1

LOAD_MODES = {
    "orders": {"mode": "incremental", "mark_col": "order_date", "pk": "order_id"},
    "products": {"mode": "full_load", "mark_col": None, "pk": "product_id"},
    "customers": {"mode": "incremental", "mark_col": "updated_at", "pk": "customer_id"},
}
#: Folders that incremental runs rewrite one by one, by the columns they derive from. The letters keep
#: text from being read back as numbers or dates.
LOAD_FOLDERS = {
    "orders": {"month_folder": "concat('m', coalesce(date_format(order_date, 'yyyy-MM'), '-'))"},
    "customers": {"country_folder": "concat('c-', coalesce(lower(trim(country)), ''))"},
}
PARTITION_COLUMNS = {
    "orders": ["order_year", "order_month"],
    "products": ["category"],
    "customers": ["country"],
}
ZORDER_COLUMNS = {
    "orders": ["order_id", "product_id", "category"],
    "products": ["product_id", "category"],
    "customers": ["customer_id", "country", "region"],
}
DATE_RANGE = (dt.date(2024, 1, 1), dt.date(2026, 12, 31))

# --- Bounds that decide between plans. ---------------------------------------------------------

ROWS_PER_TASK = 4_000_000  # largest window group that one task sorts; beyond it the group is sliced
BROADCAST_BYTES = 10 * 1024 * 1024  # measured size up to which a side is broadcast
FILE_BYTES = 128 * 1024 * 1024  # target size of a rewritten file
SKETCH_BITS = 12  # 4096 registers of a distinct-count sketch: a standard error of 1.6 %


@dataclass(frozen=True)
class Run:
    """What one run of the layers depends on besides its tables."""

    as_of: dt.date | None = None  # None: the current date
    ts: dt.datetime | None = None  # None: the current timestamp
    name: str = "tierline"
    env: str = "dev"
    database_prefix: str = "ecommerce"
    rows_per_task: int = ROWS_PER_TASK
    validate_first: bool = False

    def database(self, layer: str) -> str:
        return f"{self.database_prefix}_{layer}_{self.env}"

    def table(self, layer: str, name: str) -> str:
        return f"{self.database(layer)}.{name}"
