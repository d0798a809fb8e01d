"""Scenario parameters and fixed lookup values.

Everything that the reference states as a constant lives here, in plain text,
so operators take them as arguments instead of hard-coding them.
"""
from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's constants for the same results)
# ---------------------------------------------------------------------------

# Decision-rule thresholds.
THRESHOLDS = {
    "overstock_pct_min": 0.20,
    "stockout_days_max": 14,
    "return_rate_delta_min": 0.05,
    "revenue_at_risk_min": 1_000_000,
    "cohort_lift_min": 1.5,
}

# Location weight by store tier, holiday factor by category, demand base scale.
TIER_WEIGHT = {"Flagship": 3.0, "A": 1.5, "B": 0.8, "C": 0.4}
CATEGORY_HOLIDAY_FACTOR = {"Outerwear": 1.6, "Knitwear": 1.6, "Tailoring": 1.2, "Accessories": 1.3, "Footwear": 1.3}
BASE_SCALE = 0.55

# Supply sizing of the demand engine.
AVG_MULT_FOR_SIZING = 0.45
TARGET_SELLTHROUGH = 0.80
INITIAL_ALLOC_FRACTION = 0.55

# Return baseline rate by category.
RETURN_BASELINE_RATE = {"Outerwear": 0.11, "Knitwear": 0.08, "Tailoring": 0.09, "Accessories": 0.05, "Footwear": 0.12}

# Return reason codes, in the reference's order.
RETURN_REASONS = ["Fit-Small", "Fit-Large", "Fit-Other", "Quality", "Color-Mismatch",
                  "Changed-Mind", "Late-Delivery", "Damaged-Shipping"]

# Customer attribution weight by loyalty tier.
LOYALTY_WEIGHT = {"None": 1.0, "Silver": 1.5, "Gold": 2.0, "Platinum": 3.0, "Private Client": 3.5}

# Complementary category pairing for cross-sell suggestions.
COMPLEMENTARY_CATEGORIES = {
    "Outerwear": ["Knitwear", "Accessories"],
    "Knitwear": ["Tailoring", "Accessories"],
    "Tailoring": ["Footwear", "Accessories"],
    "Accessories": ["Outerwear", "Knitwear"],
    "Footwear": ["Tailoring", "Accessories"],
}

# Business size order: letters first, then numeric sizes offset by 100.
SIZE_ORDER = {"XS": 1, "S": 2, "M": 3, "L": 4, "XL": 5, "XXL": 6, "One Size": 7}

# Shipment milestones.
EVENT_SEQUENCE_NORMAL = ["Booked", "Departed-Origin", "Customs-Clear", "Received-DC"]
EVENT_SEQUENCE_DISRUPTED = ["Booked", "Departed-Origin", "Customs-Hold"]

# Decision triage: severity rank by decision type.
SEVERITY_RANK = {"Supply Risk": 0, "Cohort Opportunity": 1, "Overstock": 2, "Stockout": 3, "Returns": 4}

# Share of the bulk catalogue a store of each tier lists.
STORE_TIER_COVERAGE = {"Flagship": 0.12, "A": 0.06, "B": 0.03, "C": 0.015}

TAX_RATE = 0.08
HIGH_TIERS = ["Gold", "Platinum", "Private Client"]
STOCKOUT_WARNING_ON_HAND = 5
ROLLING_WINDOW_TICKS = 6
MARKDOWN_LADDER = [(17, 0.0), (31, 0.20)]  # weeks since launch < bound -> markdown; else 0.40
MARKDOWN_TAIL = 0.40
FULL_SCALE_CUSTOMERS = 500_000

# Currency rates: base rate to USD per currency, and the band the weekly random walk is clipped to
# (base × (1 ± FX_BAND)). USD stays at 1.0.
FX_BASE_RATE_TO_USD = {"USD": 1.0, "CAD": 0.74, "EUR": 1.08, "GBP": 1.26, "JPY": 0.0067, "CNY": 0.138}
FX_BAND = 0.15

# Soft row-count bands of the full-scale build, per fact table: [low, high].
ROW_COUNT_BANDS_FULL = {
    "fact_sales_line": (3_000_000, 9_000_000),
    "fact_inventory_position": (8_000_000, 16_000_000),
    "fact_returns_line": (600_000, 2_000_000),
    "fact_purchase_order_line": (2_000, 10_000),
    "fact_shipment_event": (8_000, 35_000),
    "fact_campaign_exposure": (300_000, 800_000),
    "fact_digital_engagement": (300_000, 1_200_000),
}

# ---------------------------------------------------------------------------
# Fixture mapping of the TPC-H-shaped test tables (see FIXTURES.md)
# ---------------------------------------------------------------------------
CATEGORY_OF_TYPE = {
    "LARGE": "Outerwear",
    "MEDIUM": "Knitwear",
    "STANDARD": "Tailoring",
    "SMALL": "Accessories",
    "PROMO": "Accessories",
    "ECONOMY": "Footwear",
}
SIZE_LABELS = ["XS", "S", "M", "L", "XL"]          # p_size % 5 -> label (numeric 38..42 for Footwear)
GENDERS = ["Mens", "Womens", "Unisex"]              # brand number % 3
STORE_TIERS = ["Flagship", "A", "B", "C"]            # r_regionkey % 4
REGION_CLIMATE = {0: ("warm", "ZAR"), 1: ("cold", "USD"), 2: ("temperate", "JPY"), 3: ("cold", "EUR"), 4: ("warm", "AED")}
# c_acctbal upper bounds -> loyalty tier; above the last bound: Private Client
LOYALTY_BANDS = [(1000.0, "None"), (4000.0, "Silver"), (7000.0, "Gold"), (9000.0, "Platinum")]
COLOR_FAMILY = {"Blue": "Blue", "Red": "Red"}          # every other colour word -> Neutral


@dataclass(frozen=True)
class Scenario:
    """Parameters of one planning run: its calendar (required), rule floors and campaign keys.

    The rule floors scale with the number of customers, which is counted from the data.
    """

    fiscal_start: dt.date                             # a Monday
    as_of_date: dt.date
    n_weeks: int
    cohort_campaign_id: str = "CMP-1"
    cohort_region: str = "EUROPE"
    cohort_segment: str = "BUILDING"
    capsule_prefix: str = "Brand#1"                  # style prefix of the capsule collection
    flagship_styles: tuple = ("Brand#1 ", "Brand#2 ")  # name fragments that mark flagship styles
    thresholds: dict = field(default_factory=lambda: dict(THRESHOLDS))

    @property
    def as_of_week(self) -> int:
        return (self.as_of_date - self.fiscal_start).days // 7 + 1


# rule floors: (value at full scale, least value); scaled by customers / FULL_SCALE_CUSTOMERS
FLOORS = {"min_remaining_demand": (15.0, 3.0), "min_recent_units": (15.0, 3.0), "min_weekly_rate": (2.0, 0.5)}

# the registered queries plan over the test tables: the calendar of their ship dates, as of week 336
DEFAULT = Scenario(fiscal_start=dt.date(1995, 1, 2), as_of_date=dt.date(2001, 6, 4), n_weeks=357)
