"""Business constants and the settings object handed to every job."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

# They must equal the published ones for results to agree.
NON_PRODUCT_CODES = (
    "POST", "DOT", "M", "BANK CHARGES", "PADS", "C2", "D", "CRUK", "S", "AMAZONFEE", "B",
    "Adjust bad debt", "Manual", "Discount",
)
COLUMN_RENAMES = {"Invoice": "InvoiceNo", "Price": "UnitPrice", "Customer ID": "CustomerID"}
SEGMENT_NAMES = ("Champions", "At-Risk High-Value", "Promising", "Hibernating", "Lost")
SEGMENT_ACTIONS = {
    "Champions": "Loyalty rewards & VIP perks",
    "At-Risk High-Value": "Urgent win-back campaign",
    "Promising": "Upsell & cross-sell offers",
    "Hibernating": "Re-engagement email sequence",
    "Lost": "Low-cost reactivation or suppress",
}
DEFAULT_ACTION = "Review manually"
SCENARIOS = {"conservative": 0.7, "base": 1.0, "optimistic": 1.3}
DRIFT_FEATURES = ("recency", "frequency", "monetary_value", "T")
SEED = 42
# End of fixed values.

# Money travels as BIGINT counts of 1/10,000 of a currency unit, so sums are exact and do not
# depend on the order in which tasks finish.
MINOR_PER_UNIT = 10_000


@dataclass(frozen=True)
class Settings:
    """Everything a job can be tuned with; the defaults are the published configuration."""

    observation_start: date = date(2009, 12, 1)
    observation_end: date = date(2010, 12, 1)
    holdout_start: date = date(2010, 12, 2)
    holdout_end: date = date(2011, 12, 9)
    non_product_codes: tuple[str, ...] = NON_PRODUCT_CODES
    outlier_percentile: float = 99.9
    convert_to_inr: bool = True
    inr_rate: int = 105
    gross_margin: float = 0.60
    cost_per_contact: int = 150
    budget: int = 5_000_000
    monthly_discount: float = 0.01
    penalizer: float = 0.01
    spend_unit: float = 1.0  # amounts are divided by this before the spend model is penalised
    horizon_months: int = 12
    folds: int = 5
    tuning_trials: int = 30
    segment_k: tuple[int, ...] = (5,)
    treatment_share: float = 0.30
    psi_bins: int = 10
    psi_low: float = 0.10
    psi_high: float = 0.20
    min_quarter_rows: int = 100
    conformal_alpha: float = 0.10
    seed: int = SEED
