"""Business rules of the marketing lakehouse.

Every literal that the results depend on lives here, as the default of a
``Rules`` field, so a caller can change one without touching an operator.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# They have to match the source systems exactly.
AD_PLATFORM_ALIASES = {
    "fb": "facebook",
    "facebook": "facebook",
    "facebã¶k": "facebook",
    "g_ads": "google_ads",
    "google_ads": "google_ads",
    "tiktok": "tiktok",
}
LEAD_SOURCE_ALIASES = {
    "fb": "facebook",
    "fb_social": "facebook",
    "facebook_ads": "facebook",
    "g_ads": "google_ads",
    "google_ads": "google_ads",
    "google_paid": "google_ads",
    "google-ads": "google_ads",
    "organic": "organic",
}
UNKNOWN_USER = (0, "UNKNOWN", "Unknown", None, None)
UNKNOWN_PRODUCT = (-1, "N/A", "Unknown Product", 0.0)

# The serving tables and the column that identifies a row in each.
SERVING_KEYS = {
    "dim_user": "user_key",
    "dim_product": "product_key",
    "dim_platform": "platform_key",
    "dim_date": "date_key",
    "dim_influencer": "influencer_key",
    "fact_ad_spend": "ad_spend_key",
    "fact_sales": "sale_id",
    "fact_marketing_performance": "perf_key",
}


@dataclass(frozen=True)
class Rules:
    ad_platform_aliases: Mapping[str, str] = field(default_factory=lambda: dict(AD_PLATFORM_ALIASES))
    lead_source_aliases: Mapping[str, str] = field(default_factory=lambda: dict(LEAD_SOURCE_ALIASES))
    other_source: str = "other"
    eur_to_usd: float = 1.08
    void_amount: float = -50.0
    month_first_format: str = "M/d/yyyy"
    day_first_format: str = "dd/MM/yyyy"
    month_cutoff: int = 2
    timestamp_formats: tuple[str, ...] = ()
    unknown_user_key: int = UNKNOWN_USER[0]
    unknown_product_key: int = UNKNOWN_PRODUCT[0]
    roas_digits: int = 4
    cac_digits: int = 2
    breakeven: float = 1.0
    feed_size: int = 50

    def __post_init__(self) -> None:
        # Members are numbered from 1.
        if self.unknown_user_key > 0 or self.unknown_product_key > 0:
            raise ValueError("the keys of the unknown user and product must not be positive")


DEFAULT_RULES = Rules()
