"""Column layouts of the raw logs, and the fixed values that go with them."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


IMPRESSIONS = _schema(
    impression_id=T.StringType(),
    timestamp=T.TimestampType(),
    customer_id=T.StringType(),
    merchant_id=T.StringType(),
    ad_placement=T.StringType(),
    advertiser_cuisine=T.StringType(),
    device=T.StringType(),
)

CLICKS = _schema(
    click_id=T.StringType(),
    impression_id=T.StringType(),
    timestamp=T.TimestampType(),
    customer_id=T.StringType(),
    merchant_id=T.StringType(),
    ad_placement=T.StringType(),
)

ORDERS = _schema(
    order_id=T.StringType(),
    timestamp=T.TimestampType(),
    customer_id=T.StringType(),
    merchant_id=T.StringType(),
    order_amount=T.DoubleType(),
    used_coupon=T.IntegerType(),
    cuisine=T.StringType(),
    attribution_source=T.StringType(),
    origin_click_id=T.StringType(),
)

# Names and levels of the data model.
CLICK_STATUS = "Closed_Loop_Attributed_Click"
VIEW_STATUS = "View_Through_Attributed"
ORGANIC_STATUS = "Organic_or_Direct"

PLACEMENTS = ("category_highlight", "feed_banner_top", "post_order_carousel", "search_sponsored_item")
DEVICES = ("android", "ios")
PERIODS = ("manha", "almoco", "jantar")

# The folder column of the raw logs, the date of ``timestamp``.
EVENT_DATE = "event_date"

CLICK_WINDOW_DAYS = 7
VIEW_WINDOW_HOURS = 24
WATERMARK = "30 days"

# Values a customer without orders gets in the gold table.
GOLD_DEFAULTS = {
    "user_total_orders": 0,
    "user_attributed_orders": 0,
    "user_avg_basket_value": 45.0,
    "user_discount_affinity": 0.20,
    "user_preferred_cuisine": "Burger",
    "user_ad_impressions": 0,
    "user_ad_clicks": 0,
    "user_historical_ctr": 0.0,
    "user_ad_fatigue_score": 1.0,
}

# Values scoring uses where a key is not in the feature table.
SERVING_DEFAULTS = {
    "user_total_orders": 0.0,
    "user_avg_basket_value": 45.0,
    "user_discount_affinity": 0.2,
    "user_ad_fatigue_score": 1.0,
    "user_historical_ctr": 0.05,
    "merchant_total_orders": 0.0,
    "merchant_avg_ticket": 50.0,
    "merchant_retail_media_dependency_rate": 0.1,
}

CUSTOMER_FEATURES = (
    "user_total_orders",
    "user_avg_basket_value",
    "user_discount_affinity",
    "user_ad_fatigue_score",
    "user_historical_ctr",
)
MERCHANT_FEATURES = (
    "merchant_total_orders",
    "merchant_avg_ticket",
    "merchant_retail_media_dependency_rate",
)
NUMERIC_FEATURES = CUSTOMER_FEATURES + MERCHANT_FEATURES + ("is_affinity_match",)

# Context of a customer the feature table does not know.
UNKNOWN_CONTEXT = {
    "cuisine": "Pizza",
    "discount_sensitive": False,
    "avg_ticket": 50.0,
    "fatigue": 1.0,
}
PRICE_SENSITIVE_ABOVE = 0.35
DECISION_THRESHOLD = 0.25
