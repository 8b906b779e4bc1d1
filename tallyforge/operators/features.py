"""Features computed from columns of the same row; each needs all its inputs to be present."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import c, numeric_columns

SKEWED = ["DaySinceLastOrder", "WarehouseToHome", "OrderCount", "CashbackAmount"]


def at_least_one(col):
    """``max(col, 1)`` that keeps a null."""
    return F.when(col.isNotNull(), F.greatest(col.cast("double"), F.lit(1.0)))


def per_unit(num, den):
    return c(num) / at_least_one(c(den))


def log_of(name):
    """``log(1 + x)`` with negative x counted as 0, so that it is always defined."""
    return F.log1p(F.when(c(name).isNotNull(), F.greatest(c(name).cast("double"), F.lit(0.0))))


def flag(condition):
    """1 where true, 0 where false or unknown."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def safe_divide(num, den, fallback):
    """``num / den`` where ``den`` is positive, the fallback elsewhere."""
    return F.when(den > 0, num.cast("double") / F.when(den > 0, den)).otherwise(fallback.cast("double"))


def engineer(df):
    """Add the domain features whose inputs are present."""
    has = set(df.columns).issuperset
    new = {}
    if has(["CashbackAmount", "OrderCount"]):
        new["avg_cashbk_per_order"] = per_unit("CashbackAmount", "OrderCount")
    if has(["OrderCount", "Tenure"]):
        new["order_frequency_mpm"] = per_unit("OrderCount", "Tenure")
    if has(["CouponUsed", "OrderCount"]):
        new["coupon_rate"] = per_unit("CouponUsed", "OrderCount")
    if has(["HourSpendOnApp", "NumberOfDeviceRegistered"]):
        new["engagement_score"] = c("HourSpendOnApp") * F.log1p(c("NumberOfDeviceRegistered"))
    for name in SKEWED:
        if has([name]):
            new[f"log_{name}"] = log_of(name)
    if has(["CityTier"]):
        new["city_is_tier1"] = flag(c("CityTier").try_cast("double") == 1)
    if has(["NumberOfAddress"]):
        new["multi_address"] = flag(c("NumberOfAddress") > 1)
    return df.withColumns(new) if new else df


def engineer_safe(df):
    """The variant with guarded divisions, interactions, and no missing or infinite result."""
    has = set(df.columns).issuperset
    new = {}
    if has(["CashbackAmount", "OrderCount"]):
        new["avg_cashbk_per_order"] = safe_divide(c("CashbackAmount"), c("OrderCount"), c("CashbackAmount"))
    if has(["OrderCount", "Tenure"]):
        new["order_frequency_mpm"] = safe_divide(c("OrderCount"), c("Tenure"), c("OrderCount"))
    if has(["CouponUsed", "OrderCount"]):
        new["coupon_rate"] = safe_divide(c("CouponUsed"), c("OrderCount"), F.lit(0.0))
    if has(["HourSpendOnApp", "NumberOfDeviceRegistered"]):
        new["engagement_score"] = c("HourSpendOnApp") * F.log1p(c("NumberOfDeviceRegistered"))
    if has(["CityTier"]):
        new["city_is_tier1"] = flag(c("CityTier").try_cast("double") == 1)
    if has(["NumberOfAddress"]):
        new["multi_address"] = flag(c("NumberOfAddress") > 1)
    for name in SKEWED:
        if has([name]):
            new[f"log_{name}"] = log_of(name)
    df = df.withColumns(new) if new else df
    return repair_numbers(interactions(df))


def interactions(df):
    """Products of two features."""
    has = set(df.columns).issuperset
    new = {}
    if has(["OrderAmountHikeFromlastYear", "order_frequency_mpm"]):
        new["growth_x_freq"] = c("OrderAmountHikeFromlastYear") * c("order_frequency_mpm")
    if has(["SatisfactionScore", "Complain"]):
        new["satis_x_complain"] = c("SatisfactionScore") * (1 - c("Complain").cast("int"))
    return df.withColumns(new) if new else df


def repair_numbers(df, columns=None):
    """Missing, NaN and infinite numbers become 0."""
    new = {}
    for n in columns or numeric_columns(df):
        x = c(n).cast("double")
        bad = x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
        new[n] = F.when(bad, F.lit(0)).otherwise(c(n))
    return df.withColumns(new) if new else df
