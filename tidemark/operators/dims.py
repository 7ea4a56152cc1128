"""Dimension building: denormalised SKU, user bands, province."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import age_in_years
from .relational import enrich

# Band and gender labels.
AGE_UNDER_20 = "20 岁及以下"
AGE_20_TO_30 = "21 岁到 30 岁"
AGE_OVER_30 = "30 岁以上"
GENDER_MALE = "男"
GENDER_FEMALE = "女"


def denormalize_sku(sku: DataFrame, category3: DataFrame, trademark: DataFrame, spu: DataFrame) -> DataFrame:
    """SKU with the names of its category, brand and product line; unmatched SKUs are kept."""
    out = enrich(sku, category3, {"category3_id": "id"}, {"name": "category3_name"})
    out = enrich(out, trademark, {"tm_id": "tm_id"}, {"tm_name": "tm_name"})
    return enrich(out, spu, {"spu_id": "id"}, {"spu_name": "spu_name"})


def user_bands(users: DataFrame, as_of: str) -> DataFrame:
    """age_group and gender_name.  Exactly 20 and exactly 30 both fall in the middle band."""
    age = age_in_years(F.col("birthday"), F.lit(as_of).cast("date"))
    band = F.when(age < 20, AGE_UNDER_20).when(age > 30, AGE_OVER_30).otherwise(AGE_20_TO_30)
    gender = F.when(F.col("gender") == "M", GENDER_MALE).otherwise(GENDER_FEMALE)
    return users.withColumns({"age_group": band, "gender_name": gender})


def with_province(orders: DataFrame, province: DataFrame) -> DataFrame:
    return enrich(
        orders,
        province,
        {"province_id": "id"},
        {"name": "province_name", "area_code": "province_area_code", "iso_code": "province_iso_code"},
    )


def with_user(orders: DataFrame, users: DataFrame) -> DataFrame:
    return enrich(
        orders, users, {"user_id": "id"}, {"age_group": "user_age_group", "gender_name": "user_gender"}
    )


def with_sku(details: DataFrame, sku: DataFrame, fill_unmatched_ids: int | None = None) -> DataFrame:
    """Line with its SKU's ids and names; unmatched ids stay null unless a filler is given."""
    ids = ["spu_id", "tm_id", "category3_id"]
    names = ["spu_name", "tm_name", "category3_name"]
    fill = None if fill_unmatched_ids is None else dict.fromkeys(ids, fill_unmatched_ids)
    return enrich(details, sku, {"sku_id": "id"}, {c: c for c in ids + names}, fill)
