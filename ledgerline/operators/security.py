"""Row-level filtering and column masking helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import broadcast_if_small


def region_entitlements(nation: DataFrame, region: DataFrame) -> DataFrame:
    """reader_role -> country_code grants: an analyst role per region
    (``<region>_analyst``) may read the countries of that region."""
    role = F.concat(F.lower(F.regexp_replace(F.col("r_name"), " ", "_")), F.lit("_analyst"))
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        role.alias("reader_role"),
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("country_code"))


def row_level_filter(df: DataFrame, entitlements: DataFrame, role_col: str, role: str,
                     key: str) -> DataFrame:
    """Rows whose ``key`` the role is entitled to: a LEFT SEMI join against
    the role's grants (duplicates in the grants cannot multiply rows).
    Grants are broadcast only after their size is checked."""
    grants = entitlements.where(F.col(role_col) == role).select(F.col(key)).distinct()
    return df.join(broadcast_if_small(grants), key, "left_semi")
