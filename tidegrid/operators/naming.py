"""Column names: normalising, dropping by name, finding the target."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame

# Columns that are not used as features.
UNWANTED_COLUMNS = ("carbon_dioxide_ppm", "methane_μg/m³", "snowfall_cm", "snow_depth_m")

# Spellings of the default target column.
TARGET_SPELLINGS = ("pm2_5_(μg/m³)", "pm2_5 (μg/m³)")


def normalize_name(name: str) -> str:
    """Remove empty parentheses with the space before them; spaces become ``_``."""
    return re.sub(r"\s*\(\)", "", name).replace(" ", "_")


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalize_name(c) for c in df.columns])


def _bare(name: str) -> str:
    return re.sub(r"[()]", "", name)


def drop_columns(df: DataFrame, names: Iterable[str] = UNWANTED_COLUMNS) -> DataFrame:
    """Drop the named columns where present, whether or not the unit is in parentheses."""
    unwanted = {_bare(n) for n in names}
    keep = [c for c in df.columns if _bare(c) not in unwanted]
    return df if len(keep) == len(df.columns) else df.select(*[f"`{c}`" for c in keep])


def resolve_target(columns: Iterable[str], wanted: str) -> str:
    """First spelling of the target that exists, else ``ValueError``."""
    columns = list(columns)
    spellings = (wanted, wanted.replace(" ", "_"), wanted.replace("_", " "), *TARGET_SPELLINGS)
    for name in spellings:
        if name in columns:
            return name
    raise ValueError(f"no target column among {columns}; tried {list(spellings)}")
