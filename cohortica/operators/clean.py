"""Row filters, column selection and null filling."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortica.functions.columns import as_double, ref, split_columns, threshold_flag
from cohortica.operators.quantiles import medians

log = logging.getLogger(__name__)


def clean(df: DataFrame, mode: str = "drop") -> DataFrame:
    """``drop`` removes rows with any null; ``median`` fills numeric nulls instead."""
    numeric, _ = split_columns(df)
    if mode == "drop":
        whole = df
        for f in df.schema.fields:
            if f.dataType.typeName() in ("double", "float"):
                whole = whole.where(~F.isnan(ref(f.name)))
        return whole.na.drop("any")
    if mode == "median":
        return fill_median(df, numeric)
    raise ValueError(f"unknown mode {mode!r}")


def fill_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    values = medians(df, cols)
    return df.select(*[
        F.coalesce(as_double(c), F.lit(values[c])).alias(c) if values.get(c) is not None else ref(c)
        for c in df.columns
    ])


def select_features(df: DataFrame, features: Sequence[str], target: str) -> tuple[DataFrame, list[str]]:
    """Listed features that exist plus the target, and the names that were missing."""
    available = [f for f in features if f in df.columns]
    missing = [f for f in features if f not in df.columns]
    if missing:
        log.warning("selected features not found, skipped: %s", missing)
    return df.select(*[ref(c) for c in available], ref(target)), missing


def binarise(df: DataFrame, cols: Sequence[str], threshold: float = 1) -> DataFrame:
    absent = [c for c in cols if c not in df.columns]
    if absent:
        raise ValueError(f"columns to binarise not found: {absent}")
    return df.select(*[
        threshold_flag(ref(c), threshold).alias(c) if c in cols else ref(c) for c in df.columns
    ])


def override(df: DataFrame, constants: dict) -> DataFrame:
    """Set the given columns to constants, adding those that are absent."""
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})
