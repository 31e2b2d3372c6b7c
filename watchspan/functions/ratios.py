"""Ratios that are null instead of failing on an empty denominator."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def safe_ratio(num: Column, den: Column) -> Column:
    den = den.cast("double")
    return F.when(den != 0, num.cast("double") / den)


def z_score(value: Column, mean: Column, std: Column) -> Column:
    return safe_ratio(value.cast("double") - mean, std)


def pct_change(value: Column, mean: Column) -> Column:
    return safe_ratio(value.cast("double") - mean, mean)
