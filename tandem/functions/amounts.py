"""Amounts, premiums, scores and labels."""

from __future__ import annotations

import sys

from pyspark.sql import Column, functions as F

from tandem import catalog
from tandem.functions.text import clean_text


def number(value: Column) -> Column:
    """Double from text or a number; blank, unreadable, NaN or endless gives null."""
    read = value.try_cast("double")
    return F.when(read.between(-sys.float_info.max, sys.float_info.max), read)


def clean_amount(value: Column) -> Column:
    """Double from delivered text, white space removed first."""
    return number(clean_text(value))


def money(value: Column) -> Column:
    """Exact cents, up to 26 digits before the point: sums of it do not depend on row order, unlike sums of doubles."""
    return value.try_cast("decimal(28,2)")


def total_money(value: Column) -> Column:
    """Sum of an amount column, two decimals, as double."""
    return F.round(F.sum(money(value)), 2).cast("double")


def yearly_premium(yearly: Column, monthly: Column, zero_is_missing: bool = True) -> Column:
    """Yearly premium, or twelve monthly ones.

    Messages may carry 0 for a missing premium; ``zero_is_missing`` keeps such a 0 from hiding the other.
    """
    yearly, monthly = number(yearly), number(monthly)
    if zero_is_missing:
        yearly = F.nullif(yearly, F.lit(0.0))
    return F.coalesce(yearly, monthly * 12)


def monthly_from(yearly: Column, monthly: Column) -> Column:
    """Monthly premium, filled from the yearly one; two decimals."""
    return F.round(F.coalesce(money(monthly), money(yearly) / 12), 2).cast("double")


def yearly_from(yearly: Column, monthly: Column) -> Column:
    """Yearly premium, filled from the monthly one; two decimals."""
    return F.round(F.coalesce(money(yearly), money(monthly) * 12), 2).cast("double")


def product_family(kind: Column, product_code: Column) -> Column:
    """Insurance type, or the first word of the product code; the short form of assistance is spelt out."""
    family = F.coalesce(kind, F.substring_index(product_code, "_", 1))
    return F.when(family == catalog.FAMILY_SHORT, catalog.FAMILY_LONG).otherwise(family)


def suspect_label(score: Column, threshold: float = catalog.SUSPECT_SCORE) -> Column:
    """1 from the threshold on, else 0; a missing or unreadable score counts as 0."""
    return F.when(number(score) >= threshold, 1).otherwise(0)


def whole_percent(probability: Column) -> Column:
    """0.875 -> 88, ties to even; null stays null."""
    return F.bround(probability * 100).cast("int")
