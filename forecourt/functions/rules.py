"""Emission rule and the features derived next to it, as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the rule: first compliant year per fuel, and fuels exempt from it.
FIRST_COMPLIANT_YEAR = {"Petrol": 2006, "Diesel": 2015}
EXEMPT_FUELS = ("Hybrid", "Other", "Electric")
REFERENCE_YEAR = 2025


def ulez_compliance(fuel: Column, year: Column) -> Column:
    """Never NULL: an unknown fuel, or an unknown year where one is needed, is not compliant."""
    first_year = F.coalesce(
        *[F.when(fuel == name, F.lit(start)) for name, start in FIRST_COMPLIANT_YEAR.items()]
    )
    return F.coalesce(year >= first_year, fuel.isin(*EXEMPT_FUELS), F.lit(False))


def vehicle_age(year: Column, reference_year: int = REFERENCE_YEAR) -> Column:
    return F.lit(reference_year) - year


def price_per_mile_zero(price: Column, mileage: Column) -> Column:
    """Batch form: 0 unless the mileage is positive."""
    return F.when(mileage > 0, price / F.nullif(mileage, F.lit(0))).otherwise(F.lit(0.0))


def price_per_mile_null(price: Column, mileage: Column) -> Column:
    """Change-feed form: NULL when the mileage is 0 or NULL."""
    return price / F.nullif(mileage, F.lit(0))


def percent_change(new: Column, base: Column) -> Column:
    return F.round((new - base) / F.nullif(base, F.lit(0.0)) * 100, 1)
