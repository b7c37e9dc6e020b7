"""Code tables and the operator that applies them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Reason codes recorded with an approved age check.
AGE_CHECK_APPROVED = {
    1: "Obviously Over Age",
    2: "National ID card",
    3: "Citizen Card",
    4: "Drivers license",
    5: "Passport",
    6: "Validate UK card",
    7: "Fingerprint ID",
    8: "Pass cards",
}

# Reason codes recorded with a refused age check.
AGE_CHECK_REFUSED = {
    50: "No ID",
    51: "Fake ID",
    52: "Believe To Be Suppliying Under Age",
    53: "Excluded or Banned",
    54: "Out of Licensing Hours",
    55: "Customer appears to be Intoxicated",
    56: "Police In Uniforms",
    57: "Under Age Alcohol",
    58: "Under Age Lottery",
    59: "Under Age Cigarettes & Tobacco",
    60: "Under Age Video Rental",
    61: "Under Age Other",
}

# Direction codes on flight-linked receipts.
FLIGHT_TYPE = {"D": "Departure", "A": "Arrival"}
TRAVEL_TYPE = {"D": "DEP", "A": "ARR"}


def label_of(code: Column | str, table: Mapping, default: str | Column | None = None) -> Column:
    """Label for a code as a literal map lookup: no join, no UDF, constant size in the plan."""
    c = F.col(code) if isinstance(code, str) else code
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    found = F.try_element_at(F.create_map(*pairs), c)
    return found if default is None else F.coalesce(found, F.lit(default) if isinstance(default, str) else default)
