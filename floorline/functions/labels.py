"""Text labels read off a value: threshold ladders and code look-ups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label ladders.  A value strictly above a step takes the label of
# the highest such step; a value on or below every step, and null, take the last
# label.
LADDERS = {
    "temperature_status": ("temperature", ((90, "Critical"), (80, "Warning")), "Normal"),
    "vibration_status": ("vibration", ((5, "Critical"), (3, "Warning")), "Normal"),
    "power_status": ("power_kw", ((5, "High"), (3, "Normal")), "Low"),
    "fatigue_status": ("fatigue_score", ((80, "High"), (50, "Medium")), "Low"),
    "heart_rate_status": ("heart_rate", ((120, "High"), (90, "Elevated")), "Normal"),
}

# Error codes per fault category; other codes and null are "None".
FAULT_CATEGORIES = {
    "Overheat": ("E001", "E003"),
    "Vibration": ("E002", "E004"),
    "RPM Drop": ("E005",),
}
NO_FAULT_CATEGORY = "None"


def first_match(cases: list[tuple[Column, object]], default: object = None) -> Column:
    """One CASE expression: the value of the first condition that is true."""
    (condition, value), *rest = cases
    chain = F.when(condition, value)
    for condition, value in rest:
        chain = chain.when(condition, value)
    return chain if default is None else chain.otherwise(default)


def ladder(name: str) -> Column:
    """The label column ``name`` of ``LADDERS``, computed from its reading."""
    reading, steps, lowest = LADDERS[name]
    return first_match([(F.col(reading) > step, label) for step, label in steps], lowest)


def fault_category(code: str = "error_code") -> Column:
    return first_match(
        [(F.col(code).isin(*codes), category) for category, codes in FAULT_CATEGORIES.items()],
        NO_FAULT_CATEGORY,
    )


def flag(condition: Column) -> Column:
    """1 where the condition is true, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)
