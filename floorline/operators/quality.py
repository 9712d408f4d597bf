"""Data-quality rules and the split of bronze into valid, quarantine and unrouted.

A rule is one predicate that a good row satisfies.  Under SQL's three-valued
logic it has three outcomes, and each has its own meaning here:

* false for some rule  -> quarantine, with the reason of the first such rule;
* true for every rule  -> valid;
* otherwise (unknown for a rule and false for none) -> unrouted: the row is
  neither good nor provably bad.  It is left out of both outputs and can be
  inspected through ``unrouted``.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floorline.contracts import REASON
from floorline.functions.labels import first_match


class Rule(NamedTuple):
    reason: str
    holds: str  # SQL predicate over bronze columns


# Rules in order of precedence.
MACHINE_RULES = (
    Rule("NULL_TIMESTAMP", "timestamp IS NOT NULL"),
    Rule("NULL_TEMPERATURE", "temperature IS NOT NULL"),
    Rule("TEMPERATURE_OUT_OF_RANGE", "temperature BETWEEN -20 AND 150"),
    Rule("INVALID_RPM", "rpm >= 0"),
    Rule("INVALID_POWER", "power_kw >= 0"),
    Rule("INVALID_STATUS", "status IN ('running', 'idle', 'fault')"),
    Rule("EMPTY_MACHINE_ID", "machine_id <> ''"),
)
WORKER_RULES = (
    Rule("NULL_TIMESTAMP", "timestamp IS NOT NULL"),
    Rule("EMPTY_WORKER_ID", "worker_id <> ''"),
    Rule("INVALID_HEART_RATE", "heart_rate >= 0"),
    Rule("INVALID_MOVEMENT_STATUS", "movement_status IN ('ACTIVE', 'IDLE', 'WALKING')"),
)
RULES = {"machine": MACHINE_RULES, "worker": WORKER_RULES}


def reason(rules: tuple[Rule, ...]) -> Column:
    """Reason of the first rule the row breaks, null if it breaks none."""
    return first_match([(~F.expr(rule.holds), rule.reason) for rule in rules])


def all_hold(rules: tuple[Rule, ...]) -> Column:
    """True, false or unknown: the conjunction of all rules."""
    return reduce(Column.__and__, (F.expr(rule.holds) for rule in rules))


def quarantine(bronze: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Rows that break a rule, with the reason."""
    return bronze.withColumn(REASON, reason(rules)).where(F.col(REASON).isNotNull())


def valid(bronze: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Rows that satisfy every rule."""
    return bronze.where(all_hold(rules))


def unrouted(bronze: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Rows in neither of the two outputs above."""
    return bronze.where(all_hold(rules).isNull())
