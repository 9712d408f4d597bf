"""Counts of valid, quarantined and unrouted rows of every micro-batch, taken while the batch passes.

The counts are accumulated by the tasks that decode the batch (``observe``) and arrive
with the query's progress, so no job and no second look at the rows is needed.
"""

from __future__ import annotations

from collections import Counter
from threading import Condition

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from floorline.operators.quality import RULES, all_hold, reason

VALID, UNROUTED = "VALID", "UNROUTED"
SUFFIX = "_outcomes"


def outcomes(domain: str) -> list[str]:
    return [*(rule.reason for rule in RULES[domain]), VALID, UNROUTED]


def counts(domain: str) -> list[Column]:
    """A count per outcome; every row of bronze has one."""
    rules = RULES[domain]
    first, holds = reason(rules), all_hold(rules)
    found = {VALID: holds, UNROUTED: holds.isNull() & first.isNull()}
    return [F.count_if(F.coalesce(found.get(name, first == name), F.lit(False))).alias(name) for name in outcomes(domain)]


def counted(bronze: DataFrame, domain: str) -> DataFrame:
    """``bronze``, observed as it passes; whoever reads a batch twice without keeping it counts it twice."""
    return bronze.observe(f"{domain}{SUFFIX}", *counts(domain))


class OutcomeCounts(StreamingQueryListener):
    """Counts per query and batch, once each: a batch that is run again replaces its counts.

    Add it with ``session.streams.addListener``.
    """

    def __init__(self) -> None:
        self.batches: dict[tuple[str, int], dict[str, int]] = {}
        self.ended: set[str] = set()
        self.changed = Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for name, row in (progress.observedMetrics or {}).items():
            if name.endswith(SUFFIX):
                with self.changed:
                    self.batches[str(progress.id), progress.batchId] = {k: int(v or 0) for k, v in row.asDict().items()}

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def wait_for(self, query: StreamingQuery, timeout: float = 60) -> None:
        """Until the progress of a query that has ended has arrived; events come in order, a little later."""
        with self.changed:
            if not self.changed.wait_for(lambda: str(query.runId) in self.ended, timeout):
                raise TimeoutError(f"no news of {query.name}")

    def totals(self) -> dict[str, int]:
        """Counts over all batches seen."""
        with self.changed:
            return dict(sum((Counter(found) for found in self.batches.values()), Counter()))
