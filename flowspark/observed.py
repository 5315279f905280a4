"""Numbers that a job makes on its way, instead of a job of their own."""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation

#: Seconds to wait for numbers of a job that has ended. Where the optimizer has dropped what makes them (a branch without rows), they never come.
WAIT = 15.0


def result_of(seen: Observation, wait: float = WAIT) -> dict | None:
    """What was observed in a job that has ended, or None."""
    found: list[dict] = []
    reader = threading.Thread(target=lambda: found.append(seen.get), daemon=True)
    reader.start()
    reader.join(wait)
    return found[0] if found else None


@dataclass
class Watch:
    """Aggregates of a DataFrame that are made when it is read, and the checks that hold them against what is asked.

    Counts are exact where the tasks that write make them; elsewhere a task that is run again counts again, so that checks look at greatest values only.
    """

    pending: list[tuple[Observation, DataFrame, list[Column], Callable[[dict], None]]] = field(default_factory=list)

    def over(self, df: DataFrame, aggregates: list[Column], check: Callable[[dict], None]) -> DataFrame:
        seen = Observation()
        self.pending.append((seen, df, aggregates, check))
        return df.observe(seen, *aggregates)

    def verify(self) -> None:
        """After the job: run all checks; numbers that didn't come are made by a job."""
        for seen, df, aggregates, check in self.pending:
            found = result_of(seen)
            check(df.agg(*aggregates).first().asDict() if found is None else found)
