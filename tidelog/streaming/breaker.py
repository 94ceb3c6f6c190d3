"""Restart policy of streams: exponential backoff with jitter, and a guard against tight loops of one failure."""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Seconds of the first delay and of the longest, the factors of jitter, failures in a row that open,
#: and how many failures of one reason, each within so many seconds of the one before, open for the longest delay.
BASE, MOST, JITTER, OPENS_AT, LOOP_COUNT, LOOP_SECONDS = 0.5, 30.0, (0.5, 1.5), 3, 5, 5.0


@dataclass
class CircuitBreaker:
    """closed, open until some time, then half open: the next failure opens again, a success closes."""

    base: float = BASE
    most: float = MOST
    opens_at: int = OPENS_AT
    loop_count: int = LOOP_COUNT
    loop_seconds: float = LOOP_SECONDS
    clock: Callable[[], float] = time.monotonic
    chance: Callable[[float, float], float] = random.uniform
    failures: int = 0
    repeats: int = 0
    last: tuple[float, str] | None = None
    until: float | None = None
    half_open: bool = False

    def failed(self, what: str = "unknown") -> float:
        """Seconds to hold off from now; every failure has its delay, whether or not it opens."""
        now = self.clock()
        self.failures += 1
        delay = min(self.most, min(self.most, self.base * 2 ** (self.failures - 1)) * self.chance(*JITTER))
        again = self.last is not None and self.last[1] == what and now - self.last[0] <= self.loop_seconds
        self.repeats, self.last = self.repeats + 1 if again else 1, (now, what)
        if self.repeats >= self.loop_count:
            delay = self.most
        elif not self.half_open and self.failures < self.opens_at:
            return delay
        self.until, self.half_open = now + delay, False
        return delay

    def succeeded(self) -> None:
        self.failures, self.until, self.half_open = 0, None, False

    def wait(self) -> float:
        """Seconds until an attempt may be made; once they are over the breaker is half open."""
        if self.until is None:
            return 0.0
        left = self.until - self.clock()
        if left > 0:
            return left
        self.until, self.half_open = None, True
        return 0.0

    @property
    def is_open(self) -> bool:
        return self.until is not None and self.clock() < self.until

    def reset(self) -> None:
        self.succeeded()
        self.repeats, self.last = 0, None


def supervised(start: Callable[[], Any], breaker: CircuitBreaker | None = None, most_restarts: int | None = None, sleep: Callable[[float], Any] = time.sleep) -> int:
    """Runs start() (a StreamingQuery) to its end, again after each failure as the breaker allows; the number of restarts.

    most_restarts: that many failures are one too many, and the last is raised; None never gives up.
    """
    breaker = breaker or CircuitBreaker()
    restarts = 0
    while True:
        sleep(breaker.wait())
        try:
            start().awaitTermination()
            breaker.succeeded()
            return restarts
        except Exception as e:
            restarts += 1
            if most_restarts is not None and restarts > most_restarts:
                raise
            delay = breaker.failed(type(e).__name__)
            if not breaker.is_open:
                sleep(delay)


def schedule(attempts: DataFrame, key: str, order: str, at: Column, failed: Column, reason: Column) -> DataFrame:
    """key, order, failures in a row, repeats, delay (without jitter) and opens for every failure of a log of attempts.

    The policy over many logs at once, for instance of all shapes' reads. at: seconds. A success ends a row of failures,
    but not a run of repeats, as in CircuitBreaker.
    """
    each = Window.partitionBy(key).orderBy(order)
    rows = attempts.select(key, order, at.cast("double").alias("_at"), failed.alias("_failed"), reason.alias("_reason"))
    rows = rows.withColumn("_row", F.count_if(~F.col("_failed")).over(each)).where("_failed")
    new = F.lag("_at").over(each).isNull() | (F.lag("_reason").over(each) != F.col("_reason")) | (F.col("_at") - F.lag("_at").over(each) > LOOP_SECONDS)
    rows = rows.withColumn("_new", new).withColumn("_run", F.count_if("_new").over(each))
    number = lambda of: F.row_number().over(Window.partitionBy(key, of).orderBy(order))
    rows = rows.select(key, order, number("_row").alias("failures"), number("_run").alias("repeats"))
    loop = F.col("repeats") >= LOOP_COUNT
    delay = F.when(loop, MOST).otherwise(F.least(F.lit(MOST), F.lit(BASE) * F.pow(F.lit(2.0), F.least(F.col("failures") - 1, F.lit(60)))))
    return rows.select("*", delay.alias("delay"), (loop | (F.col("failures") >= OPENS_AT)).alias("opens"))
