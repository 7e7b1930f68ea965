"""Limits per class of users: a time limit that cancels only its own jobs, concurrent runs, runs an hour, a scheduler pool."""

from __future__ import annotations

import threading
import time
import uuid
from collections import deque
from collections.abc import Callable
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import SparkSession

Result = TypeVar("Result")


class OverLimit(RuntimeError):
    pass


@dataclass(frozen=True)
class UserClass:
    name: str
    seconds: float
    concurrent: int
    per_hour: int

    #: Share of tasks comes from the pool of this name in the scheduler's allocation file.
    @property
    def pool(self) -> str:
        return self.name


#: The read-only class.
READ_ONLY = UserClass("readonly", 30, 20, 1000)


class Governor:
    def __init__(self, spark: SparkSession, clock: Callable[[], float] = time.time):
        self.spark, self.clock, self.lock = spark, clock, threading.Lock()
        self.running: dict[str, int] = {}
        self.begun: dict[str, deque[float]] = {}

    def run(self, who: UserClass, action: Callable[[SparkSession], Result]) -> Result:
        """Run an action of a class in this thread; its Spark jobs are cancelled when its time is over."""
        with self.lock:
            begun, now = self.begun.setdefault(who.name, deque()), self.clock()
            while begun and begun[0] <= now - 3600:
                begun.popleft()
            if len(begun) >= who.per_hour:
                raise OverLimit(f"{who.name}: {who.per_hour} runs an hour")
            if self.running.get(who.name, 0) >= who.concurrent:
                raise OverLimit(f"{who.name}: {who.concurrent} runs at once")
            begun.append(now)
            self.running[who.name] = self.running.get(who.name, 0) + 1
        context, group, over = self.spark.sparkContext, f"{who.name}-{uuid.uuid4().hex}", threading.Event()

        def cancel() -> None:
            over.set()
            context.cancelJobGroup(group)

        timer = threading.Timer(who.seconds, cancel)
        timer.daemon = True
        context.setJobGroup(group, who.name, interruptOnCancel=True)
        context.setLocalProperty("spark.scheduler.pool", who.pool)
        timer.start()
        try:
            return action(self.spark)
        except Exception as e:
            if over.is_set():
                raise OverLimit(f"{who.name}: {who.seconds:g} s are over") from e
            raise
        finally:
            timer.cancel()
            context.setLocalProperty("spark.scheduler.pool", None)
            context.setLocalProperty("spark.jobGroup.id", None)
            with self.lock:
                self.running[who.name] -= 1
