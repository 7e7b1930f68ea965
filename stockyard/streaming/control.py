"""Pause and resume of streaming queries, with the checks that keep two of them off one checkpoint.

The registry is a folder that all drivers see. A job's lock is a file that only one caller can create; its state file
says how the last run ended, from which batch it goes on, and what the job was (a fingerprint of its plan's inputs), so
that a changed job is not resumed on a state that was made for another.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from ..sources.shared import Files


class Refused(RuntimeError):
    """A start or resume that a safety check forbids."""


@dataclass(frozen=True)
class Job:
    """start: starts the query with the checkpoint that it is given. definition: what must stay the same over resumes."""

    name: str
    checkpoint: str
    start: Callable[[str], StreamingQuery]
    definition: str

    @property
    def fingerprint(self) -> str:
        return hashlib.sha256(self.definition.encode()).hexdigest()


class Registry:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.files = spark, path.rstrip("/"), Files(spark)

    def _state(self, name: str) -> dict | None:
        text = self.files.text(f"{self.path}/{name}/state.json")
        return json.loads(text) if text else None

    def _put(self, name: str, **state) -> None:
        self.files.create(f"{self.path}/{name}/state.json", json.dumps(state), overwrite=True)

    def _begin(self, job: Job, checkpoint: str, **more) -> StreamingQuery:
        owner = json.dumps({"application": self.spark.sparkContext.applicationId, "checkpoint": checkpoint})
        if not self.files.create(f"{self.path}/{job.name}/lock", owner):
            raise Refused(f"{job.name} is running: {self.files.text(f'{self.path}/{job.name}/lock')}")
        try:
            for other in self.files.folders(self.path):
                state = self._state(other)
                if other != job.name and state and state["state"] == "running" and state["checkpoint"] == checkpoint:
                    raise Refused(f"{other} uses the checkpoint {checkpoint}")
            query = job.start(checkpoint)
        except Exception:
            self.files.delete(f"{self.path}/{job.name}/lock")
            raise
        self._put(job.name, state="running", checkpoint=checkpoint, fingerprint=job.fingerprint, query=str(query.id), **more)
        return query

    def start(self, job: Job) -> StreamingQuery:
        """A first start. Refused if the job runs, or if it was paused: then `resume` it."""
        state = self._state(job.name)
        if state and state["state"] == "paused":
            raise Refused(f"{job.name} is paused after batch {state['batch']}; resume it")
        return self._begin(job, job.checkpoint)

    def pause(self, job: Job, query: StreamingQuery, timeout: float = 600) -> int | None:
        """Stop between two batches: wait for the one under way, then stop. Returns the last committed batch."""
        until = time.time() + timeout
        while query.isActive and query.status["isTriggerActive"] and not query.status["message"].startswith("Waiting"):
            if time.time() > until:
                raise TimeoutError(f"{job.name} has not ended its batch in {timeout:g} s; it goes on")
            time.sleep(0.05)
        query.stop()
        failed = query.exception()
        batch = self.committed(self._state(job.name)["checkpoint"])
        self._put(job.name, state="failed" if failed else "paused", checkpoint=self._state(job.name)["checkpoint"], fingerprint=job.fingerprint, query=str(query.id), batch=batch)
        self.files.delete(f"{self.path}/{job.name}/lock")
        return batch

    def committed(self, checkpoint: str) -> int | None:
        """The last batch whose commit is in the checkpoint."""
        store, at = self.files._at(f"{checkpoint}/commits")
        names = [x.getPath().getName() for x in store.listStatus(at)] if store.exists(at) else []
        return max((int(n) for n in names if n.isdigit()), default=None)

    def resume(self, job: Job, checkpoint: str | None = None) -> StreamingQuery:
        """Go on from the pause, or from another checkpoint of the job.

        Refused if the job runs, was never started, has changed since, or if the checkpoint has no metadata or lies
        behind the batch that the pause saw.
        """
        state = self._state(job.name)
        if state is None:
            raise Refused(f"{job.name} was never started")
        if state["fingerprint"] != job.fingerprint:
            raise Refused(f"{job.name} has changed since its pause")
        at = checkpoint or state["checkpoint"]
        if not self.files.exists(f"{at}/metadata"):
            raise Refused(f"{at} is no checkpoint")
        seen, there = state.get("batch"), self.committed(at)
        if checkpoint is None and seen is not None and (there is None or there < seen):
            raise Refused(f"{at} ends at batch {there}, the pause was after batch {seen}")
        return self._begin(job, at, batch=there)

    def finish(self, job: Job, query: StreamingQuery) -> None:
        """After a bounded query has ended by itself."""
        query.awaitTermination()
        self.pause(job, query)

    def unlock(self, job: Job) -> None:
        """For an operator who knows that the owner of the lock is dead."""
        self.files.delete(f"{self.path}/{job.name}/lock")

    def status(self) -> DataFrame:
        rows = []
        for name in self.files.folders(self.path):
            state = self._state(name)
            if state:
                rows.append((name, state["state"], state["checkpoint"], self.committed(state["checkpoint"]), self.files.exists(f"{self.path}/{name}/lock")))
        return self.spark.createDataFrame(rows, "name string, state string, checkpoint string, batch bigint, locked boolean")
