"""State of jobs, selectors and tasks by key, with timers that need no input to fire.

Jobs are claimed under a lease. A lease that runs out, and a retry that falls
due, are processing-time timers in the state store, so they fire in any
micro-batch after their time and come back from the checkpoint with the state.
"""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener

from corpusloom.operators.sinks import outcomes
from corpusloom.settings import Settings

#: What happens to a job; ``seq`` orders events of one job, ``unit`` (0 to 1) is the share of a retry's jitter.
JOB_EVENTS = "id long, seq long, event string, worker string, unit double"
#: Every change of a job's state, and every event that was refused.
JOB_CHANGES = "id long, seq long, status string, attempts int, worker string, reason string"
SELECTOR_ROWS = "domain string, selector string, last_seen long, quality double, request long"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_state_store(spark: SparkSession) -> SparkSession:
    """``spark``, set to the state store that timers and maps need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return spark


class _Job(StatefulProcessor):
    """One job: status, attempts, who works on it, and until when its lease or its pause lasts (milliseconds, 0 for neither)."""

    def __init__(self, lease_ms: int, s: Settings):
        self.lease_ms, self.s = lease_ms, s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.job = handle.getValueState("job", "status string, attempts int, worker string, until long")

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:
        first = initialState.iloc[0]
        if first["status"] == "processing":  # nobody works on it any more
            self.job.update(("pending", int(first["attempts"]), "", 0))
        else:
            self.job.update((first["status"], int(first["attempts"]), "", 0))

    def _wait(self, until: int) -> None:
        self.handle.registerTimer(until)

    def _stop(self, until: int) -> None:
        if until:
            self.handle.deleteTimer(until)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        for batch in rows:
            out = []
            for seq, event, worker, unit in batch.sort_values("seq")[["seq", "event", "worker", "unit"]].itertuples(index=False):
                known = self.job.get() if self.job.exists() else None
                new, reason = self._next(known, event, worker or "", 0.0 if unit is None or unit != unit else float(unit), now)
                if new is None:
                    if reason:
                        out.append((key[0], seq, known[0] if known else None, known[1] if known else None, worker, reason))
                    continue
                if known:
                    self._stop(known[3])
                if new[3]:
                    self._wait(new[3])
                self.job.update(new)
                out.append((key[0], seq, new[0], new[1], new[2] or None, reason))
            yield _frame(out)

    def _next(self, known: tuple | None, event: str, worker: str, unit: float, now: int) -> tuple[tuple | None, str | None]:
        """The state after an event, None if it changes nothing, and why."""
        if event == "enqueue":
            return (None, None) if known else (("pending", 0, "", 0), None)
        if known is None:
            return None, "refused: no such job"
        status, attempts, owner, until = known
        if event == "claim":
            if status != "pending":
                return None, "refused: " + ("worked on by " + owner if status == "processing" else status)
            return ("processing", attempts, worker, now + self.lease_ms), None
        if status != "processing" or owner != worker:
            return None, "refused: not its worker"
        if event in ("complete", "ignore"):
            return ("completed" if event == "complete" else "ignored", attempts, "", 0), None
        attempts += 1
        if attempts >= self.s.retry_attempts:
            return ("failed", attempts, "", 0), None
        delay = self.s.retry_seconds * 2 ** (attempts - 1)
        delay += unit * min(self.s.retry_jitter, delay * 0.25)
        return ("waiting", attempts, "", now + max(1, int(delay * 1000))), None

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        if not self.job.exists():
            return
        status, attempts, owner, until = self.job.get()
        if until != expiredTimerInfo.getExpiryTimeInMs():
            return
        self.job.update(("pending", attempts, "", 0))
        reason = "lease ran out" if status == "processing" else "due"
        yield _frame([(key[0], -1, "pending", attempts, owner or None, reason)])


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["id", "seq", "status", "attempts", "worker", "reason"])
    return out.astype({"id": "int64", "seq": "int64", "attempts": "Int32"})


def job_states(events: DataFrame, lease_seconds: float = 300.0, s: Settings = Settings(), jobs: DataFrame | None = None) -> DataFrame:
    """A stream of :data:`JOB_EVENTS` (enqueue, claim, complete, ignore, fail) as the changes that they make, :data:`JOB_CHANGES`.

    A pending job goes to the first worker that claims it; other claims, and
    results of a worker that has lost its lease, are refused. A lease that runs
    out makes the job pending again, a failed one is pending after its pause,
    both without any event (``seq`` is -1); after the last attempt it is failed.
    ``jobs`` (id, status, attempts) is the frontier at the start. Events of one
    job are taken by ``seq`` inside a chunk of a micro-batch. The session's
    state store has to be that of :func:`with_state_store`.
    """
    start = None if jobs is None else jobs.select("id", "status", F.coalesce("attempts", F.lit(0)).cast("int").alias("attempts")).groupBy("id")
    return events.groupBy("id").transformWithStateInPandas(_Job(int(lease_seconds * 1000), s), JOB_CHANGES, "append", "processingTime", start)


class _Selectors(StatefulProcessor):
    """One domain's selectors, each forgotten when it has not been seen for a time."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getMapState("selectors", "selector string", "last_seen long, quality double", self.ttl_ms)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        asked: list[int] = []
        for batch in rows:
            new = batch[batch["selector"].notna()].sort_values(["last_seen", "quality"])
            for selector, last_seen, quality in new[["selector", "last_seen", "quality"]].itertuples(index=False):
                old = self.known.getValue((selector,)) if self.known.containsKey((selector,)) else None
                if old is None or old[0] <= last_seen:
                    self.known.updateValue((selector,), (int(last_seen), float(quality)))
            asked += batch.loc[batch["request"].notna(), "request"].astype("int64").tolist()
        if asked:
            held = [(seen[0], selector[0]) for selector, seen in self.known.iterator()]
            best = max(held)[1] if held else None
            yield pd.DataFrame({"request": asked, "domain": [key[0]] * len(asked), "selector": [best] * len(asked)})


def selector_answers(rows: DataFrame, ttl_seconds: float) -> DataFrame:
    """A stream of :data:`SELECTOR_ROWS`, sightings and requests, as (request, domain, selector): the latest selector of the domain, null if none is left.

    A selector is forgotten when it was not seen for ``ttl_seconds``, so the
    state doesn't grow with domains that are no longer crawled. Requests of a
    micro-batch see its sightings. The state store as in :func:`job_states`.
    """
    return rows.groupBy("domain").transformWithStateInPandas(_Selectors(int(ttl_seconds * 1000)), "request long, domain string, selector string", "append", "processingTime")


def task_rounds(tasks: DataFrame, per_batch: int) -> DataFrame:
    """A stream that gives ``tasks`` (idx from 0, and more), ``per_batch`` a micro-batch, from the first again after the last, with their ``round``.

    The stream's offset is the cursor: it is in the checkpoint, so a restart
    goes on where the last one ended and gives each task once a round.
    """
    n = tasks.count()
    if not n:
        raise ValueError("there are no tasks")
    cursor = tasks.sparkSession.readStream.format("rate-micro-batch").option("rowsPerBatch", per_batch).option("numPartitions", 1).option("startTimestamp", 0).load()
    turn = cursor.select((F.col("value") % n).alias("idx"), F.expr(f"value div {n}").alias("round"))
    return turn.join(tasks, "idx")


def counted(rows: DataFrame, name: str = "crawl") -> DataFrame:
    """A stream of pages (reject_reason) whose micro-batches tell a :class:`Progress` their outcomes."""
    return rows.observe(name, *outcomes())


class Progress(StreamingQueryListener):
    """Notices and stops by what the batches of a stream of :func:`counted` pages have told.

    ``send`` gets the counts whenever ``every`` more pages were accepted; the
    query is stopped, in a thread of its own, after ``most`` accepted pages or
    ``seconds``. A callback that fails stops nothing.
    """

    def __init__(self, send: Callable[[dict[str, int]], None], every: int, most: int | None = None, seconds: float | None = None, name: str = "crawl"):
        self.send, self.every, self.most, self.seconds, self.name = send, every, most, seconds, name
        self.total: dict[str, int] = {}
        self.query: Any = None
        self.began = time.monotonic()
        self.ended = False

    def onQueryStarted(self, event: Any) -> None:
        self.began = time.monotonic()

    def onQueryIdle(self, event: Any) -> None:
        self._end()

    def onQueryTerminated(self, event: Any) -> None:
        pass

    def onQueryProgress(self, event: Any) -> None:
        seen = event.progress.observedMetrics.get(self.name)
        if seen is not None:
            before = self.total.get("accepted", 0)
            for k, v in seen.asDict().items():
                self.total[k] = self.total.get(k, 0) + v
            if before // self.every < self.total["accepted"] // self.every:
                try:
                    self.send(dict(self.total))
                except Exception as error:  # noqa: BLE001
                    logging.getLogger(__name__).warning("notice not sent: %s", error)
        self._end()

    def _end(self) -> None:
        enough = self.most is not None and self.total.get("accepted", 0) >= self.most
        late = self.seconds is not None and time.monotonic() - self.began >= self.seconds
        if self.query is not None and not self.ended and (enough or late):
            self.ended = True
            threading.Thread(target=self.query.stop, daemon=True).start()
