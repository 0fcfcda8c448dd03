import time

import pytest
from pyspark.sql import functions as F

from corpusloom.settings import Settings
from corpusloom.streaming import keyed


@pytest.fixture
def stateful(spark):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.streaming.stateStore.providerClass", "spark.sql.shuffle.partitions")}
    keyed.with_state_store(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class Run:
    """A stream over files that are added, its results so far, and its checkpoint."""

    def __init__(self, spark, tmp_path, kind, make):
        self.spark, self.at, self.kind, self.make, self.n = spark, tmp_path, kind, make, 0
        (tmp_path / "in").mkdir()
        self.start()

    def start(self):
        out = self.make(self.spark.readStream.schema(self.kind).json(str(self.at / "in")))
        self.query = out.writeStream.format("json").option("path", str(self.at / "out")).option("checkpointLocation", str(self.at / "state")).trigger(processingTime="300 milliseconds").start()

    def feed(self, *rows):
        self.n += 1
        self.spark.createDataFrame(list(rows), self.kind).coalesce(1).write.mode("append").json(str(self.at / "in"))

    def rows(self, until, seconds=60):
        end = time.time() + seconds
        while True:
            if self.query.exception():
                raise AssertionError(str(self.query.exception())[:2000])
            try:
                got = [r.asDict() for r in self.spark.read.json(str(self.at / "out")).collect()]
            except Exception:  # nothing is there yet
                got = []
            if until(got) or time.time() > end:
                return got
            time.sleep(0.3)


def test_leases_run_out_and_retries_fall_due_without_input(stateful, tmp_path):
    s = Settings(retry_seconds=2.0, retry_jitter=0.0, retry_attempts=2)
    run = Run(stateful, tmp_path, keyed.JOB_EVENTS, lambda e: keyed.job_states(e, lease_seconds=8.0, s=s))
    run.feed((1, 1, "enqueue", None, None), (1, 2, "claim", "a", None), (1, 3, "claim", "b", None), (2, 1, "enqueue", None, None), (2, 2, "claim", "a", None), (2, 3, "fail", "a", 0.0), (2, 4, "claim", "b", None), (3, 9, "claim", "a", None))
    seen = run.rows(lambda got: any(r.get("reason") == "due" for r in got))
    by = lambda i, rows: [(r.get("status"), r.get("attempts"), r.get("reason")) for r in rows if r["id"] == i]
    assert by(2, sorted((r for r in seen if r["seq"] > 0), key=lambda r: r["seq"])) == [("pending", 0, None), ("processing", 0, None), ("waiting", 1, None), ("waiting", 1, "refused: waiting")]
    assert ("pending", 1, "due") in by(2, seen) and by(3, seen) == [(None, None, "refused: no such job")]
    run.query.stop()
    run.start()  # state and timers come back from the checkpoint
    seen = run.rows(lambda got: any(r.get("reason") == "lease ran out" for r in got))
    first = sorted((r for r in seen if r["id"] == 1 and r["seq"] > 0), key=lambda r: r["seq"])
    assert [(r["status"], r.get("reason")) for r in first] == [("pending", None), ("processing", None), ("processing", "refused: worked on by a")]
    assert [r["worker"] for r in seen if r.get("reason") == "lease ran out"] == ["a"]
    run.feed((1, 4, "complete", "a", None), (1, 5, "claim", "c", None), (1, 6, "complete", "c", None), (2, 5, "claim", "b", None), (2, 6, "fail", "b", 0.5))
    seen = run.rows(lambda got: {"completed", "failed"} <= {r.get("status") for r in got})
    run.query.stop()
    assert [r["reason"] for r in seen if r["id"] == 1 and r["seq"] == 4] == ["refused: not its worker"]
    assert {(r["id"], r["attempts"]) for r in seen if r.get("status") in ("completed", "failed")} == {(1, 0), (2, 2)}


def test_jobs_of_the_frontier_are_there_at_the_start(stateful, tmp_path):
    jobs = stateful.createDataFrame([(1, "processing", 1), (2, "completed", None)], "id long, status string, attempts int")
    run = Run(stateful, tmp_path, keyed.JOB_EVENTS, lambda e: keyed.job_states(e, jobs=jobs))
    run.feed((1, 1, "claim", "a", None), (2, 1, "claim", "a", None), (2, 2, "enqueue", None, None))
    got = run.rows(lambda got: len(got) >= 2)
    run.query.stop()
    assert {(r["id"], r["status"], r["attempts"], r.get("reason")) for r in got} == {(1, "processing", 1, None), (2, "completed", 0, "refused: completed")}


def test_selectors_are_forgotten(stateful, tmp_path):
    run = Run(stateful, tmp_path, keyed.SELECTOR_ROWS, lambda r: keyed.selector_answers(r, ttl_seconds=8.0))
    run.feed(("a", ".x", 1, 0.5, None), ("a", ".y", 3, 0.6, None), ("a", ".z", 2, 0.9, None), ("a", None, None, None, 1), ("b", None, None, None, 2))
    assert {r["request"]: r.get("selector") for r in run.rows(lambda got: len(got) == 2)} == {1: ".y", 2: None}
    time.sleep(10)
    run.feed(("a", None, None, None, 3))
    got = {r["request"]: r.get("selector") for r in run.rows(lambda got: len(got) == 3)}
    run.query.stop()
    assert got[3] is None


def test_each_task_once_a_round_over_restarts(spark, tmp_path):
    tasks = spark.createDataFrame([(i, f"t{i}") for i in range(7)], "idx long, task string")

    def step(batch, n):
        batch.withColumn("batch", F.lit(n)).write.mode("overwrite").parquet(str(tmp_path / "out" / str(n)))

    for _ in range(2):
        query = keyed.task_rounds(tasks, 3).writeStream.foreachBatch(step).option("checkpointLocation", str(tmp_path / "state")).trigger(processingTime="200 milliseconds").start()
        began = len(list((tmp_path / "out").glob("*/_SUCCESS"))) if (tmp_path / "out").exists() else 0
        end = time.time() + 60
        while time.time() < end and len(list((tmp_path / "out").glob("*/_SUCCESS"))) < began + 4:
            time.sleep(0.2)
        query.stop()
    rows = [r for p in sorted((tmp_path / "out").glob("*")) if (p / "_SUCCESS").exists() for r in spark.read.parquet(str(p)).collect()]
    whole = max(r["round"] for r in rows)
    assert whole >= 2 and max(sum(r["batch"] == b for r in rows) for b in {r["batch"] for r in rows}) == 3
    done = sorted((r["round"], r["idx"]) for r in rows if r["round"] < whole)
    assert done == [(k, i) for k in range(whole) for i in range(7)]


def test_notices_at_every_nth_success_and_a_stop(spark, tmp_path):
    kind = "id long, reject_reason string"
    for part in range(6):
        spark.createDataFrame([(part * 10 + i, "x" if i == 0 else None) for i in range(5)], kind).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    sent = []
    listener = keyed.Progress(sent.append, every=5, most=12)
    spark.streams.addListener(listener)
    try:
        rows = keyed.counted(spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in")))
        query = rows.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "state")).trigger(processingTime="2 seconds").start()
        listener.query = query
        assert query.awaitTermination(90)
    finally:
        spark.streams.removeListener(listener)
    assert [s["accepted"] for s in sent][:2] == [8, 12] and sent[0]["skipped"] == 2 and 12 <= listener.total["accepted"] < 24
