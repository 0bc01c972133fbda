"""Streaming jobs that run the batch operators on each micro-batch."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from playerflow.operators import rules as R
from playerflow.operators import webpush as W
from playerflow.streaming.state import BatchOutput, BatchState


def run(
    stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None, mode: str = "append"
) -> StreamingQuery:
    """Start a micro-batch job: on a schedule with ``every``, else over all that is available."""

    def guarded(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            step(kept, batch_id)
        finally:
            kept.unpersist()

    writer = stream.writeStream.outputMode(mode).foreachBatch(guarded).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def run_closed(build: Callable[[DataFrame], DataFrame], close: DataFrame, folder: str, step: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """A job over all rows that are there, whose event time is then closed by the rows of ``close``.

    Event time only moves with rows. ``build`` makes the stream and unions the closing
    source into it, which is empty until the others are read to their end.
    """
    spark = close.sparkSession
    close.limit(0).write.parquet(folder)
    stream = build(spark.readStream.schema(close.schema).parquet(folder))
    finish(run(stream, step, checkpoint))
    close.write.mode("append").parquet(folder)
    finish(run(stream, step, checkpoint))


def finish(query: StreamingQuery, timeout: int | None = None) -> None:
    """Wait for an ``availableNow`` job and pass on its error; without ``timeout`` as long as it takes."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError("streaming job did not finish")


def web_push(zones: DataFrame, event_time: str, state: BatchState, output: BatchOutput):
    """Slot messages of each batch, which go on from the last time of each slot."""
    keys = state.keys
    slots = {f"last_{name}": slot for slot, name, _, _ in W.SLOTS}
    schema = ", ".join(f"{k} bigint" for k in keys) + ", second bigint, selector string"

    def step(batch: DataFrame, batch_id: int) -> None:
        prior = state.touched(batch, batch_id)
        output.write(W.web_push(batch.join(prior, keys, "left"), zones, event_time, seed=True), batch_id)
        sent = output.read(schema).filter(F.col("batch") == batch_id)
        times = sent.groupBy(*keys).agg(*[F.max(F.when(F.col("selector") == slot, F.col("second"))).alias(f"new_{n}") for n, slot in slots.items()])
        # Null where a slot was never sent; greatest() passes over nulls.
        state.write(times.join(prior, keys, "left").select(*keys, *[F.greatest(f"new_{n}", n).alias(n) for n in slots]), batch_id)

    return step


def recheck_rules(requests: DataFrame, deposits: BatchOutput, fired: BatchOutput, schema, whole: bool = False):
    """Evaluate the active requests of the players a batch touches (or of all players).

    Deposits accumulate in folders per batch and day, of which only the days
    that an active window can reach are read. Fired requests are retired.
    """
    spark = requests.sparkSession

    def step(batch: DataFrame, batch_id: int) -> None:
        by_day = batch.withColumn("day", F.floor(F.col("second") / F.lit(86400)))
        deposits.write(by_day, batch_id, "day")
        done = fired.read(schema).filter(f"batch < {batch_id}") if batch_id else spark.createDataFrame([], schema)
        active = R.retire(requests, done)
        players = batch.select("player_id").distinct().hint("merge")
        if not whole:
            active = active.join(players, "player_id", "left_semi")
        accepted, _ = R.normalise(active)
        reach = accepted.agg(F.min(F.unix_seconds("from_ts")).alias("a"), F.max(F.unix_seconds("to_ts")).alias("b")).first()
        if reach["a"] is None:
            fired.write(spark.createDataFrame([], schema), batch_id)
            return
        history = deposits.read(by_day.schema).filter(
            f"batch <= {batch_id} AND day BETWEEN {reach['a'] // 86400} AND {reach['b'] // 86400}"
        )
        if not whole:
            history = history.join(players, "player_id", "left_semi")
        fired.write(R.evaluate(accepted, history), batch_id)

    return step


def deliver(ledger: BatchOutput, output: BatchOutput):
    """Outbox delivery: a message id goes out once, even when a batch or a message is repeated.

    A message id stands for one source row, so all its repeats carry the same
    ``event_ts``. The ledger is kept by that day, and a batch looks up the days
    of its own messages: however many batches lie between, a repeat is found.
    """
    schema = "dedup_id string, batch bigint, day string"

    def step(batch: DataFrame, batch_id: int) -> None:
        day = F.coalesce(F.date_format("event_ts", "yyyy-MM-dd"), F.lit("none"))
        fresh = batch.dropDuplicates(["dedup_id"]).withColumn("day", day)
        if batch_id:
            days = [r["day"] for r in fresh.select("day").distinct().collect()]
            sent = ledger.read(schema).filter((F.col("batch") < batch_id) & F.col("day").isin(days))
            fresh = fresh.join(sent.select("dedup_id"), "dedup_id", "left_anti").select(*fresh.columns)
        output.write(fresh.drop("day"), batch_id)
        ledger.write(fresh.select("dedup_id", "day"), batch_id, "day")

    return step


def to_json_files(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Continuous JSON files, exactly once by the sink's own commit log."""
    return stream.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def in_hours(now: Column, first: int, last: int) -> Column:
    """Gate of a scheduled job: the UTC hour lies in ``[first, last)``."""
    return (F.hour(now) >= first) & (F.hour(now) < last)


class ScheduledExport:
    """Exports of what changed since the last one, from a job that a schedule starts.

    An export is a folder named by its moment, and counts from the writer's own
    commit mark on. The next one begins where the last that counts ended, so a
    failed export is repeated with all that came in meanwhile, and nothing is
    exported twice. Outside the hours nothing happens.
    """

    def __init__(self, spark: SparkSession, path: str, first_hour: int = 4, last_hour: int = 12):
        self.spark, self.path, self.hours = spark, path.rstrip("/"), (first_hour, last_hour)

    def mark(self) -> int | None:
        """Microseconds up to which rows are exported."""
        paths = self.spark._jvm.org.apache.hadoop.fs.Path
        root = paths(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        done = fs.globStatus(paths(f"{self.path}/until=*/_SUCCESS")) if fs.exists(root) else None
        return max((int(s.getPath().getParent().getName().removeprefix("until=")) for s in done or []), default=None)

    def run(self, now: datetime, snapshot: Callable[[Column], DataFrame], touched: str = "updated_ts") -> bool:
        """Writes the rows of ``snapshot`` that were touched after the mark and up to ``now``.

        ``snapshot`` takes the condition on a row's time that bounds it by ``now`` and
        gives rows with the time of their last change; whether an export was written.
        """
        if not self.hours[0] <= now.hour < self.hours[1]:
            return False
        until, mark = int(now.replace(tzinfo=timezone.utc).timestamp()) * 1_000_000 + now.microsecond, self.mark()
        if mark is not None and until <= mark:
            return False
        rows = snapshot(F.col("ts") <= F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz"))
        if mark is not None:
            rows = rows.filter(F.unix_micros(F.col(touched).cast("timestamp")) > mark)
        rows.write.mode("overwrite").json(f"{self.path}/until={until}")
        return True


def stream_session(spark: SparkSession) -> None:
    """State settings for the stateful jobs: RocksDB, unless the session chose a provider."""
    key = "spark.sql.streaming.stateStore.providerClass"
    rocks = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    if spark.conf.get(key, "") != rocks:
        spark.conf.set(key, rocks)
