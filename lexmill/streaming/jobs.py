"""Structured Streaming over an events folder: windows with watermarks, duplicates, joins, count windows and sessions with state, change feeds."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lexmill.scale import new_folder

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def read_events(spark: SparkSession, folder: str, files_per_trigger: int = 1, schema: str = EVENTS) -> DataFrame:
    """Parquet files of a folder as they come."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def tumbling(events: DataFrame, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums by window and type; rows later than the watermark are dropped, windows are put out once they are closed."""
    w = events.withWatermark("ts", late).groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return w.select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sliding(events: DataFrame, size: str = "1 hour", step: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    w = events.withWatermark("ts", late).groupBy(F.window("ts", size, step).alias("w")).agg(F.count("*").alias("n"), F.max("value").alias("top"))
    return w.select(F.col("w.start").alias("start"), "n", "top")


def sessions(events: DataFrame, gap: str = "2 hours", late: str = "10 minutes") -> DataFrame:
    w = events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))
    return w.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("finish"), "n")


def without_repeats(events: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Rows whose id came before, within the watermark, are dropped."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def followed(events: DataFrame, first: str = "error", then: str = "view", within: str = "15 minutes", late: str = "10 minutes") -> DataFrame:
    """Pairs of a user's rows of two types, the second within an interval of the first: an interval join of the stream with itself."""
    a = events.filter(F.col("event_type") == first).select(F.col("event_id").alias("a_id"), F.col("user_id").alias("a_user"), F.col("ts").alias("a_ts")).withWatermark("a_ts", late)
    b = events.filter(F.col("event_type") == then).select(F.col("event_id").alias("b_id"), F.col("user_id").alias("b_user"), F.col("ts").alias("b_ts")).withWatermark("b_ts", late)
    return a.join(b, F.expr(f"a_user = b_user AND b_ts BETWEEN a_ts AND a_ts + INTERVAL {within}")).select("a_id", "b_id")


def count_windows(events: DataFrame, size: int = 20) -> DataFrame:
    """user_id, batch, n, total: each `size` rows of a user make a batch, oldest first; what is left waits in the state."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        batch, n, total = state.get if state.exists else (0, 0, 0.0)
        out = []
        for pdf in batches:
            for v in pdf.sort_values(["ts", "event_id"])["value"]:
                n, total = n + 1, total + float(v)
                if n == size:
                    batch += 1
                    out.append((key[0], batch, n, total))
                    n, total = 0, 0.0
        state.update((batch, n, total))
        yield pd.DataFrame(out, columns=["user_id", "batch", "n", "total"])

    return events.groupBy("user_id").applyInPandasWithState(step, "user_id long, batch long, n long, total double", "batch long, n long, total double", "append", GroupStateTimeout.NoTimeout)


def turn_sessions(events: DataFrame, turns: int = 4) -> DataFrame:
    """user_id, session, start, finish, turns: a session closes after so many turns, whatever the gaps."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        session, n, start = state.get if state.exists else (1, 0, None)
        out = []
        for pdf in batches:
            for ts in pdf.sort_values(["ts", "event_id"])["ts"]:
                start = ts if n == 0 else start
                n += 1
                if n == turns:
                    out.append((key[0], session, start, ts, n))
                    session, n, start = session + 1, 0, None
        state.update((session, n, start))
        yield pd.DataFrame(out, columns=["user_id", "session", "start", "finish", "turns"])

    return events.groupBy("user_id").applyInPandasWithState(step, "user_id long, session long, start timestamp, finish timestamp, turns long", "session long, n long, start timestamp", "append", GroupStateTimeout.NoTimeout)


def retold(events: DataFrame, keep: int = 5) -> DataFrame:
    """user_id, seen, recent: a state folded row by row: how many rows there were and the last few types."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, recent = state.get if state.exists else (0, "")
        for pdf in batches:
            for kind in pdf.sort_values(["ts", "event_id"])["event_type"]:
                seen, recent = seen + 1, ",".join([*recent.split(",")[-keep + 1 :], kind]).strip(",")
        state.update((seen, recent))
        yield pd.DataFrame([(key[0], seen, recent)], columns=["user_id", "seen", "recent"])

    return events.groupBy("user_id").applyInPandasWithState(step, "user_id long, seen long, recent string", "seen long, recent string", "update", GroupStateTimeout.NoTimeout)


def digests(rows: DataFrame, key: str, *columns: str) -> DataFrame:
    """key and an order-independent digest of all its visible rows."""
    return rows.groupBy(key).agg(F.bit_xor(F.xxhash64(*columns)).alias("x"), F.count("*").alias("c"))


def feed(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """Keys whose digest moved since the earlier snapshot, new ones included."""
    o = old.select(key, F.col("x").alias("_x"), F.col("c").alias("_c"))
    return new.join(o, key, "left").filter(~(F.col("x").eqNullSafe(F.col("_x")) & F.col("c").eqNullSafe(F.col("_c")))).select(key)


def run_once(df: DataFrame, mode: str = "append") -> DataFrame:
    """Runs what is there to its end into a table of the shared folder and returns a read of it."""
    spark = df.sparkSession
    path = new_folder(spark, "stream")
    q = df.writeStream.format("parquet").outputMode(mode).option("path", f"{path}/rows").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{path}/rows")


def run_updates(df: DataFrame, key: str) -> DataFrame:
    """Runs an update-mode stream to its end and returns the newest row of each key.

    Every micro-batch adds the rows it changed under its number, which a batch that runs again overwrites; the reader takes the last number."""
    spark = df.sparkSession
    path = new_folder(spark, "stream")

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/rows/batch={number}")

    q = df.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    rows = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("batch", T.LongType())])).parquet(f"{path}/rows")
    rest = [c for c in df.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), "batch").alias("s")).select(key, "s.*")


def partial_rows(events: DataFrame, stale: int = 600) -> DataFrame:
    """user_id, n, last, stale: a live row for each user, told by update-mode batches. A row is stale if its last event lies more than so many seconds
    before the newest of all."""
    live = run_updates(events.groupBy("user_id").agg(F.count("*").alias("n"), F.max("ts").alias("last")), "user_id")
    newest = live.agg(F.max("last").alias("_newest"))
    return live.join(F.broadcast(newest)).withColumn("stale", F.col("last") < F.col("_newest") - F.make_interval(secs=F.lit(stale))).drop("_newest")  # one row


def mirror(events: DataFrame, path: str, key: str = "user_id"):
    """Keeps the newest row of each key: every micro-batch writes the whole table anew under its number, from the one before it.

    A batch that is run again after a failure writes the same rows to the same place; the table before the last one is deleted. For tables too large
    to be written in every batch, run_updates adds changed rows only and leaves it to the reader to take the newest."""

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{number - 1}")
        there = number > 0 and before.getFileSystem(spark._jsc.hadoopConfiguration()).exists(before)
        old = spark.read.schema(batch.schema).parquet(f"{path}/{number - 1}") if there else batch.limit(0)
        rest = [c for c in batch.columns if c not in ("ts", "event_id", key)]
        best = old.unionByName(batch).groupBy(key).agg(F.max(F.struct("ts", "event_id", *rest)).alias("s"))
        best.select(key, "s.*").select(*batch.columns).write.mode("overwrite").parquet(f"{path}/{number}")
        older = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{number - 2}")
        if number > 1:
            older.getFileSystem(spark._jsc.hadoopConfiguration()).delete(older, True)

    return events.writeStream.foreachBatch(put).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
