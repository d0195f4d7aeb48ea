"""Packet streams with Structured Streaming.

Records carry Kafka's schema: ``key`` (8-byte big-endian microseconds),
``value`` (the Ethernet frame), ``topic``, ``partition``, ``offset``,
``timestamp``. ``read_packet_stream`` reads a Kafka topic when a broker is
given, else a folder of Parquet files with the same columns (the Kafka
connector jar is not bundled here; the code after the source is identical).

* J2 ``minute_counts_stream``: records per minute (minute from the record
  key) as a tumbling event-time window with a watermark; append mode emits
  each minute once, after the watermark passes it, and drops its state.
* J3 ``idle_flush_counts``: keyed state per minute with a processing-time
  idle timeout; a key's count is emitted when it has been idle for the
  timeout, and its state dropped (a late key starts again).
* J7 + A10 ``packet_key_stream``: stateless decode -> time-slot key -> cells,
  written by an exactly-once file sink with a checkpoint (``run_to_files``) or
  into the packet table with a commit record per batch (``run_to_table``).
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from flowlens.functions.bytesx import be_bytes, bytes_to_int
from flowlens.functions.keys import lineage_suffix, timeslot_key, tuple_bytes
from flowlens.functions.timex import ntz_from_micros
from flowlens.operators.cells import CELL_COLUMNS
from flowlens.operators.decode import decode_packets, five_tuple_cols
from flowlens.sources.tables import (
    PACKET_REGIONS, _hadoop_fs, in_key_range, packet_bucket, place_by_key, regions_between,
)

STREAM_SCHEMA = ("key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, "
                 "timestamp TIMESTAMP")
# Fixed values (the reference's stream settings): topic, 1-second
# micro-batches (J1), 5 minutes of retained data (J5), 2-second idle
# timeout (J3).
DEFAULT_TOPIC = "test"
TRIGGER_INTERVAL = "1 second"
RETENTION = "5 minutes"
IDLE_TIMEOUT_MS = 2000
MICROS_PER_MINUTE = 60_000_000
# A record far in the future that closes every real window of a bounded
# replay (2100-01-01T00:00:00Z in microseconds).
CLOSING_MICROS = 4_102_444_800_000_000


def packet_records(frames: DataFrame, topic: str = DEFAULT_TOPIC, partition: int = 0,
                   offset_col: str = "pkt_id") -> DataFrame:
    """Batch packets -> broker-shaped records (key = 8-byte microseconds)."""
    us = F.col("ts_sec") * 1_000_000 + F.col("ts_usec")
    return frames.select(be_bytes(us, 8).alias("key"), F.col("raw").alias("value"),
                         F.lit(topic).alias("topic"), F.lit(partition).alias("partition"),
                         F.col(offset_col).cast("bigint").alias("offset"),
                         F.timestamp_micros(us).alias("timestamp"))


def closing_record(spark: SparkSession, topic: str = DEFAULT_TOPIC) -> DataFrame:
    return spark.createDataFrame(
        [(CLOSING_MICROS.to_bytes(8, "big"), b"", topic, 0, -1)],
        "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT",
    ).withColumn("timestamp", F.timestamp_micros(F.lit(CLOSING_MICROS)))


def read_packet_stream(spark: SparkSession, path: str | None = None, kafka_servers: str | None = None,
                       topic: str = DEFAULT_TOPIC, max_files_per_trigger: int | None = None,
                       max_bytes_per_trigger: int | None = None, starting_offsets: str = "latest") -> DataFrame:
    """A6 + J6: streaming records. Kafka starts at ``starting_offsets`` without
    committing offsets (the checkpoint tracks progress, J4). A folder's
    micro-batches are bounded by files or by bytes."""
    if kafka_servers:
        return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", kafka_servers)
                .option("subscribe", topic).option("startingOffsets", starting_offsets).load())
    r = spark.readStream.schema(STREAM_SCHEMA).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    return r.parquet(path)


def replay(spark: SparkSession, data: str, base: str, counts: Callable[[DataFrame, str], DataFrame],
           max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None,
           run: Callable[..., StreamingQuery] | None = None,
           before_close: Callable[[], None] | None = None) -> DataFrame:
    """Run ``counts(stream, retention)`` over all records of folder ``data`` in
    bounded micro-batches and return its output (under ``base``).

    The files of a folder come in no order of time, so the retention is the
    whole time the records span: no record is late, and the state is one row
    per minute of that time. The closing record comes in a second run on the
    same checkpoint, when every record has been counted. An empty folder
    gives no row. By default a micro-batch holds 256 MiB for each task slot.
    ``run`` starts the queries (default ``run_to_files``); ``before_close`` is
    called between the two runs.
    """
    run = run or run_to_files
    us = record_micros(F.col("key"))
    lo, hi = spark.read.schema(STREAM_SCHEMA).parquet(data).agg(F.min(us), F.max(us)).first()
    retention = f"{((hi - lo) // MICROS_PER_MINUTE + 2) if lo is not None else 1} minutes"
    if not (max_files_per_trigger or max_bytes_per_trigger):
        max_bytes_per_trigger = spark.sparkContext.defaultParallelism << 28
    close, end = f"{base}/close", closing_record(spark)
    end.limit(0).write.parquet(close)
    stream = read_packet_stream(spark, data, max_files_per_trigger=max_files_per_trigger,
                                max_bytes_per_trigger=max_bytes_per_trigger)
    out = counts(stream.unionByName(read_packet_stream(spark, close)), retention)
    run(out, f"{base}/out", f"{base}/ck").awaitTermination()
    if before_close:
        before_close()
    end.write.mode("append").parquet(close)
    run(out, f"{base}/out", f"{base}/ck").awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{base}/out")


def record_micros(key: Column) -> Column:
    """Microseconds from the 8-byte big-endian record key."""
    return bytes_to_int(key)


def minute_counts_stream(stream: DataFrame, retention: str = RETENTION) -> DataFrame:
    """J2 + J5: records per minute of the key's time (event time).

    Late records up to ``retention`` behind the newest seen are still counted;
    later ones are dropped, like the reference's 5-minute memory.
    """
    et = F.timestamp_micros(record_micros(F.col("key")))
    w = (stream.select(et.alias("et")).withWatermark("et", retention)
               .groupBy(F.window("et", "1 minute")).agg(F.count(F.lit(1)).alias("count")))
    return w.select(ntz_from_micros(F.unix_micros(F.col("window.start"))).alias("minute"), "count")


def _count_until_idle(timeout_ms: int):
    def fn(key, pdfs, state):
        if state.hasTimedOut:
            (n,) = state.get
            state.remove()
            yield pd.DataFrame({"minute": [int(key[0])], "count": [int(n)]})
            return
        n = state.get[0] if state.exists else 0
        for pdf in pdfs:
            n += int(pdf["n"].sum())
        state.update((n,))
        state.setTimeoutDuration(timeout_ms)
    return fn


def _precount(batches):
    """Minute counts of each Arrow batch (a map-side combine before the state
    shuffle): at most one row per (batch, minute) leaves the task."""
    for pdf in batches:
        if len(pdf):
            c = pdf.groupby("m", sort=False).size()
            yield pd.DataFrame({"m": c.index.astype("int64"), "n": c.values.astype("int64")})


def _precount_et(batches):
    """Like ``_precount``, keeping the newest event time of each minute."""
    for pdf in batches:
        if len(pdf):
            g = pdf.groupby("m", sort=False)["us"].agg(["size", "max"])
            yield pd.DataFrame({"m": g.index.astype("int64"), "n": g["size"].values.astype("int64"),
                                "us": g["max"].values.astype("int64")})


def _count_until_event_idle(timeout_ms: int):
    def fn(key, pdfs, state):
        if state.hasTimedOut:
            (n, _) = state.get
            state.remove()
            yield pd.DataFrame({"minute": [int(key[0])], "count": [int(n)]})
            return
        n, last = state.get if state.exists else (0, 0)
        for pdf in pdfs:
            n += int(pdf["n"].sum())
            last = max(last, int(pdf["us"].max()))
        state.update((n, last))
        state.setTimeoutTimestamp(last // 1000 + timeout_ms)
    return fn


def idle_flush_counts_event_time(stream: DataFrame, timeout_ms: int = IDLE_TIMEOUT_MS,
                                 retention: str = RETENTION) -> DataFrame:
    """J3 on event time: a minute's count is emitted once the watermark has
    passed its newest record by ``timeout_ms`` (no wall clock, so a bounded
    replay gives the same result every time). Same pre-count as
    ``idle_flush_counts``.

    The watermark runs on minutes (a record's minute, not its microsecond):
    all records of a minute are late or none, so the pre-count cannot change
    which late records count. A minute is late when it is more than
    ``retention`` (whole minutes) before the newest minute: a row at the
    watermark itself counts as late, hence the minute on top."""
    from flowlens.session import ship_package
    ship_package(stream.sparkSession)
    us = record_micros(F.col("key"))
    keyed = stream.select(F.floor(us / MICROS_PER_MINUTE).cast("bigint").alias("m"), us.alias("us"))
    pre = keyed.mapInPandas(_precount_et, "m BIGINT, n BIGINT, us BIGINT")
    minute = F.timestamp_micros(F.col("m") * MICROS_PER_MINUTE)
    pre = pre.withColumn("et", minute).withWatermark("et", f"{retention} 1 minute")
    out = pre.groupBy("m").applyInPandasWithState(
        _count_until_event_idle(timeout_ms), "minute BIGINT, count BIGINT", "n BIGINT, last BIGINT", "append",
        GroupStateTimeout.EventTimeTimeout)
    return out.select(ntz_from_micros(F.col("minute") * MICROS_PER_MINUTE).alias("minute"), "count")


def idle_flush_counts(stream: DataFrame, timeout_ms: int = IDLE_TIMEOUT_MS) -> DataFrame:
    """J3 + C7: per-minute counts emitted when a minute has been idle for
    ``timeout_ms``; only expired keys produce output (append mode).

    Records are pre-counted per Arrow batch (stateless
    ``mapInPandas``), so a hot minute reaches the stateful operator as a few
    partial counts, not as all of its rows; the state function streams over
    them without holding a group in memory.

    Unlike the reference, the first record counts (its state starts at 1,
    quirk Q6) and the minute is emitted with the count (quirk Q7).
    """
    from flowlens.session import ship_package
    ship_package(stream.sparkSession)
    keyed = stream.select(F.floor(record_micros(F.col("key")) / MICROS_PER_MINUTE).cast("bigint").alias("m"))
    keyed = keyed.mapInPandas(_precount, "m BIGINT, n BIGINT")
    out = keyed.groupBy("m").applyInPandasWithState(
        _count_until_idle(timeout_ms), "minute BIGINT, count BIGINT", "n BIGINT", "append",
        GroupStateTimeout.ProcessingTimeTimeout)
    return out.select(ntz_from_micros(F.col("minute") * MICROS_PER_MINUTE).alias("minute"), "count")


def packet_key_stream(stream: DataFrame, source_id: int = 0, width_s: int = 60) -> DataFrame:
    """Record -> (time-slot key, packet cell). Stateless: decode, 5-tuple,
    key; the suffix comes from (topic, partition, offset), so a replay after
    a failure rewrites the same keys."""
    pk = decode_packets(stream, "value")
    t = pk.select("value", "topic", "partition", "offset",
                  F.unix_millis(F.col("timestamp")).alias("ts_ms"), *five_tuple_cols())
    tup = tuple_bytes(F.col("sip"), F.col("dip"), F.col("sport"), F.col("dport"), F.col("proto"))
    key = timeslot_key(tup, F.col("ts_ms"), F.lit(source_id), width_s,
                       lineage_suffix("topic", "partition", "offset"))
    return t.select(key.alias("rowkey"), F.lit("p").alias("cf"), F.encode(F.lit("r"), "UTF-8").alias("cq"),
                    F.col("ts_ms").cast("bigint").alias("version"), F.col("value").alias("value"))


def run_to_files(df: DataFrame, path: str, checkpoint: str, mode: str = "append",
                 available_now: bool = True, partition_by: list[str] | None = None,
                 state_partitions: int | None = None) -> StreamingQuery:
    """A10 + J1 + J4: file sink (exactly once via the checkpoint's commit log).
    ``available_now`` processes what is there and stops (bounded runs and
    tests); otherwise 1-second micro-batches run until stopped.

    ``state_partitions`` (default: the cluster's task slots) is the number
    of state-store partitions of a stateful query. It is fixed in the
    checkpoint when the query first starts, so it is applied only while the
    query starts; the session's own setting is restored right after."""
    w = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    w = w.outputMode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=TRIGGER_INTERVAL)
    spark = df.sparkSession
    n = state_partitions or spark.sparkContext.defaultParallelism
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        return w.start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


COMMIT_SCHEMA = "query STRING, batch BIGINT"


def _checkpoint_query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark keeps in a checkpoint: the same after a restart, another
    one for a new checkpoint (whose batches start at 0 again)."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def put_batch(cells: DataFrame, path: str, query: str, batch: int, spread: int = 1) -> bool:
    """A10: one micro-batch of cells into the region-partitioned table below
    ``path``, exactly once; False if it is there already.

    Rows go to ``data/query=/batch=/key_bucket=``, placed by literal key
    boundaries and sorted by key; then a commit record is published by a
    rename. A batch without its record is written over; one that has it is left
    alone. Readers see committed batches only (``read_stream_table``)."""
    spark = cells.sparkSession
    record = f"{path}/commits/{query}-{batch}.json"
    fs, final, jvm = _hadoop_fs(spark, record)
    if fs.exists(final):
        return False
    rows = cells.select(*CELL_COLUMNS, packet_bucket("rowkey").alias("key_bucket"))
    (place_by_key(rows, PACKET_REGIONS, spread).sortWithinPartitions("key_bucket", "rowkey")
        .write.mode("overwrite").partitionBy("key_bucket").parquet(f"{path}/data/query={query}/batch={batch}"))
    tmp = jvm.org.apache.hadoop.fs.Path(f"{path}/commits/.{query}-{batch}")
    out = fs.create(tmp, True)
    out.write(bytearray(json.dumps({"query": query, "batch": batch}).encode()))
    out.close()
    if not fs.rename(tmp, final) and not fs.exists(final):
        raise RuntimeError(f"no commit record {record}")
    return True


def run_to_table(df: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                 spread: int = 1) -> StreamingQuery:
    """A10 + J1 + J4: stream of cells -> packet table through ``put_batch``.
    A batch that Spark runs again after a failure adds nothing."""
    ids: list[str] = []

    def put(cells: DataFrame, batch: int) -> None:
        if not ids:
            ids.append(_checkpoint_query_id(cells.sparkSession, checkpoint))
        put_batch(cells, path, ids[0], batch, spread)

    w = df.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=TRIGGER_INTERVAL)).start()


def read_stream_table(spark: SparkSession, path: str, start: bytes | None = None,
                      stop: bytes | None = None) -> DataFrame:
    """A3 over a streamed table: cells of the committed batches, optionally of
    the rows from ``start`` up to but not ``stop``. A table without a committed
    batch is empty."""
    schema = "rowkey BINARY, cf STRING, cq BINARY, version BIGINT, value BINARY"
    fs, data, jvm = _hadoop_fs(spark, f"{path}/data")
    if not fs.exists(data) or not fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/commits")):
        return spark.createDataFrame([], schema)
    done = spark.read.schema(COMMIT_SCHEMA).json(f"{path}/commits")
    cells = (spark.read.schema(f"{schema}, query STRING, batch BIGINT, key_bucket INT")
             .option("basePath", f"{path}/data").parquet(f"{path}/data"))
    if start or stop:
        cells = cells.filter(F.col("key_bucket").isin(*regions_between(start, stop)) & in_key_range(start, stop))
    return cells.join(done, ["query", "batch"], "left_semi").select(*CELL_COLUMNS)


def wait_for_output(spark: SparkSession, q: StreamingQuery, path: str, expected_total: int,
                    deadline_s: float = 120.0, column: str = "count") -> None:
    """Let a processing-time query run until its sink holds ``expected_total``
    (sum of ``column``); then stop it. Past the deadline: TimeoutError, never
    a partial result.

    (``processAllAvailable`` cannot be used: with a processing-time timeout
    the query always has another batch to run, so it is never idle.)"""
    t0, got = time.time(), 0
    try:
        while time.time() - t0 < deadline_s:
            if q.exception() is not None:
                raise q.exception()
            try:
                got = spark.read.parquet(path).agg(F.sum(column)).collect()[0][0] or 0
            except AnalysisException as e:
                if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "_LEGACY_ERROR_TEMP_1134"):
                    raise
                got = 0             # no file committed yet
            if got >= expected_total:
                return
            time.sleep(1.0)
        raise TimeoutError(f"{path}: {got} of {expected_total} after {deadline_s} s")
    finally:
        q.stop()


def preview_stream(stream: DataFrame, n: int = 10, name: str | None = None) -> DataFrame:
    """A13 for streams: the first ``n`` rows of what is available now, via the
    memory sink (bounded: at most ``n`` rows reach the driver)."""
    import uuid
    spark = stream.sparkSession
    table = name or f"flowlens_preview_{uuid.uuid4().hex[:8]}"
    q = (stream.limit(n).writeStream.format("memory").queryName(table).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.table(table)
