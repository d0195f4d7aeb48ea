from pyspark.sql import functions as F

from flowlens.plans import jobs
from flowlens.streaming import packets as S
from conftest import SF_SMALL


def test_minute_counts_equal_batch(spark):
    got = {r.minute: r["count"] for r in jobs.stream_minute_counts(spark, SF_SMALL).collect()}
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    want = {r.m: r.n for r in ev.groupBy(F.date_trunc("minute", "ts").alias("m")).agg(F.count("*").alias("n")).collect()}
    assert got == want


def test_restart_from_checkpoint_no_duplicates(spark):
    from flowlens.session import work_dir
    base = work_dir(spark, "restart-test")
    S.packet_records(jobs.event_frames(spark, SF_SMALL)).write.parquet(f"{base}/in/data")
    out, ck = f"{base}/out", f"{base}/ck"
    q = S.run_to_files(S.packet_key_stream(S.read_packet_stream(spark, f"{base}/in")), out, ck)
    q.awaitTermination()
    n1 = spark.read.parquet(out).count()
    # restart on the same checkpoint: nothing is reprocessed
    q = S.run_to_files(S.packet_key_stream(S.read_packet_stream(spark, f"{base}/in")), out, ck)
    q.awaitTermination()
    assert spark.read.parquet(out).count() == n1 == 1000
    # new input is picked up exactly once
    S.packet_records(jobs.event_frames(spark, SF_SMALL).limit(10), offset_col="pkt_id") \
        .withColumn("offset", F.col("offset") + 1_000_000).write.parquet(f"{base}/in/more")
    q = S.run_to_files(S.packet_key_stream(S.read_packet_stream(spark, f"{base}/in")), out, ck)
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 1010


def test_idle_counts_total(spark):
    got = jobs.stream_idle_counts(spark, SF_SMALL)
    assert got.agg(F.sum("count")).collect()[0][0] == 1000


def test_preview_stream_is_bounded(spark):
    data = jobs._stream_records(spark, SF_SMALL)
    got = S.preview_stream(S.read_packet_stream(spark, data), 7).collect()
    assert len(got) == 7 and all(len(r.key) == 8 for r in got)


def test_multi_batch_stream_equals_batch(spark):
    """Records spread over several files, one file per micro-batch: the keyed
    packet output equals the same keys computed in one batch."""
    from flowlens.session import work_dir
    base = work_dir(spark, "multibatch")
    recs = S.packet_records(jobs.event_frames(spark, SF_SMALL))
    recs.repartition(5).write.parquet(f"{base}/in")
    src = S.read_packet_stream(spark, f"{base}/in", max_files_per_trigger=1)
    q = S.run_to_files(S.packet_key_stream(src), f"{base}/out", f"{base}/ck")
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"]]) >= 2
    streamed = sorted(bytes(r.rowkey) for r in spark.read.parquet(f"{base}/out").select("rowkey").collect())
    batch = sorted(bytes(r.rowkey) for r in S.packet_key_stream(spark.read.parquet(f"{base}/in"))
                   .select("rowkey").collect())
    assert streamed == batch and len(batch) == 1000


def test_watermark_drops_only_late_records(spark):
    """Minute counts with a 5-minute watermark: a record more than 5 minutes
    behind the newest one of an earlier batch is dropped, one within the
    retention is counted."""
    from flowlens.session import work_dir
    base = work_dir(spark, "watermark")
    schema = "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT"
    minute = 60_000_000
    t0 = 1_700_000_000_000_000 - (1_700_000_000_000_000 % minute)

    def put(name, micros):
        spark.createDataFrame([(m.to_bytes(8, "big"), b"", "t", 0, i) for i, m in enumerate(micros)], schema) \
            .withColumn("timestamp", F.timestamp_micros(F.col("offset"))).write.parquet(f"{base}/in/{name}")
    out, ck = f"{base}/out", f"{base}/ck"

    def run():
        q = S.run_to_files(S.minute_counts_stream(S.read_packet_stream(spark, f"{base}/in")), out, ck)
        q.awaitTermination()
    put("a", [t0 + 20 * minute])                    # watermark -> t0 + 15 min
    run()
    put("b", [t0 + 1 * minute, t0 + 16 * minute, t0 + 30 * minute])   # first is late
    run()
    put("c", [t0 + 120 * minute])                   # closes the windows
    run()
    got = {r.minute: r["count"] for r in spark.read.parquet(out).collect()}
    import datetime
    def m(k):
        return datetime.datetime(1970, 1, 1) + datetime.timedelta(microseconds=t0 + k * minute)
    assert m(1) not in got
    assert got[m(16)] == 1 and got[m(20)] == 1 and got[m(30)] == 1


def _many_files(spark, name):
    """The event records in six files of no order in time."""
    from flowlens.session import work_dir
    base = work_dir(spark, name)
    S.packet_records(jobs.event_frames(spark, SF_SMALL)).repartition(6, F.xxhash64("offset")).write.parquet(f"{base}/in")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    minutes = ev.groupBy(F.date_trunc("minute", "ts").alias("m")).agg(F.count("*").alias("n"))
    return base, {r.m: r.n for r in minutes.collect()}


def test_replay_in_bounded_batches_counts_all(spark):
    """One file per micro-batch, files of no order in time: nothing is late,
    and the closing record of the second run emits every window."""
    base, want = _many_files(spark, "replay-minutes")
    got = S.replay(spark, f"{base}/in", f"{base}/run", S.minute_counts_stream, max_files_per_trigger=1).collect()
    assert {r.minute: r["count"] for r in got} == want and len(got) == len(want)


def test_event_time_idle_replay_in_bounded_batches(spark):
    base, want = _many_files(spark, "replay-idle")
    got = S.replay(spark, f"{base}/in", f"{base}/run",
                   lambda stream, retention: S.idle_flush_counts_event_time(stream, retention=retention),
                   max_files_per_trigger=1).collect()
    assert {r.minute: r["count"] for r in got} == want and len(got) == len(want)


def test_replay_of_nothing(spark):
    from flowlens.session import work_dir
    base = work_dir(spark, "replay-empty")
    S.packet_records(jobs.event_frames(spark, SF_SMALL)).limit(0).write.parquet(f"{base}/in")
    assert S.replay(spark, f"{base}/in", f"{base}/run", S.minute_counts_stream).count() == 0


def test_late_records_do_not_depend_on_merging(spark):
    """Two records of a late minute and one of an open minute, in one file or
    in three: the same counts either way."""
    from flowlens.session import work_dir
    minute, t0 = 60_000_000, 1_700_000_040_000_000 // 60_000_000 * 60_000_000

    def run(files):
        base = work_dir(spark, "late")

        def put(name, micros, parts=1):
            spark.createDataFrame([(m.to_bytes(8, "big"), b"", "t", 0, i, None) for i, m in enumerate(micros)],
                                  S.STREAM_SCHEMA).repartition(parts).write.parquet(f"{base}/in/{name}")
            out = S.idle_flush_counts_event_time(S.read_packet_stream(spark, f"{base}/in"))
            S.run_to_files(out, f"{base}/out", f"{base}/ck").awaitTermination()
        put("a", [t0 + 20 * minute])
        # the watermark is at t0 + 15 min
        put("b", [t0 + 14 * minute, t0 + 15 * minute - 1, t0 + 15 * minute, t0 + 16 * minute - 1], files)
        put("c", [S.CLOSING_MICROS])
        return sorted(r["count"] for r in spark.read.parquet(f"{base}/out").collect())
    assert run(1) == run(4) == [1, 2]


def test_deadline_raises(spark):
    """A partial result is never handed out."""
    import pytest
    from flowlens.session import work_dir
    base = work_dir(spark, "deadline-test")
    S.packet_records(jobs.event_frames(spark, SF_SMALL)).write.parquet(f"{base}/in/data")
    q = S.run_to_files(S.idle_flush_counts(S.read_packet_stream(spark, f"{base}/in")), f"{base}/out", f"{base}/ck",
                       available_now=False)
    with pytest.raises(TimeoutError):
        S.wait_for_output(spark, q, f"{base}/out", 1_000_000, deadline_s=2)
    assert not q.isActive


def _cell_stream(spark, folder):
    raw = spark.readStream.schema("id BIGINT").option("maxFilesPerTrigger", "1").parquet(folder)
    return raw.selectExpr("unhex(md5(cast(id as string))) rowkey", "'p' cf", "encode('r', 'UTF-8') cq",
                          "id version", "unhex(sha1(cast(id as string))) value")


def test_table_sink_adds_nothing_when_a_batch_runs_again(spark, tmp):
    import os
    from flowlens.streaming import packets as S
    src, table, ck = tmp + "/src", tmp + "/table", tmp + "/ck"
    spark.range(0, 120, 1, 3).write.parquet(src)
    S.run_to_table(_cell_stream(spark, src), table, ck).awaitTermination()
    want = sorted((r.id, r.v) for r in spark.range(120).selectExpr("id", "sha1(cast(id as string)) v").collect())

    def got():
        return sorted((r.version, bytes(r.value).hex()) for r in S.read_stream_table(spark, table).collect())
    assert got() == want
    last = max(int(f) for f in os.listdir(ck + "/commits") if f.isdigit())
    assert last == 2
    for f in (str(last), f".{last}.crc"):           # Spark's own commit of the last batch is lost: it runs again
        if os.path.exists(f"{ck}/commits/{f}"):
            os.remove(f"{ck}/commits/{f}")
    S.run_to_table(_cell_stream(spark, src), table, ck).awaitTermination()
    assert got() == want
    record = [f for f in os.listdir(table + "/commits") if f.endswith(f"-{last}.json")][0]
    os.remove(f"{table}/commits/{record}")          # cells written, batch not committed: unseen, then written over
    assert 0 < len(got()) < 120
    for f in (str(last), f".{last}.crc"):
        if os.path.exists(f"{ck}/commits/{f}"):
            os.remove(f"{ck}/commits/{f}")
    S.run_to_table(_cell_stream(spark, src), table, ck).awaitTermination()
    assert got() == want
    spark.range(120, 130, 1, 1).write.mode("append").parquet(src)
    S.run_to_table(_cell_stream(spark, src), table, ck).awaitTermination()
    assert len(got()) == 130


def test_table_sink_keeps_queries_apart_and_scans_ranges(spark, tmp):
    from flowlens.streaming import packets as S
    assert S.read_stream_table(spark, tmp + "/none").count() == 0
    src, table = tmp + "/src", tmp + "/table"
    spark.range(0, 50, 1, 1).write.parquet(src)
    for ck in ("/a", "/b"):                         # a new checkpoint starts at batch 0 again: not taken for a replay
        S.run_to_table(_cell_stream(spark, src), table, tmp + ck).awaitTermination()
    keys = sorted(bytes(r.rowkey) for r in S.read_stream_table(spark, table).collect())
    assert len(keys) == 100
    part = S.read_stream_table(spark, table, b"\x30", b"\xa0")
    assert sorted(bytes(r.rowkey) for r in part.collect()) == [k for k in keys if b"\x30" <= k < b"\xa0"]


def test_user_state_keeps_one_timer_and_drops_expired_minutes(spark):
    """Batches in order: a minute counted twice keeps the newer expiry, an older record
    does not move it; a minute far ahead expires the others; a late one adds nothing."""
    from flowlens.session import work_dir
    from flowlens.streaming import stateful as ST
    base = work_dir(spark, "user-state")
    minute = 60_000_000

    def put(*us):
        rows = [(u.to_bytes(8, "big"), b"", "t", 0, i) for i, u in enumerate(us)]
        spark.createDataFrame(rows, "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT") \
            .withColumn("timestamp", F.lit(None).cast("timestamp")).coalesce(1).write.mode("append").parquet(f"{base}/in")
        out = ST.idle_counts(S.read_packet_stream(spark, f"{base}/in"))
        ST.run_with_state(out, f"{base}/out", f"{base}/ck", state_partitions=2).awaitTermination()
        held = {r.minute.minute: (r["count"], r.expires_ms) for r in ST.minute_state(spark, f"{base}/ck").collect()}
        sent = spark.read.schema(out.schema).parquet(f"{base}/out").collect()
        return held, sorted((r.minute.minute, r["count"]) for r in sent)

    at = 1000 * 60 * minute
    assert put(at + 5_000_000, at + 1_000_000) == ({0: (2, at // 1000 + 7000)}, [])
    assert put(at + 2_000_000, at + minute) == ({0: (3, at // 1000 + 7000), 1: (1, at // 1000 + 62_000)}, [])
    assert put(at + 9_000_000)[0][0] == (4, at // 1000 + 11_000)
    far = at + 30 * minute
    assert put(far) == ({30: (1, far // 1000 + 2000)}, [(0, 4), (1, 1)])
    assert put(at) == ({30: (1, far // 1000 + 2000)}, [(0, 4), (1, 1)])


def test_user_state_equals_group_state(spark):
    data = jobs._stream_records(spark, SF_SMALL)
    got = jobs.stream_minute_state(spark, SF_SMALL).collect()
    want = {r.minute: r["count"] for r in jobs.stream_idle_counts_event_time(spark, SF_SMALL).collect()}
    assert {r.minute: r.emitted for r in got} == {r.minute: r["count"] for r in got} == want
    assert spark.read.parquet(data).count() == sum(want.values())
