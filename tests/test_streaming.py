import datetime

from pyspark.sql import functions as F

from rollcall.streaming import limiter

START = datetime.datetime(2024, 1, 1)


def events(times, key="k"):
    return [(key, START + datetime.timedelta(milliseconds=t), i) for i, t in enumerate(times)]


def test_windows_start_at_their_first_event(spark):
    times = [0, 1, 2, 3, 4, 5, 6, 7, 8, 60_000, 60_001, 60_002]
    df = spark.createDataFrame(events(times) + events([5], "other"), "key string, ts timestamp_ntz, event_id long")
    got = {r.event_id: (r["count"], r.denied) for r in limiter.limited(df).where("key = 'k'").collect()}
    assert got[7] == (8, False) and got[8] == (9, True) and got[9] == (10, True) and got[10] == (1, False) and got[11] == (2, False)


def streamed(spark, df, folder, **options):
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(folder / "in"))
    writer = limiter.limited_stream(stream, **options).writeStream.format("memory").queryName("limited").outputMode("append")
    query = writer.option("checkpointLocation", str(folder / "c")).trigger(availableNow=True).start()
    assert query.awaitTermination(300)
    return spark.table("limited").collect()


def outcome(row):
    return str(row.key), row.event_id, row["count"], row.denied


def test_stream_and_batch_agree(spark, tmp_path):
    rows = [r for k in range(5) for r in events([(i * i * 977 * (k + 1)) % 400_000 for i in range(60)], f"k{k}" if k else None)]
    df = spark.createDataFrame(rows, "key string, ts timestamp_ntz, event_id long")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    assert sorted(map(outcome, streamed(spark, df, tmp_path))) == sorted(map(outcome, limiter.limited(df).collect()))


def test_state_goes_from_batch_to_batch_and_is_dropped(spark, tmp_path):
    schema = "key string, ts timestamp_ntz, event_id long"
    parts = [events([0, 10_000, 20_000], "a"), [("a", START + datetime.timedelta(milliseconds=30_000 + i), 10 + i) for i in range(7)], [("a", START + datetime.timedelta(hours=2), 20), ("b", START + datetime.timedelta(hours=2), 21)]]
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    df = spark.createDataFrame([r for p in parts for r in p], schema)
    assert sorted(map(outcome, streamed(spark, df, tmp_path))) == sorted(map(outcome, limiter.limited(df).collect()))


def test_null_keys_and_times(spark):
    rows = [(None, START + datetime.timedelta(milliseconds=i), i) for i in range(10)] + [("k", None, 20), ("k", START, 21)]
    df = spark.createDataFrame(rows, "key string, ts timestamp_ntz, event_id long")
    got = {r.event_id: (r.key, r["count"], r.denied) for r in limiter.limited(df).collect()}
    assert got[7] == (None, 8, False) and got[9] == (None, 10, True) and got[20] == ("k", None, None) and got[21] == ("k", 1, False)
    assert limiter.limited(df.limit(0)).count() == 0


def test_resume_skips_what_is_done(spark, tmp_path):
    spark.range(0, 10).write.parquet(str(tmp_path / "in"))
    process = lambda rows: rows.withColumn("twice", F.col("id") * 2)
    out = str(tmp_path / "out")
    for checkpoint in ("one", "two"):
        stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
        limiter.resume(stream, ["id"], out, process, str(tmp_path / checkpoint)).awaitTermination()
        spark.range(5, 15).write.mode("append").parquet(str(tmp_path / "in"))
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(15))
