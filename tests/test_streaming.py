from pyspark.sql import functions as F

from matchlake.session import scratch_path
from matchlake.streaming import dedupe_within_watermark, file_stream, run_available

from conftest import rows

SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint"


def test_new_files_processed_once(spark):
    base = scratch_path(spark, "stream")
    df = spark.range(10).select(F.col("id").alias("event_id"),
                                F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ts"),
                                (F.col("id") % 3).alias("user_id"))
    df.filter("event_id < 5").write.parquet(f"{base}/in/b=1")
    run_available(file_stream(spark, f"{base}/in/*", SCHEMA), f"{base}/out", f"{base}/ck")
    run_available(file_stream(spark, f"{base}/in/*", SCHEMA), f"{base}/out", f"{base}/ck")  # nothing new
    assert spark.read.parquet(f"{base}/out").count() == 5
    df.filter("event_id >= 5").write.parquet(f"{base}/in/b=2")
    run_available(file_stream(spark, f"{base}/in/*", SCHEMA), f"{base}/out", f"{base}/ck")
    assert spark.read.parquet(f"{base}/out").count() == 10


def test_dedupe_within_watermark(spark):
    base = scratch_path(spark, "stream")
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00", 7), (2, "2024-01-01 01:00:00", 7),
                                (3, "2024-01-02 00:00:00", 8)], "event_id bigint, ts string, user_id bigint") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    df.write.parquet(f"{base}/in")
    stream = dedupe_within_watermark(file_stream(spark, f"{base}/in", SCHEMA), ["user_id"], "ts", "2 days")
    run_available(stream, f"{base}/out", f"{base}/ck")
    assert rows(spark.read.parquet(f"{base}/out"), "user_id") == [(7,), (8,)]


def test_stream_documents_into_star(spark):
    import os
    import shutil

    from matchlake.plans.load import read_star
    from matchlake.streaming import stream_documents

    from conftest import FIXTURES, M1, M2, M3

    base = scratch_path(spark, "docstream")
    landing = f"{base}/landing"
    os.makedirs(landing)
    src = os.path.join(FIXTURES, "matches")
    shutil.copy(os.path.join(src, f"{M1}.json"), landing)
    stream_documents(spark, landing, f"{base}/wh", f"{base}/ck", multi_line=True)
    assert rows(read_star(spark, f"{base}/wh")["metadata"], "matchid") == [(M1,)]
    for m in (M2, M3):
        shutil.copy(os.path.join(src, f"{m}.json"), landing)
    stream_documents(spark, landing, f"{base}/wh", f"{base}/ck", multi_line=True)
    stream_documents(spark, landing, f"{base}/wh", f"{base}/ck", multi_line=True)          # nothing new
    star = read_star(spark, f"{base}/wh")
    assert rows(star["metadata"], "matchid") == [(M1,), (M2,), (M3,)]
    assert star["kills"].count() == 8 and star["player"].count() == 9
