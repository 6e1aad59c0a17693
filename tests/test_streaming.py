"""Row rules on a file stream (availableNow trigger, memory sink)."""

from pyspark.sql import functions as F

from sievekit.operators import rules as R
from sievekit.streaming.rules_stream import flag_stream, violation_counts

RULES = [{"column": "value", "validation_type": "numeric_range", "max": 100},
         {"column": "event_type", "validation_type": "allowed_values", "values": ["click", "view"]}]


def test_stream_matches_batch(spark, tmp_dir):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src = f"{tmp_dir}/events"
    events.write.parquet(src)
    stream = spark.readStream.schema(events.schema).parquet(src)
    flagged = flag_stream(stream, RULES).select("event_id", F.size("failed_rules").alias("n_failed"))
    q = (flagged.writeStream.format("memory").queryName("flagged_events")
         .option("checkpointLocation", f"{tmp_dir}/ck1").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.sql("SELECT sum(n_failed) AS s FROM flagged_events").first().s
    batch = R.rule_report(events, RULES).agg(F.sum("n_violations")).first()[0]
    assert got == batch

    counts = violation_counts(stream, RULES, "ts", window="1 day", watermark="1 hour")
    q2 = (counts.writeStream.format("memory").queryName("rule_counts").outputMode("complete")
          .option("checkpointLocation", f"{tmp_dir}/ck2").trigger(availableNow=True).start())
    q2.awaitTermination()
    total = spark.sql("SELECT sum(n_violations) AS v, sum(n_rows) AS n FROM rule_counts").first()
    assert total.v == batch and total.n == 2 * events.count()


def test_run_log_stream(spark, tmp_dir):
    import json
    import os

    from sievekit.operators import runlog as L
    from sievekit.streaming.runlog_stream import level_counts, stream_run_logs

    os.makedirs(f"{tmp_dir}/logs")
    rows = [json.dumps({"time": f"2025-07-10 0{h}:00:00,000", "pipeline": "p", "schema": "s", "table": "t",
                        "level": lvl, "module": "m", "msg": "x"}) for h in range(3) for lvl in ("INFO", "ERROR")]
    with open(f"{tmp_dir}/logs/pipeline_run_a.log", "w") as f:
        f.write("\n".join(rows + ["not json"]) + "\n")
    parsed = stream_run_logs(spark, f"{tmp_dir}/logs")
    q = (level_counts(parsed.filter(~F.col("is_bad"))).writeStream.format("memory").queryName("log_levels")
         .outputMode("complete").option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r.level: r.n for r in spark.sql("SELECT level, sum(n_lines) AS n FROM log_levels GROUP BY level").collect()}
    batch = L.read_run_logs(spark, f"{tmp_dir}/logs")
    want = {r.level: r["count"] for r in L.good_lines(batch).groupBy("level").count().collect()}
    assert got == want == {"INFO": 3, "ERROR": 3}


def test_report_each_batch(spark, tmp_dir):
    from sievekit.streaming.rules_stream import report_each_batch

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src = f"{tmp_dir}/ev"
    events.limit(100).write.parquet(f"{src}/part1")
    events.write.mode("append").parquet(f"{src}/part1")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/part1")
    q = report_each_batch(stream, RULES, f"{tmp_dir}/reports", f"{tmp_dir}/ck3", trigger={"availableNow": True})
    q.awaitTermination()
    reports = spark.read.parquet(f"{tmp_dir}/reports")
    assert reports.select("batch_id").distinct().count() >= 1
    total = reports.groupBy("rule_idx").agg(F.sum("n_violations").alias("v")).orderBy("rule_idx").collect()
    full = R.rule_report(spark.read.parquet(f"{src}/part1"), RULES).orderBy("rule_idx").collect()
    assert [r.v for r in total] == [r.n_violations for r in full]
