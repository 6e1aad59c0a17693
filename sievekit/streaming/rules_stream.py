"""Row rules on streaming DataFrames.

Row rules are row-local, so the same compiled predicates apply to a
``readStream`` source. ``flag_stream`` adds the failed rule ids per row;
``violation_counts`` keeps windowed counts per rule with a watermark, so state
is dropped once a window can no longer change. FK checks, groups and reports
need whole tables and are batch-only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievekit.operators.rules import compile_rules


def flag_stream(df: DataFrame, rules: Sequence[Mapping], **options) -> DataFrame:
    """Add ``failed_rules``: the ids of the rules each row violates."""
    compiled = [r for r in compile_rules(df, rules, **options) if r.violation is not None]
    hits = F.array(*[F.when(r.violation, F.lit(r.rule_id)) for r in compiled]) if compiled \
        else F.array().cast("array<string>")
    # array_except drops the nulls and stays in codegen; rules that share an id show once
    return df.withColumn("failed_rules", F.array_except(hits, F.array(F.lit(None).cast("string"))))


def violation_counts(df: DataFrame, rules: Sequence[Mapping], time_col: str, window: str = "1 hour",
                     watermark: str = "10 minutes", **options) -> DataFrame:
    """Per event-time window and rule: rows seen and violations (append-safe)."""
    if df.schema[time_col].dataType.typeName() == "timestamp_ntz":
        df = df.withColumn(time_col, F.col(time_col).cast("timestamp"))  # watermarks need TIMESTAMP
    compiled = [r for r in compile_rules(df, rules, **options) if r.violation is not None]
    per_rule = df.withWatermark(time_col, watermark).select(F.col(time_col), F.explode(F.array(*[
        F.struct(F.lit(r.idx).alias("rule_idx"), F.lit(r.rule_id).alias("rule_id"), r.violation.alias("failed"))
        for r in compiled])).alias("r"))
    # two rules may have the same column and type, and so the same id: the index tells them apart
    return per_rule.groupBy(F.window(time_col, window).alias("window"), F.col("r.rule_idx").alias("rule_idx"),
                            F.col("r.rule_id").alias("rule_id")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("r.failed").alias("n_violations"))


def report_each_batch(df: DataFrame, rules: Sequence[Mapping], path: str, checkpoint: str,
                      fmt: str = "parquet", trigger: dict | None = None, **options):
    """Start a stream that writes the fused rule report of every micro-batch.

    Reports go to ``path`` partitioned by ``batch_id`` with dynamic partition
    overwrite, so a batch replayed after a failure replaces its own report
    instead of appending a duplicate. Returns the ``StreamingQuery``.
    """
    from sievekit.operators.rules import rule_report

    def write(batch: DataFrame, batch_id: int) -> None:
        report = rule_report(batch, rules, **options).withColumn("batch_id", F.lit(batch_id).cast("long"))
        (report.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").format(fmt).save(path))

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
