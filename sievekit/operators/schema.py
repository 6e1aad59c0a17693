"""Schema checks (C1-C5): declared column names vs a file header or a table.

Schemas are name lists (``classes.<table>.slots`` of a YAML document); the
class is chosen by the table's last name part. Types, nullability and keys
are not compared, as in the reference.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievekit.sources.delimited import first_lines


def load_schema_document(text: str) -> dict:
    import yaml  # optional dependency, only for YAML text
    return yaml.safe_load(text) or {}


def schema_slots(schema_doc: Mapping | str, target_table: str) -> list[str]:
    """Slots of the class named like the table's last part; LookupError if absent."""
    doc = load_schema_document(schema_doc) if isinstance(schema_doc, str) else schema_doc
    class_name = target_table.split(".")[-1]
    cls = (doc.get("classes") or {}).get(class_name) or {}
    if not cls:
        raise LookupError(f"Class '{class_name}' not found in schema")
    return list(cls.get("slots") or [])


def compare_columns(actual: Sequence[str], expected: Sequence[str], label: str = "file") -> dict:
    """Ordered, case-sensitive differences of two name lists."""
    return {
        f"{label}_columns": list(actual),
        "schema_columns": list(expected),
        f"missing_in_{label}": [c for c in expected if c not in actual],
        f"extra_in_{label}": [c for c in actual if c not in expected],
    }


def file_header(spark: SparkSession, path: str, sep: str = "\t", ignore_first_line: bool = False) -> list[str]:
    """The header of a delimited file (line 2 when the first line is ignored)."""
    n = 2 if ignore_first_line else 1
    row = first_lines(spark, path, n).filter(F.col("line_number") == n).orderBy("file_path").first()
    if row is None:
        raise ValueError(f"no header line in {path}")
    return [c.strip() for c in row["value"].split(sep)]


def file_schema_check(spark: SparkSession, path: str, schema_doc, target_table: str, sep: str = "\t",
                      ignore_first_line: bool = False) -> dict:
    """C1 + C3: header vs schema; failures become an ``error`` entry, not an exception."""
    try:
        header = file_header(spark, path, sep, ignore_first_line)
    except Exception as exc:  # noqa: BLE001
        return {**compare_columns([], [], "file"), "error": f"Failed to extract file header: {exc}"}
    try:
        slots = schema_slots(schema_doc, target_table)
    except Exception as exc:  # noqa: BLE001
        return {**compare_columns(header, [], "file"), "missing_in_file": [], "extra_in_file": [],
                "error": f"Schema load error: {exc}"}
    return compare_columns(header, slots, "file")


def table_schema_check(df: DataFrame, schema_doc, target_table: str) -> dict:
    """C2 + C3: table columns vs schema."""
    try:
        slots = schema_slots(schema_doc, target_table)
    except Exception as exc:  # noqa: BLE001
        return {**compare_columns(df.columns, [], "table"), "missing_in_table": [], "extra_in_table": [],
                "error": f"Schema load error: {exc}"}
    return compare_columns(df.columns, slots, "table")


def database_drift(spark: SparkSession, database: str, schema_doc, tables: Sequence[str] | None = None) -> DataFrame:
    """C2 over a whole database (S12): one row per differing column.

    kind is ``missing_in_table``, ``extra_in_table``, ``unknown_class`` or
    ``unreadable``.
    Only table metadata is read.
    """
    names = list(tables) if tables is not None else [t.name for t in spark.catalog.listTables(database)]
    rows = []
    for name in names:
        full = f"{database}.{name}"
        try:
            res = table_schema_check(spark.table(full), schema_doc, full)
        except Exception:  # noqa: BLE001 - one unreadable table does not stop the others
            rows.append((full, None, "unreadable", None))
            continue
        if "error" in res:
            rows.append((full, None, "unknown_class", None))
            continue
        rows += [(full, c, "missing_in_table", i) for i, c in enumerate(res["missing_in_table"])]
        rows += [(full, c, "extra_in_table", i) for i, c in enumerate(res["extra_in_table"])]
    return spark.createDataFrame(rows, "table string, column string, kind string, position int")


def drift_log(drift: DataFrame, at: dt.datetime | None = None) -> DataFrame:
    """Drift rows stamped for appending to a drift log table."""
    ts = F.lit(at) if at is not None else F.current_timestamp()
    return drift.withColumn("logged_at", ts.cast("timestamp"))


HISTORY = "table string, column string, type string, from_run long, to_run long"


def schema_history(history: DataFrame, snapshot: DataFrame, run_id: int) -> DataFrame:
    """A schema history after one more run, by validity intervals.

    ``snapshot`` holds (table, column, type) as run ``run_id`` found them;
    ``history`` (``HISTORY``; one row per column, type and interval, ``to_run``
    null while it lasts) is what earlier runs left. A full outer join of the open
    intervals with the snapshot closes what is gone or has another type and opens
    what is new, returned or has another type. A run that the history already
    knows, or is older than what it knows, changes nothing, so a repeated run
    adds no rows.

    Null names take no part; a column that a snapshot lists twice counts once,
    with its smallest type.
    """
    found = snapshot.filter(F.col("table").isNotNull() & F.col("column").isNotNull()).groupBy("table", "column").agg(F.min("type").alias("now"))
    run = F.lit(run_id).cast("long")
    last = history.agg(F.coalesce(F.greatest(F.max("from_run"), F.max("to_run")), run - 1).alias("last")).scalar()
    closed = history.filter("to_run is not null").select("table", "column", "type", "from_run", "to_run")
    open_now = history.filter("to_run is null").select("table", "column", F.col("type").alias("was"), "from_run")
    both = open_now.join(found, ["table", "column"], "full").withColumns({"__late": last >= run, "__same": F.col("was").eqNullSafe(F.col("now"))})
    had, has = F.col("from_run").isNotNull(), F.col("now").isNotNull()
    stays = F.struct(F.col("was").alias("type"), F.col("from_run"), F.when(
        F.col("__late") | (F.col("__same") & has), F.lit(None).cast("long")).otherwise(run).alias("to_run"))
    opens = F.struct(F.col("now").alias("type"), run.alias("from_run"), F.lit(None).cast("long").alias("to_run"))
    rows = F.array(F.when(had, stays), F.when(has & ~F.col("__late") & ~(had & F.col("__same")), opens))
    changed = both.select("table", "column", F.explode(rows).alias("r")).filter(F.col("r").isNotNull()).select("table", "column", "r.*")
    return closed.unionByName(changed)


def drift_of_run(history: DataFrame, run_id: int) -> DataFrame:
    """The changes that a run found: (table, column, kind, type_before,
    type_after); kind is ``added``, ``returned``, ``removed`` or ``retyped``.
    The first run of a table adds nothing: its columns are the baseline."""
    run = F.lit(run_id).cast("long")
    first = history.groupBy("table").agg(F.min("from_run").alias("__first"))
    per = history.groupBy("table", "column").agg(
        F.max(F.when(F.col("to_run") == run, F.col("type"))).alias("type_before"),
        F.max(F.when(F.col("from_run") == run, F.col("type"))).alias("type_after"),
        F.min("from_run").alias("__since"))
    kind = (F.when(F.col("type_before").isNotNull() & F.col("type_after").isNotNull(), "retyped")
            .when(F.col("type_before").isNotNull(), "removed")
            .when(F.col("__since") < run, "returned").otherwise("added"))
    hit = F.col("type_before").isNotNull() | (F.col("type_after").isNotNull() & (F.col("__first") < run))
    return per.join(first, "table").filter(hit).select("table", "column", kind.alias("kind"), "type_before", "type_after")


def append_drift(log: DataFrame, drift: DataFrame, run_id: int, at: dt.datetime | None = None) -> DataFrame:
    """The rows that a drift log (``drift_log`` rows with their ``run_id``) lacks
    of a run's drift: none when the run was logged before."""
    stamped = drift_log(drift, at).withColumn("run_id", F.lit(run_id).cast("long"))
    known = log.filter(F.col("run_id") == run_id).select("table", "column", "kind").distinct()
    return stamped.join(known, ["table", "column", "kind"], "left_anti")


def config_columns_not_in_schema(configs: DataFrame, schema_columns: DataFrame, json_col: str = "json",
                                 name_col: str = "config", column_col: str = "column",
                                 table_col: str | None = None) -> DataFrame:
    """C4: columns named by config sections that the schema lacks (warnings).

    Sections: validations.column, referential_integrity.foreign_key,
    great_expectations_validations.params.column, transformations.column_name.
    With ``table_col`` the schema columns name their tables, and each config is
    compared with its own one: the last part of its ``target_table``.
    """
    doc = F.col(json_col)
    specs = [("validations", "$.column"), ("referential_integrity", "$.foreign_key"),
             ("great_expectations_validations", "$.params.column"), ("transformations", "$.column_name")]
    parts = []
    for section, field in specs:
        items = F.coalesce(F.from_json(F.get_json_object(doc, f"$.{section}"), "array<string>"),
                           F.array().cast("array<string>"))
        table = F.element_at(F.split(F.get_json_object(doc, "$.target_table"), r"\."), -1)
        parts.append(configs.select(F.col(name_col).alias("config"), table.alias("__table"), F.lit(section).alias("section"),
                                    F.posexplode(items).alias("idx", "item"))
                     .select("config", "__table", "section", "idx", F.get_json_object("item", field).alias("column")))
    used = parts[0]
    for p in parts[1:]:
        used = used.unionByName(p)
    used = used.filter(F.col("column").isNotNull() & (F.col("column") != ""))
    if table_col is not None:
        known = schema_columns.select(F.col(table_col).alias("__table"), F.col(column_col).alias("column"))
        return used.join(known, ["__table", "column"], "left_anti").select("config", "section", "idx", "column")
    known = schema_columns.select(F.col(column_col).alias("column"))
    return used.join(known, "column", "left_anti").select("config", "section", "idx", "column")
