"""Table sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """S3: a catalog table, ``db.table`` or ``table``."""
    return spark.table(name)


def path_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table stored at a path; the format is a parameter (Delta needs its jars)."""
    return spark.read.format(fmt).load(path)


def sql_count(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """``SELECT count(1) FROM fmt.`path```; answered from file metadata where possible."""
    return spark.sql(f"SELECT count(1) AS n_rows FROM {fmt}.`{path}`")


def catalog_inventory(spark: SparkSession, database: str) -> DataFrame:
    """Tables of a database with their location; a table that fails to
    describe gets an error text instead of stopping the listing.

    Catalog metadata is small (one row per table), so it is gathered on the
    driver and returned as a DataFrame.
    """
    rows = []
    for t in spark.catalog.listTables(database):
        location, error = None, None
        try:
            info = spark.sql(f"DESCRIBE TABLE EXTENDED `{database}`.`{t.name}`").collect()
            for r in info:
                if r[0] == "Location":
                    location = r[1]
        except Exception as exc:  # noqa: BLE001 - tolerate and report
            error = f"{type(exc).__name__}: {exc}"
        rows.append((database, t.name, t.tableType, location, error))
    return spark.createDataFrame(rows, "database string, table string, table_type string, location string, error string")
