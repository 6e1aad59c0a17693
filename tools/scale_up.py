"""Write a k-times larger copy of the test tables (for local scale trials).

Each replica shifts every key by the table's key range, so foreign keys stay
consistent inside a replica; texts and other values are kept. Output tables
are written as several files so scans run in parallel.

Usage: python tools/scale_up.py SRC_DIR DST_DIR K
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from sievekit.plans.tables import TABLES, load  # noqa: E402
from sievekit.session import local_session  # noqa: E402

# key columns per table, and the table whose key range shifts them
KEYS = {
    "customer": {"c_custkey": "customer"},
    "supplier": {"s_suppkey": "supplier"},
    "part": {"p_partkey": "part"},
    "orders": {"o_orderkey": "orders", "o_custkey": "customer"},
    "lineitem": {"l_orderkey": "orders", "l_partkey": "part", "l_suppkey": "supplier"},
    "events": {"event_id": "events", "user_id": "customer"},
    "documents": {"doc_id": "documents"},
    "labels": {"doc_id": "documents"},
    "pages": {"page_id": "pages"},
    "embeddings": {"vec_id": "embeddings"},
    "benchmark": {"item_id": "benchmark"},
    "conversations": {"conv_id": "conversations"},
}
RANGE_OF = {"customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey",
            "events": "event_id", "documents": "doc_id", "pages": "page_id", "embeddings": "vec_id",
            "benchmark": "item_id", "conversations": "conv_id"}


def main(src: str, dst: str, k: int) -> None:
    spark = local_session()
    span = {t: int(load(spark, src, t).agg(F.max(c)).first()[0]) + 1 for t, c in RANGE_OF.items()}
    for t in TABLES:
        df = load(spark, src, t)
        keys = KEYS.get(t)
        if keys and k > 1:
            df = df.withColumn("__rep", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
            df = df.withColumns({c: (F.col(c) + F.col("__rep") * F.lit(span[owner])).cast(df.schema[c].dataType)
                                 for c, owner in keys.items()}).drop("__rep")
        n_files = 16 if keys else 1
        df.repartition(n_files).write.mode("overwrite").parquet(f"{dst}/{t}.parquet")
        print(t, spark.read.parquet(f"{dst}/{t}.parquet").count())


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2], int(sys.argv[3]))
