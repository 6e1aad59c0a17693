"""Session helpers: defaults for local runs, and the shared checkpoint folder.

The library never builds its own cluster session; callers pass one in.
``local_session`` exists for tests and the bench only.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "sievekit") -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is; without it, staging on a cluster is an error. Only in local mode is a
    fresh scratch folder made.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="sievekit-ckpt-")
    try:
        spark.conf.set(CHECKPOINT_CONF, local)
    except Exception:  # noqa: BLE001 - some deployments reject runtime core confs
        pass
    spark.sparkContext.setCheckpointDir(local)
    return local


def _stages(spark: SparkSession, base: str) -> str:
    """The application's own part of the shared folder."""
    return os.path.join(base, "stages", spark.sparkContext.applicationId)


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder name in the application's own part of the shared folder."""
    return os.path.join(_stages(spark, ensure_checkpoint_dir(spark)), f"{name}-{uuid.uuid4().hex[:12]}")


def remove_stages(spark: SparkSession) -> bool:
    """Delete what ``stage_table`` and others wrote for this application (all in
    its own part of the shared folder), and nothing else. DataFrames that still read from it are lost with it,
    so call it when their results are written. True when there was something."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_stages(spark, ensure_checkpoint_dir(spark)))
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(files.delete(folder, True))


def stage_table(df: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts lineage between curation stages; the files live in shared storage, so
    a lost executor does not lose the stage.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    df.write.mode("overwrite").format(fmt).save(path)
    return spark.read.format(fmt).load(path)


PACKAGE_ZIP = "sievekit-package.zip"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, so that Python tasks import it
    wherever the driver was started from. Once an application."""
    context = spark.sparkContext
    if PACKAGE_ZIP in context._python_includes:
        return
    home = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="sievekit-ship-")) / PACKAGE_ZIP
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(home.rglob("*.py")):
            out.write(source, str(source.relative_to(home.parent)))
    context.addPyFile(str(target))
