"""Session services: table access, shipping the package to executors, lineage cuts in the shared folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
_LOCAL: list[str] = []


def session(cores: str = "8", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quillmark")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QUILLMARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, so that Python functions import it there."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="quillmark-ship-")
    _LOCAL.append(folder)
    path = os.path.join(folder, "quillmark.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, str(f.relative_to(root.parent)))
    sc.addPyFile(path)


@atexit.register
def _forget() -> None:
    for folder in _LOCAL:
        shutil.rmtree(folder, ignore_errors=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables; columns and filters are pruned into this scan by the optimizer."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where it is unset, a local one for this process, which only a local master allows."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        if not any("quillmark-shared" in x for x in _LOCAL):
            _LOCAL.append(tempfile.mkdtemp(prefix="quillmark-shared-"))
        folder = "file://" + next(x for x in _LOCAL if "quillmark-shared" in x)
    return folder.rstrip("/")


def stage_folder(spark: SparkSession) -> str:
    """Where this application's staged tables lie."""
    return f"{shared_folder(spark)}/quillmark/{spark.sparkContext.applicationId}"


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{stage_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """Writes df to the shared folder and reads it back: cuts lineage, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """df for a join that broadcasts neither side: Spark takes exploded rows for as large as those they come from, and stored ones for as large
    as their compressed files, so that its threshold lets through what no driver holds."""
    return df.hint("merge")


def clean(spark: SparkSession, path: str | None = None) -> None:
    """Removes a staged folder, or all of this application's once nothing reads them any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path or stage_folder(spark))
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
