"""Session helpers: a tuned local session, the shared folder, table loading."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("colloqua")
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir`` of the session.

    Only where that is unset and the session is local, as in tests, a temporary
    folder is made and set; on a cluster no executor would find it on another
    machine, so there it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no folder; a cluster needs one that all its machines share")
        folder = "file://" + tempfile.mkdtemp(prefix="colloqua-shared-")
        spark.sparkContext.setCheckpointDir(folder)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


#: Paths made for running applications, which :func:`clean_shared` deletes.
_MADE: dict[str, set[str]] = {}


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, deleted when the driver's program ends."""
    path = f"{shared_folder(spark)}/colloqua-{label}-{uuid.uuid4().hex}"
    if not _MADE:
        atexit.register(_clean_all)
    _MADE.setdefault(spark.sparkContext.applicationId, set()).add(path)
    return path


def clean_shared(spark: SparkSession) -> int:
    """Delete what this application has staged; results that read it can't be read any more. The number of paths deleted."""
    context, n = spark.sparkContext, 0
    for path in _MADE.pop(context.applicationId, set()):
        found = context._jvm.org.apache.hadoop.fs.Path(path)
        n += bool(found.getFileSystem(context._jsc.hadoopConfiguration()).delete(found, True))
    return n


def _clean_all() -> None:
    spark = SparkSession.getActiveSession()
    try:
        if spark is not None:
            clean_shared(spark)
    except Exception:  # noqa: BLE001 - at the end of the program the context may be gone
        pass


def staged(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage through a written table in the shared folder."""
    path = shared_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application."""
    import pathlib
    import zipfile

    context = spark.sparkContext
    if getattr(context, "_colloqua_shipped", False):
        return
    here = pathlib.Path(__file__).resolve().parent
    archive = pathlib.Path(tempfile.mkdtemp(prefix="colloqua-")) / "colloqua.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(here.rglob("*.py")):
            out.write(path, path.relative_to(here.parent))
    context.addPyFile(str(archive))
    context._colloqua_shipped = True
