"""Where jobs put written tables and checkpoints, read from the session."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Temporary folders of local sessions, by application.
_local: dict[str, str] = {}
# Applications whose workers have been given this package.
_shipped: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only for a local master."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _local:
        _local[application] = tempfile.mkdtemp(prefix="mapsheaf-")
    return _local[application]


def new_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/mapsheaf/{name}-{uuid.uuid4().hex}"


# Folders that a task fills at once; with more, Spark sorts its rows by folder.
OPEN_FOLDERS = 64


def write_in_order(df: DataFrame, path: str, folder: str, codec: str | None = None) -> None:
    """Write ``df`` in folders by a column, the rows of each task in the order in which they come.

    ``codec`` is how files are compressed, the session's way unless given.
    """
    conf, name = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name)
    conf.set(name, OPEN_FOLDERS)
    try:
        df.write.mode("overwrite").partitionBy(folder).parquet(path, compression=codec)
    finally:
        conf.set(name, before)


# Bytes of one Arrow batch of texts. A task's JVM and its Python worker both hold batches, at several times that size.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Lower the session's limit for Arrow batches to ``BATCH_BYTES``; it stays, as plans run later. A lower one is kept."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"(-?\d+)([kmgtp]?)b?", spark.conf.get(name).strip().lower()).groups()
    size = int(number) << 10 * " kmgtp".index(unit or " ")
    if size <= 0 or size > BATCH_BYTES:
        spark.conf.set(name, BATCH_BYTES)


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder, so that later stages see the same rows."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def ship_package(spark: SparkSession) -> None:
    """Give the package's modules to Python workers, for functions that run in tasks.

    Once per application; needed where the package is not installed on the executors.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    _shipped.add(application)
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="mapsheaf-")) / "mapsheaf.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as file:
        for module in sorted(package.rglob("*.py")):
            file.write(module, f"{package.name}/{module.relative_to(package)}")
    spark.sparkContext.addPyFile(str(archive))
