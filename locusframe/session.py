"""Session settings the library expects."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # attribute maps keep the last value of a repeated key
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(app: str = "locusframe", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to a session made elsewhere."""
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship(spark)
    return spark


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application, so that functions can refer to it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="locusframe-code-")) / "locusframe_code.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, str(source.relative_to(root.parent)))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for reliable checkpoints.

    On a cluster it is the shared folder named by ``spark.checkpoint.dir``; a temporary
    folder is only used by a local master that names none.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="locusframe-checkpoint-")
    sc.setCheckpointDir(folder)
    return folder


def shared_path(spark: SparkSession, kind: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names."""
    folder = (spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)).rstrip("/")
    return f"{folder}/{kind}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write an intermediate table that several steps read as Parquet in the shared folder, which cuts its lineage."""
    spark = df.sparkSession
    path = shared_path(spark, "table")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._table_path = path
    return out


def discard(table: DataFrame) -> None:
    """Remove a table that ``materialize`` wrote; nothing may read it any more."""
    jvm = table.sparkSession.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(table._table_path)
    path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
