"""What tasks of a session share: the library's own modules and a folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package to the executors once a session, as ``spark-submit --py-files`` does.

    The archive of a few KB lies with the driver, whose file server sends it.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="textloom-modules-")) / "textloom.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the place that the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="textloom-shared-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def tabled(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a new shared folder and read it back.

    As a checkpoint does, that cuts the lineage and survives lost executors;
    besides, Spark knows the size of the table and chooses joins by it.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
