"""Cutting the lineage of tables that several results are made of, and what workers need."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def _shared(spark: SparkSession) -> str | None:
    """The folder that ``spark.checkpoint.dir`` names; None where it is unset, which local mode alone allows."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("on a cluster, spark.checkpoint.dir has to name a folder that all machines share")
    return root


def durable(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder (a temporary one only in local mode, as in tests)."""
    context = df.sparkSession.sparkContext
    if _shared(df.sparkSession) is None and not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
    return df.checkpoint()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path for files of this application in the shared folder; nothing is there yet."""
    root = _shared(spark) or f"file://{tempfile.mkdtemp(prefix='files-')}"
    return f"{root.rstrip('/')}/files/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Send the package's source to the executors, once for each application, so that they need no copy of their own."""
    context = spark.sparkContext
    if getattr(context, "_shipped_package", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, str(f.relative_to(package.parent)))
    context.addPyFile(str(archive))
    context._shipped_package = True
