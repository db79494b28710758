"""Making the package importable in Python workers, which need not start where the driver did."""

from __future__ import annotations

import io
import os
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parents[2]
_shipped: set[str] = set()


def importable(spark: SparkSession) -> None:
    """The driver's package folder joins the workers' search path; on a cluster the package itself is added from the
    shared folder, once per application."""
    context = spark.sparkContext
    paths = [p for p in context.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if str(ROOT) not in paths:
        context.environment["PYTHONPATH"] = os.pathsep.join([*paths, str(ROOT)])
    if context.master.startswith("local") or context.applicationId in _shipped or not spark.conf.get("spark.checkpoint.dir", None):
        return
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted((ROOT / "hablon").rglob("*.py")):
            z.write(path, path.relative_to(ROOT))
    target = f"{spark.conf.get('spark.checkpoint.dir').rstrip('/')}/packages/{context.applicationId}/hablon.zip"
    place = context._jvm.org.apache.hadoop.fs.Path(target)
    out = place.getFileSystem(context._jsc.hadoopConfiguration()).create(place, True)
    out.write(bytearray(buffer.getvalue()))
    out.close()
    context.addPyFile(target)
    _shipped.add(context.applicationId)


def prepared(df: DataFrame) -> DataFrame:
    """``df``, about to be handed to Python workers."""
    importable(df.sparkSession)
    return df
