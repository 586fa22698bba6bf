"""The package on the workers: Spark sends it as a zip file unless the session has sent it already."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Make ``papyra`` importable in the session's Python workers, wherever the driver was started.

    The zip file lies in a folder of the driver; executors fetch it from Spark's own file server."""
    context = spark.sparkContext
    if context.applicationId not in _sent:
        package = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="papyra-")) / "papyra.zip"
        with zipfile.ZipFile(target, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(target))
        _sent.add(context.applicationId)
    return spark
