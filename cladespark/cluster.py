"""Getting the package to the executors' Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends the package's source to the workers, unless PYTHONPATH already leads to it.

    The archive is served by the driver; nothing is read from the driver's disk elsewhere.
    """
    context = spark.sparkContext
    if str(_ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp()) / "cladespark.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted((_ROOT / "cladespark").rglob("*.py")):
            out.write(path, path.relative_to(_ROOT))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
