"""Makes this package importable in the Python workers of any cluster."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Sends the package's sources to the executors, once an application."""
    app = spark.sparkContext.applicationId
    if app not in _sent:
        root = Path(__file__).resolve().parent
        if root.is_dir():  # else it is in a shipped archive already
            target = Path(tempfile.mkdtemp(prefix="specfold-ship-")) / "specfold-src.zip"
            with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
                for p in sorted(root.rglob("*.py")):
                    out.write(p, Path("specfold") / p.relative_to(root))
            spark.sparkContext.addPyFile(str(target))
        _sent.add(app)
    return spark
