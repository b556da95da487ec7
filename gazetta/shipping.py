"""Sending this package to the Python workers, so that they need neither a shared disk nor an installation."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once for each application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = Path(__file__).resolve().parent
    out = Path(tempfile.mkdtemp(prefix="gazetta-")) / "gazetta_pkg.zip"
    with zipfile.ZipFile(out, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    spark.sparkContext.addPyFile(str(out))
    _shipped.add(app)
