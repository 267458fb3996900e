"""Let Python workers import this package where it is not installed on them."""

from __future__ import annotations

import os
import sys
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package with the session's jobs unless workers find it by themselves."""
    installed = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    application = spark.sparkContext.applicationId
    if ROOT in installed or application in _shipped or "site-packages" in ROOT.parts:
        return
    # Spark itself carries this driver-local file to the executors.
    archive = Path(tempfile.mkdtemp(prefix="panelweave-")) / "panelweave.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted((ROOT / "panelweave").rglob("*.py")):
            out.write(file, file.relative_to(ROOT))
    spark.sparkContext.addPyFile(str(archive))
    sys.path.remove(str(archive)) if str(archive) in sys.path else None
    _shipped.add(application)
