"""Give the package to Python workers that cannot import it from where they start."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def runs_in_one_process(spark: SparkSession) -> bool:
    """Whether the executors are threads of the driver."""
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")


def ship(spark: SparkSession) -> None:
    """Send the package's sources to all executors, once for each application.

    Only where they are threads of the driver, and PYTHONPATH or the working folder has the package, is nothing sent.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    places = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()]
    if runs_in_one_process(spark) and any(p and Path(p).resolve() == ROOT for p in places):
        return
    made = Path(tempfile.mkdtemp(prefix="failcast-code-")) / "failcast.zip"
    with zipfile.ZipFile(made, "w") as out:
        for path in sorted((ROOT / "failcast").rglob("*.py")):
            out.write(path, path.relative_to(ROOT))
    spark.sparkContext.addPyFile(str(made))
