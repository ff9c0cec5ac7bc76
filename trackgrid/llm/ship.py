"""Send this package to the executors' Python workers, once per application."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Add the package as a zip file that Spark hands to every executor, also to later ones."""
    app = spark.sparkContext.applicationId
    if app not in _SENT:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        target = os.path.join(tempfile.mkdtemp(prefix="ship-"), "trackgrid_package.zip")
        with zipfile.ZipFile(target, "w") as z:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(package)))
        spark.sparkContext.addPyFile(target)
        _SENT.add(app)
    return spark
