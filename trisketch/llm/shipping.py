"""Send this package to the Python workers of executors that do not have it installed."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Add the package's sources to the session's Python files, once per application.

    The archive lies on the driver alone, which serves it to the executors.
    """
    app = spark.sparkContext.applicationId
    if app not in _SENT:
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        name = os.path.join(tempfile.mkdtemp(), "trisketch.zip")
        with zipfile.ZipFile(name, "w") as archive:
            for folder, _, files in os.walk(top):
                for file in files:
                    if file.endswith(".py"):
                        path = os.path.join(folder, file)
                        archive.write(path, os.path.relpath(path, os.path.dirname(top)))
        spark.sparkContext.addPyFile(name)
        _SENT.add(app)
    return spark
