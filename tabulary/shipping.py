"""Make this package importable in the executors' Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_ROOT = os.path.dirname(os.path.abspath(__file__))


def ship(spark: SparkSession) -> None:
    """Send the package's modules to all executors, once per application.

    Workers unpickle functions by module name; where the cluster has not
    installed the package, they find it in the archive that Spark hands them.
    """
    context = spark.sparkContext
    if getattr(context, "_tabulary_shipped", False):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="tabulary-"), "tabulary.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(_ROOT):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(_ROOT)))
    context.addPyFile(archive)
    context._tabulary_shipped = True
