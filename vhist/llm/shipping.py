"""Make this package importable in Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_sent: dict[str, str] = {}


def ship_package(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once per application, so
    that workers can import it wherever the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId in _sent:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="vhist-src-"), "vhist_sources.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(os.path.join(_ROOT, "vhist")):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, _ROOT))
    sc.addPyFile(path)
    _sent[sc.applicationId] = path
