"""The package on the workers' import path, wherever the driver found it."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

import marquee

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the workers, once per application (as ``--py-files`` would).

    The archive is a few dozen files of source; Spark's file server hands it to executors.
    """
    app = spark.sparkContext.applicationId
    root = Path(marquee.__file__).parent
    if app in _shipped or not root.is_dir():
        return
    archive = shutil.make_archive(str(Path(tempfile.mkdtemp(prefix="marquee-")) / "marquee_src"), "zip",
                                  root.parent, root.name)
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
