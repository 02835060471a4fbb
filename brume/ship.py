"""Gives this package to Python workers that could not import it."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to all executors, once for each application.

    Nothing is sent where PYTHONPATH holds the package's folder: workers have it then.
    """
    sc = spark.sparkContext
    if str(ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or sc.applicationId in _shipped:
        return
    path = Path(tempfile.mkdtemp(prefix="brume-")) / "brume.zip"
    with zipfile.ZipFile(path, "w") as z:
        for file in sorted((ROOT / "brume").rglob("*.py")):
            z.write(file, file.relative_to(ROOT))
    sc.addPyFile(str(path))
    _shipped.add(sc.applicationId)


def shipped(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The query or stage, with the package sent first."""

    @functools.wraps(query)
    def run(spark: SparkSession, *args) -> DataFrame:
        ship(spark)
        return query(spark, *args)

    return run
