"""Ships the package to Python workers that couldn't import it otherwise."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parents[2]
_done: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package to the session's files, once per application, unless PYTHONPATH has it."""
    app = spark.sparkContext.applicationId
    if app in _done or str(ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    folder = tempfile.mkdtemp(prefix="corvina-package-")
    spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/corvina", "zip", ROOT, "corvina"))
    _done.add(app)


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run
