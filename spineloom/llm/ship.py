"""Sends this package to the executors, for sessions whose workers do not have it on their path."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package as a zip to the application's Python files, once per application."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    package = Path(__file__).resolve().parents[1]
    with tempfile.TemporaryDirectory() as folder:
        staged = Path(folder, "staged")
        shutil.copytree(package, staged / package.name, ignore=shutil.ignore_patterns("__pycache__"))
        fixed = shutil.make_archive(os.path.join(folder, f"{package.name}-package"), "zip", staged)
        kept = os.path.join(tempfile.mkdtemp(prefix="spineloom-"), os.path.basename(fixed))
        shutil.copyfile(fixed, kept)
    context.addPyFile(kept)
    _sent.add(context.applicationId)
