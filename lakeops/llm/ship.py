"""Make this package importable in Python workers that were started without it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the workers once per application, as ``--py-files`` does.

    Nothing to do where ``PYTHONPATH`` names its folder, which workers inherit.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped or str(_ROOT.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix=f"{_ROOT.name}-"), f"{_ROOT.name}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(_ROOT.rglob("*.py")):
            out.write(file, file.relative_to(_ROOT.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
