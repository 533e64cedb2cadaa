"""A PySpark-native engine for versioned link data."""

from __future__ import annotations

import os
import tempfile
import zipfile

_shipped: set[str] = set()


def ship(spark) -> None:
    """Send this package to the executors, once an application; needed where it is not installed there."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    here = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="linkfold-"), "linkfold.zip")
    with zipfile.ZipFile(out, "w") as z:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("linkfold", os.path.relpath(path, here)))
    spark.sparkContext.addPyFile(out)
