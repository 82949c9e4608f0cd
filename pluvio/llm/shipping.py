"""Make the package importable on executors."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile

import pluvio

_shipped: set[str] = set()


def ship_package(spark) -> None:
    """Give the application's executors the package as a zip (once per
    application), so Python tasks can import the operators wherever the driver
    was started. Spark's own file server hands it out."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(pluvio.__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="pluvio-code-"), "pluvio.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "pluvio")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, root))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def shipped(fn):
    """Decorator for ``fn(spark, ...)``: the package is on the executors first."""

    @functools.wraps(fn)
    def run(spark, *args, **kwargs):
        ship_package(spark)
        return fn(spark, *args, **kwargs)

    return run
