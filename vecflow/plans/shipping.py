"""Makes the repository's modules importable in Python workers that were not started with it on their path."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent.parent
_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the modules once per application, through Spark's own file server. Nothing is done where the workers find
    them anyway: where PYTHONPATH names the repository, or local workers start in it."""
    sc = spark.sparkContext
    app = sc.applicationId
    on_path = str(ROOT) in (os.environ.get("PYTHONPATH") or "").split(os.pathsep)
    if app in _SENT or on_path or Path.cwd() == ROOT:
        return
    _SENT.add(app)
    fd, name = tempfile.mkstemp(prefix="modules-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(name, "w") as z:
        for p in [*ROOT.glob("*.py"), *ROOT.glob("vecflow/**/*.py")]:
            z.write(p, p.relative_to(ROOT))
    sc.addPyFile(name)
