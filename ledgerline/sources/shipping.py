"""The package's own code on the executors, and how much of a table its Python functions hold at once."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()
#: Bytes of an Arrow batch, about. Spark's own bound is by rows, and rows may be whole texts.
BATCH_BYTES, LIMIT = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Hand the package to all executors, once for each application; Python functions refer to its modules by name.

    Their Arrow batches are bounded by bytes from then on, unless the session has a bound of its own.
    """
    if spark.conf.get(LIMIT, None) is None:
        spark.conf.set(LIMIT, str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    root = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp()  # on the driver; Spark hands the file to the executors, and may do so until the end
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = Path(folder, f"{root.name}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for p in root.rglob("*.py"):
            z.write(p, p.relative_to(root.parent))
    context.addPyFile(str(archive))
