"""What a session needs before Python code of this package runs in its tasks."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Send the package to the executors once, and bound the Arrow batches by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5000")
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        path = Path(tempfile.mkdtemp(prefix="stardw-code-")) / f"{PACKAGE.name}.zip"
        with zipfile.ZipFile(path, "w") as z:
            for file in sorted(PACKAGE.rglob("*.py")):
                z.write(file, file.relative_to(PACKAGE.parent))
        spark.sparkContext.addPyFile(str(path))
        _shipped.add(app)
