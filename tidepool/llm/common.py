"""Reading helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows per Arrow batch; texts vary from one word to megabytes, so batches
#: are kept short (Spark also closes a batch at arrow.maxBytesPerBatch).
BATCH_ROWS = "1000"
BATCH_BYTES = str(16 << 20)
#: Bytes of text that the numpy work of an operator holds arrays for at once.
PART_BYTES = 256 << 10


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once an application, so that their
    Python workers can import it wherever the driver was started from."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    at = os.path.join(tempfile.mkdtemp(prefix="tidepool-code-"), "tidepool.zip")
    with zipfile.ZipFile(at, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(at)  # Spark serves the file itself
    _SHIPPED.add(app)


def prepare(spark: SparkSession) -> None:
    """The package on the executors, and settings the Arrow stages rely on."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    # joins turn into broadcasts only for a materialised side of this size
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "4MB")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns(df: DataFrame, **kinds: str) -> DataFrame:
    """Only the named columns, cast to ``kinds``; other columns of the input
    (whatever their names) never reach an operator."""
    return df.select(*[F.col(f"`{c}`").cast(kind).alias(c) for c, kind in kinds.items()])


def parts(batches: Iterator[pa.RecordBatch], size: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """All rows in their order, in batches of about ``size`` bytes of ``text``
    (a longer text alone in one): a worker's memory follows ``size``, not the
    batch. Only for work on one text at a time. Empty batches stay."""
    for batch in batches:
        n = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        end, at = np.cumsum(n), 0
        while True:
            done = end[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(end, done + size, side="right")))
            yield batch.slice(at, to - at)
            at = to
            if at >= len(n):
                break


def tree(parts: RDD, add: Callable[[Any, Any], Any]) -> Any:
    """All values joined by ``add``, pairwise in a tree on the executors; the
    driver gets the few last ones. None without values."""
    def either(a: Any, b: Any) -> Any:
        return b if a is None else a if b is None else add(a, b)
    return parts.treeAggregate(None, either, either, depth=3)
