"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "relweave", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped: set[str] = set()


def shipped(df: DataFrame) -> DataFrame:
    """`df`, once this package is on the Python path of the workers.

    Functions that run there refer to modules of the package, which a session started
    from another folder, or executors on other machines, would not find.
    """
    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        target = os.path.join(SparkFiles.getRootDirectory(), f"{os.path.basename(package)}-package.zip")
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
            for folder, _, names in os.walk(package):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        archive.write(path, os.path.relpath(path, os.path.dirname(package)))
        context.addPyFile(target)
        _shipped.add(context.applicationId)
    return df


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named by ``spark.checkpoint.dir``.

    Only a local session without that setting (tests, a laptop) gets a folder of
    its own; on a cluster a missing setting is an error, since a folder of one
    machine would be lost with it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="relweave-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder, so lost executors lose nothing."""
    folder = shared_dir(df.sparkSession)
    if not df.sparkSession.sparkContext.getCheckpointDir():
        df.sparkSession.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def plan_bytes(df: DataFrame) -> int:
    """Bytes of the tables a plan reads, an upper bound for its number of rows.

    Catalyst's own estimate multiplies both sides of a join; joins here never multiply
    rows (lookups and aggregated sides only), so the sum over the leaves is closer.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(_whole(leaves.apply(i).stats()) for i in range(leaves.size()))


UNKNOWN = 1 << 62  # as many bytes or more: Spark knows no size


def _whole(stats) -> int:
    """The size of an estimate; products of unknown sizes can have more digits than Python reads, and count as 2^62."""
    try:
        return min(int(str(stats.sizeInBytes())), UNKNOWN)
    except ValueError:
        return UNKNOWN


def output_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of a plan's output, the one broadcast decisions use."""
    return _whole(df._jdf.queryExecution().optimizedPlan().stats())
