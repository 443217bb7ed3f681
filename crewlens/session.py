"""Session settings the jobs rely on, and the shared folder for written tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Skewed employees and projects are split at run time. Forcing the split costs one more
# shuffle, and only in a join where a partition really is skewed.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}
# Of layers and of whole tables between steps.
CODEC = "zstd"
#: Folders that were stored inside the innermost open `passing` block; None outside of any.
_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only for a local session that names none."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder all executors share.")
    own = tempfile.mkdtemp(prefix="crewlens-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/crewlens/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write a frame that is read more than once to the shared folder, and go on from the files. They
    go when the application ends, or with a block of `passing`. `codec` for large tables: CODEC takes less disk for some more CPU."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write if codec is None else df.write.option("compression", codec)
    writer.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    if (made := _PASSING.get()) is not None:
        made.append(path)
    return spark.read.parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables stored inside the block go when it ends, so that they take no disk beside what comes later.
    What it yields returns its frame and keeps the stored tables that the frame reads, for the block
    around it or until the application ends."""
    made, kept, outer = [], set(), _PASSING.get()

    def keep(frame: DataFrame) -> DataFrame:
        kept.update(file.split("/")[-2] for file in frame.inputFiles())
        return frame

    token = _PASSING.set(made)
    try:
        yield keep
    finally:
        _PASSING.reset(token)
        for path in made:
            if path.rsplit("/", 1)[1] not in kept:
                folder = spark._jvm.org.apache.hadoop.fs.Path(path)
                folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
            elif outer is not None:
                outer.append(path)
