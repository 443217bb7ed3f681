"""Reading the corpus tables and small column helpers shared by the operators."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import crewlens
from crewlens.session import scratch_path

# Space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"[\x20\x09-\x0D]"
NOT_SPACES = r"[^\x20\x09-\x0D]"
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text, in order; none for a null text."""
    found = F.regexp_extract_all(text, F.lit(NOT_SPACES + "+"), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def lines(text: Column) -> Column:
    """The \\n-split lines of a text; none for a null text."""
    return F.coalesce(F.split(text, "\n"), F.array().cast("array<string>"))


def one_text(rows: DataFrame) -> DataFrame:
    """One row per id (and further columns): of an id's texts the one of least hash."""
    others = [c for c in rows.columns if c != "text"]
    return rows.groupBy(*others).agg(F.min_by("text", F.xxhash64("text")).alias("text"))


_SHIPPED: set[str] = set()


def python_ready(spark: SparkSession) -> None:
    """Before texts go to Python functions: they go a few at a time, so that memory holds some long
    ones and not thousands, and the executors get this package, wherever the driver found it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    top = Path(crewlens.__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(top.rglob("*.py")):
            archive.write(file, file.relative_to(top.parent))
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_path(spark, 'code')}/crewlens-code.zip")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    stream.write(packed.getvalue())
    stream.close()
    spark.sparkContext.addPyFile(path.toString())
    _SHIPPED.add(application)
