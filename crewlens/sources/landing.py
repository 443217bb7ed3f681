"""Staging files: reading, loading and writing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crewlens.model import STAGING, Bronze
from crewlens.sources import records

# Columns the raw HR file must have, and the constant ones it may drop.
REQUIRED_COLUMNS = [
    "age", "attrition", "department", "job_role", "job_level", "monthly_income",
    "years_at_company", "performance_rating", "gender", "job_satisfaction",
    "work_life_balance", "environment_satisfaction",
]
CONSTANT_COLUMNS = ["employee_count", "employee_number", "over18", "standard_hours"]
RAW_TEXT_COLUMNS = [
    "attrition", "business_travel", "department", "education_field", "gender", "job_role",
    "marital_status", "over18", "over_time",
]

# A value may hold line ends.
_CSV = {**records.CSV, "multiLine": True}


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(hadoop_path)


def last_change(spark: SparkSession, folder: str) -> int:
    """Newest modification time (ms) of the files directly in a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return max((s.getModificationTime() for s in files.listStatus(path)), default=0)


def _must_exist(spark: SparkSession, path: str) -> str:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"{path} not found.")
    return path


def snake_case(name: str) -> str:
    """'MonthlyIncome' -> 'monthly_income': capitals begin words, and words are joined by a line."""
    words = [""]
    for letter in name:
        if "A" <= letter <= "Z":
            words.append("")
        words[-1] += letter.lower()
    return "_".join(words[0 if words[0] or len(words) == 1 else 1:])


def raw_hr_ingest(spark: SparkSession, path: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw HR file with snake_case names, checked for required columns, constant columns dropped.

    The column order of the file is free, so its header line is read first and gives the schema:
    known text columns are text, all others whole numbers. `keep` names constant columns to retain.
    """
    _must_exist(spark, path)
    header = records.header(spark, path)
    names = [snake_case(c) for c in header]
    missing = [c for c in REQUIRED_COLUMNS if c not in names]
    if missing:
        raise ValueError(f"Source CSV missing required columns: {missing}")
    schema = T.StructType([
        T.StructField(
            raw, T.StringType() if name in RAW_TEXT_COLUMNS else T.IntegerType(), True
        )
        for raw, name in zip(header, names)
    ])
    raw = records.read_csv(spark, path, schema)
    return raw.toDF(*names).drop(*[c for c in CONSTANT_COLUMNS if c not in keep])


def write_staging(tables: dict[str, DataFrame], folder: str) -> None:
    """One `<table>.csv` folder of part files per staging table, dates as yyyy-MM-dd."""
    for name, df in tables.items():
        # Columns a table does not have are written empty.
        present = set(df.columns)
        full = df.select(*[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in STAGING[name]
        ])
        full.write.mode("overwrite").options(**_CSV).csv(f"{folder}/{name}.csv")


def read_staging(spark: SparkSession, folder: str) -> Bronze:
    """The five staging tables, typed by their declared schemas, with the load time.

    Columns are found by name, in any order; one a file does not have is NULL. A missing file, an
    unknown column or a value that does not fit its type fails the load.
    """
    frames = []
    for name, schema in STAGING.items():
        path = _must_exist(spark, f"{folder}/{name}.csv")
        header = records.header(spark, path)
        unknown = set(header) - set(schema.names) - {"_loaded_at"}
        if unknown:
            raise ValueError(f"{name} has unknown columns: {sorted(unknown)}")
        found = T.StructType([
            schema[c] if c in schema.names else T.StructField(c, T.TimestampType()) for c in header
        ])
        rows = records.read_csv(spark, path, found)
        columns = [
            F.col(f.name) if f.name in header else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema
        ]
        frames.append(rows.select(*columns, F.current_timestamp().alias("_loaded_at")))
    return Bronze(*frames)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts


def shapes(tables: dict[str, DataFrame]) -> dict[str, tuple[int, int]]:
    """(rows, columns) per table."""
    counts = {r["table_name"]: r["row_count"] for r in row_counts(tables).collect()}
    return {name: (counts[name], len(STAGING[name].names)) for name in tables}


def read(spark: SparkSession, sql: str, tables: dict[str, DataFrame], **parameters) -> DataFrame:
    """A SELECT over the given frames ({name} in the text) with :named parameters."""
    return spark.sql(sql, args=parameters, **tables)


def read_one(df: DataFrame) -> dict | None:
    """First row as a dict, None for an empty result."""
    row = df.first()
    return row.asDict() if row else None
