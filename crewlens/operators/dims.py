"""Type-1 dimensions: insert-or-update on the business key, surrogate keys kept over loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewlens.model import DIM_PROJECT_COLUMNS
from crewlens.operators.numbering import max_key, number_rows


def upsert(
    existing: DataFrame | None,
    incoming: DataFrame,
    business_key: str,
    surrogate_key: str,
    columns: Sequence[str],
) -> DataFrame:
    """Incoming rows win, missing ones stay; a known row keeps its key, a new one gets the next."""
    order = [surrogate_key, business_key, *columns]
    if existing is None:
        return number_rows(
            incoming, surrogate_key, [business_key]
        ).select(*order)
    old, new = existing.alias("old"), incoming.alias("new")
    is_new = F.col(f"new.{business_key}").isNotNull()
    merged = old.join(new, F.col(f"old.{business_key}") == F.col(f"new.{business_key}"), "full").select(
        F.col(f"old.{surrogate_key}").alias(surrogate_key),
        F.coalesce(f"new.{business_key}", f"old.{business_key}").alias(business_key),
        *[F.when(is_new, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in columns],
    )
    known = merged.filter(F.col(surrogate_key).isNotNull())
    added = number_rows(
        merged.filter(F.col(surrogate_key).isNull()).drop(surrogate_key),
        surrogate_key,
        [business_key],
        start=max_key(existing, surrogate_key),
    )
    return known.select(*order).unionByName(added.select(*order))


def dim_department_upsert(existing: DataFrame | None, departments: DataFrame) -> DataFrame:
    return upsert(existing, departments, "department_id", "department_key", ["department_name"])


def dim_project_upsert(
    existing: DataFrame | None, projects: DataFrame, dim_department: DataFrame
) -> DataFrame:
    incoming = (
        projects.join(dim_department.select("department_id", "department_key"), "department_id")
        .withColumn("project_name", F.trim("project_name"))
        .withColumnRenamed("start_date", "project_start_date")
    )
    return upsert(existing, incoming, "project_id", "project_key", DIM_PROJECT_COLUMNS[2:])


def date_key(column: str):
    return F.date_format(column, "yyyyMMdd").cast("int")


def dim_date(reviews: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Calendar attributes of every review date seen so far (dates are made distinct first)."""
    dates = reviews.filter(F.col("review_date").isNotNull()).select(
        F.col("review_date").alias("full_date")
    )
    if existing is not None:
        dates = dates.unionByName(existing.select("full_date"))
    d = F.col("full_date")
    return dates.distinct().select(
        date_key("full_date").alias("date_key"),
        "full_date",
        F.dayofmonth(d).alias("day_of_month"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter_number"),
        F.year(d).alias("year_number"),
        F.weekofyear(d).alias("week_number"),
        F.date_format(d, "EEEE").alias("day_name"),
    )
