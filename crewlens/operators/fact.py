"""Review fact: each review linked to the employee version valid on its date."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crewlens.model import FACT_COLUMNS, Bronze, Gold, Silver
from crewlens.operators import dims
from crewlens.operators.scd2 import scd2_apply


def fact_point_in_time(
    reviews: DataFrame, dim_employee: DataFrame, dim_project: DataFrame, keep: tuple[str, ...] = ()
) -> DataFrame:
    """One row per review; reviews on a day without a version drop out. `keep` names further
    columns of reviews to retain.

    The as-of join hashes on the employee and compares dates within. Equal intervals of an
    employee are first reduced to the newest-loaded one, so copies of a version never multiply
    reviews. Where versions overlap, the latest start wins, then the newest-loaded.
    Ranking per (employee, review) reuses the join's partitioning: reviews are shuffled once.
    Where one employee holds many reviews, the skewed partition of the join is split at run time.
    The date key is computed, not looked up: the calendar holds every review date.
    """
    versions = (
        dim_employee.filter(F.col("start_date") <= F.col("end_date"))
        .groupBy("employee_id", "start_date", "end_date")
        .agg(
            F.max("employee_key").alias("employee_key"),
            F.max_by("department_key", "employee_key").alias("department_key"),
        )
    )
    projects = dim_project.select("project_id", "project_key")
    latest = Window.partitionBy("employee_id", "review_id").orderBy(
        F.col("start_date").desc(), F.col("employee_key").desc()
    )
    return (
        reviews.join(projects, "project_id")
        .join(versions, "employee_id")
        .filter(F.col("review_date").between(F.col("start_date"), F.col("end_date")))
        .withColumn("_rank", F.row_number().over(latest))
        .filter("_rank = 1")
        .select(
            F.col("review_id").alias("performance_review_key"),
            "review_id",
            "employee_key",
            "project_key",
            dims.date_key("review_date").alias("date_key"),
            "department_key",
            "performance_rating",
            "review_score",
            "job_satisfaction",
            "work_life_balance",
            "environment_satisfaction",
            F.lit(1).alias("review_count"),
            *[c for c in keep if c not in FACT_COLUMNS],
        )
        .select(*FACT_COLUMNS, *keep)
    )


def build_gold(silver: Silver, bronze: Bronze, existing: Gold | None = None) -> Gold:
    """Dimensions, versions and fact from the Silver snapshot and the staged history."""
    old = {} if existing is None else existing.tables()
    departments = dims.dim_department_upsert(old.get("dim_department"), silver.departments)
    projects = dims.dim_project_upsert(old.get("dim_project"), silver.projects, departments)
    employees = scd2_apply(
        old.get("dim_employee"), silver.employees, bronze.employee_history, silver.departments,
        departments,
    )
    return Gold(
        dim_department=departments,
        dim_project=projects,
        dim_date=dims.dim_date(silver.reviews, old.get("dim_date")),
        dim_employee=employees,
        fact_performance_reviews=fact_point_in_time(silver.reviews, employees, projects),
    )
