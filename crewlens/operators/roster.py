"""Lists, searches and single-person views."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewlens.functions.text import contains, full_name
from crewlens.model import Silver

_PROJECT_VIEW = [
    "project_id", "project_name", "department_name", "start_date", "planned_end_date", "status",
    "budget",
]


def departments(silver: Silver) -> DataFrame:
    return silver.departments.select("department_id", "department_name").orderBy("department_name")


def statuses(silver: Silver) -> DataFrame:
    """The project statuses in use, sorted."""
    return silver.projects.select("status").filter("status IS NOT NULL").distinct().orderBy("status")


def employee(silver: Silver, employee_id: int) -> DataFrame:
    """Point lookup: one row, or none."""
    return silver.employees.filter(F.col("employee_id") == employee_id).limit(1)


def list_employees(silver: Silver, search: str | None = None, limit: int = 100) -> DataFrame:
    """`search` is part of a name or e-mail address; case does not matter."""
    rows = silver.employees
    if search:
        rows = rows.filter(contains(full_name(), search) | contains(F.col("email"), search))
    return (
        rows.join(silver.departments, "department_id")
        .select(
            "employee_id", "first_name", "last_name", "email", "department_name", "job_role",
            "job_level", "monthly_income", "effective_from", "attrition",
        )
        .orderBy("employee_id")
        .limit(int(limit))
    )


def list_projects(
    silver: Silver, search: str | None = None, employee_id: int | None = None, limit: int = 200
) -> DataFrame:
    """Digits search for the id, other text for part of the name; optionally one person's projects."""
    rows = silver.projects
    if search and str(search).isdigit():
        rows = rows.filter(F.col("project_id") == int(search))
    elif search:
        rows = rows.filter(contains(F.col("project_name"), search))
    if employee_id is not None:
        mine = silver.assignments.filter(F.col("employee_id") == employee_id).select("project_id")
        rows = rows.join(mine, "project_id", "left_semi")
    return (
        rows.join(silver.departments, "department_id")
        .select(*_PROJECT_VIEW)
        .orderBy(F.col("project_id").desc())
        .limit(int(limit))
    )


def employee_projects(
    silver: Silver, employee_id: int | None = None, limit: int | None = 200
) -> DataFrame:
    """Distinct projects of one person, newest first; of everybody when no id is given.

    Pairs are made distinct before names are joined on.
    """
    pairs = silver.assignments.select("employee_id", "project_id")
    if employee_id is not None:
        pairs = pairs.filter(F.col("employee_id") == employee_id)
    rows = (
        pairs.distinct()
        .join(silver.projects, "project_id")
        .join(silver.departments, "department_id")
    )
    if employee_id is None:
        return rows.select("employee_id", *_PROJECT_VIEW)
    rows = rows.select(*_PROJECT_VIEW).orderBy(F.col("project_id").desc())
    return rows if limit is None else rows.limit(int(limit))


def _with_employee_name(rows: DataFrame, silver: Silver) -> DataFrame:
    names = silver.employees.select("employee_id", full_name().alias("employee_name"))
    return rows.join(names, "employee_id")


def list_assignments(silver: Silver, project_id: int | None = None, limit: int = 300) -> DataFrame:
    rows = silver.assignments
    if project_id is not None:
        rows = rows.filter(F.col("project_id") == project_id)
    newest = [F.col("assigned_date").desc(), F.col("assignment_id").desc()]
    # Every assignment has its employee, so the newest rows can be cut before names are joined on.
    return (
        _with_employee_name(rows.orderBy(*newest).limit(int(limit)), silver)
        .select(
            "assignment_id", "employee_id", "employee_name", "project_id", "role_on_project",
            "allocation_pct", "assigned_date",
        )
        .orderBy(*newest)
    )


def list_reviews(silver: Silver, employee_id: int | None = None, limit: int = 200) -> DataFrame:
    rows = silver.reviews
    if employee_id is not None:
        rows = rows.filter(F.col("employee_id") == employee_id)
    newest = [F.col("review_date").desc(), F.col("review_id").desc()]
    return (
        _with_employee_name(rows.orderBy(*newest).limit(int(limit)), silver)
        .select(
            "review_id", "employee_id", "employee_name", "project_id", "review_date",
            "performance_rating", "review_score", "job_satisfaction", "work_life_balance",
            "environment_satisfaction",
        )
        .orderBy(*newest)
    )


def employee_history(
    dim_employee: DataFrame, dim_department: DataFrame, employee_id: int | None = None
) -> DataFrame:
    """Versions of one person by start date; of everybody when no id is given."""
    rows = dim_employee
    if employee_id is not None:
        rows = rows.filter(F.col("employee_id") == employee_id)
    rows = rows.join(dim_department.select("department_key", "department_name"), "department_key")
    rows = rows.select(
        "employee_id", "department_name", "job_role", "job_level", "monthly_income", "start_date",
        "end_date", "is_current",
    )
    return rows if employee_id is None else rows.orderBy("start_date", "end_date")


def history_timeline(history: DataFrame, as_of: datetime.date) -> DataFrame:
    """History ready to draw: open versions end on `as_of`, and are labelled "current"."""
    return history.select(
        "employee_id",
        F.concat(F.lit("Employee "), F.col("employee_id")).alias("employee"),
        F.concat_ws(" / ", "department_name", "job_role").alias("version"),
        "job_level",
        "monthly_income",
        F.col("start_date").alias("start_plot"),
        F.when(F.col("is_current"), F.lit(as_of)).otherwise(F.col("end_date")).alias("end_plot"),
        F.when(F.col("is_current"), "current")
        .otherwise(F.col("end_date").cast("string"))
        .alias("end_label"),
    )
