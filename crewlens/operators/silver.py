"""Staging to the conformed (3NF) layer: cleaning, de-duplication, foreign keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crewlens.functions.text import match_key, sentence_case
from crewlens.model import (
    ASSIGNMENT_COLUMNS,
    EMPLOYEE_COLUMNS,
    PROJECT_COLUMNS,
    REVIEW_COLUMNS,
    Bronze,
    Silver,
)
from crewlens.operators.lookups import without_lost
from crewlens.operators.numbering import max_key, number_rows
from crewlens.session import stored


def _has_department(df: DataFrame) -> DataFrame:
    return df.filter(F.trim("department") != "")


def clean_departments(stg_employee: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Distinct department names with an id.

    First load: ids follow name order. With `existing` ids (all ever given), names already known
    keep theirs and new ones get the next, so a new name never renumbers the others. Only names
    that staging holds now are returned.
    """
    names = (
        _has_department(stg_employee)
        .select(sentence_case(F.col("department")).alias("department_name"))
        .distinct()
    )
    if existing is None:
        return number_rows(names, "department_id", ["department_name"]).select(
            "department_id", "department_name"
        )
    known = existing.select("department_id", "department_name")
    added = number_rows(
        names.join(known, "department_name", "left_anti"),
        "department_id", ["department_name"], start=max_key(existing, "department_id"),
    )
    present = known.join(names, "department_name", "left_semi").select(known.columns)
    return present.unionByName(added.select(known.columns))


def department_lookup(departments: DataFrame) -> DataFrame:
    """Department ids under the key names are compared on.

    Hand in stored departments: their size is known, so Spark broadcasts them while they are small
    and splits the rows of a frequent department beyond that.
    """
    return departments.select(
        match_key(F.col("department_name")).alias("_department"), "department_id"
    )


def with_department_id(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """Inner join on the department's text; rows in unknown departments drop out."""
    return (
        df.withColumn("_department", match_key(F.col("department")))
        .join(lookup, "_department")
        .drop("_department", "department")
    )


def latest_employee(stg_employee: DataFrame) -> DataFrame:
    """Newest staging row per employee, cleaned.

    Keeping rank 1 makes Spark keep one row per employee on each map task before the shuffle,
    so even an employee with very many copies arrives as a handful of rows.
    """
    cleaned = _has_department(stg_employee).filter(F.col("employee_id").isNotNull()).select(
        "employee_id",
        F.trim("first_name").alias("first_name"),
        F.trim("last_name").alias("last_name"),
        F.lower(F.trim("email")).alias("email"),
        match_key(F.col("department")).alias("department"),
        F.trim("job_role").alias("job_role"),
        "job_level",
        "hire_date",
        "effective_from",
        "age",
        "gender",
        F.coalesce("marital_status", F.lit("Single")).alias("marital_status"),
        "monthly_income",
        "attrition",
    )
    # The remaining columns settle ties, so a rerun picks the same row.
    rest = [c for c in cleaned.columns if c not in ("employee_id", "hire_date", "effective_from")]
    newest = Window.partitionBy("employee_id").orderBy(
        F.coalesce("effective_from", "hire_date").desc(), F.col("hire_date").desc(),
        F.col("effective_from").desc(), *rest
    )
    return (
        cleaned.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")
    )


def clean_employees(stg_employee: DataFrame, lookup: DataFrame) -> DataFrame:
    return with_department_id(latest_employee(stg_employee), lookup).select(*EMPLOYEE_COLUMNS)


def _distinct_text(df: DataFrame, text: list[str]) -> DataFrame:
    """Distinct rows where case does not tell text apart; of several spellings the first in order
    is kept."""
    same = [F.lower(c).alias(f"_{c}") if c in text else F.col(c) for c in df.columns]
    spelling = F.min(F.struct(*text)).alias("_spelling")
    rows = df.groupBy(*same).agg(spelling)
    return rows.select(*[F.col(f"_spelling.{c}") if c in text else F.col(c) for c in df.columns])


def clean_projects(stg_project: DataFrame, lookup: DataFrame) -> DataFrame:
    rows = (
        with_department_id(stg_project.filter(F.col("project_id").isNotNull()), lookup)
        .withColumn("project_name", F.trim("project_name"))
        .select(*PROJECT_COLUMNS)
    )
    return _distinct_text(rows, ["project_name", "status"])


def _known_references(
    df: DataFrame, employees: DataFrame, projects: DataFrame, text: list[str], from_store: bool
) -> DataFrame:
    """Distinct rows whose references are known. In one plan with all before it, they are made distinct
    first; stored tables are read twice instead, and whole rows are shuffled once, to make them distinct."""
    columns = df.columns

    def distinct(rows: DataFrame) -> DataFrame:
        return _distinct_text(rows, text) if text else rows.distinct()

    if from_store:
        rows = without_lost(without_lost(df, projects, "project_id"), employees, "employee_id")
        return distinct(rows.select(*columns))
    return distinct(df).join(projects.select("project_id"), "project_id", "left_semi").join(
        employees.select("employee_id"), "employee_id", "left_semi"
    ).select(*columns)


def fk_filtered_assignments(
    stg_assignment: DataFrame, employees: DataFrame, projects: DataFrame, from_store: bool = False
) -> DataFrame:
    rows = stg_assignment.withColumn("role_on_project", F.trim("role_on_project"))
    return _known_references(
        rows.select(*ASSIGNMENT_COLUMNS), employees, projects, ["role_on_project"], from_store
    )


def fk_filtered_reviews(
    stg_review: DataFrame, employees: DataFrame, projects: DataFrame, from_store: bool = False
) -> DataFrame:
    return _known_references(stg_review.select(*REVIEW_COLUMNS), employees, projects, [], from_store)


def build_silver(bronze: Bronze, existing_departments: DataFrame | None = None) -> Silver:
    departments = stored(clean_departments(bronze.employee, existing_departments), "departments")
    lookup = department_lookup(departments)
    employees = clean_employees(bronze.employee, lookup)
    projects = clean_projects(bronze.project, lookup)
    return Silver(
        departments=departments,
        employees=employees,
        projects=projects,
        assignments=fk_filtered_assignments(bronze.assignment, employees, projects),
        reviews=fk_filtered_reviews(bronze.review, employees, projects),
    )
