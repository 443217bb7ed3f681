"""Dated employee versions (slowly changing dimension, type 2).

Every step is a plain function of DataFrames: existing versions in, new versions out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewlens.functions.text import match_key
from crewlens.model import EMPLOYEE_VERSION_COLUMNS, OPEN_END
from crewlens.operators.numbering import max_key

# employee_key = load number (20 bits) | current? (1 bit) | source id (42 bits). Each incoming row
# has its own source id, so the key needs no sort, shuffle or counter; it is the same when a lost
# task reruns, and a later load always gets larger keys.
_ID_BITS = 42
_LEAST_TOO_LARGE = 1 << _ID_BITS
_LOAD_SHIFT = _ID_BITS + 1


def _source_id(column: str) -> Column:
    """An id that fits its bits; any other fails, as its keys could meet those of other versions."""
    c = F.col(column)
    problem = F.concat(F.lit(f"{column} does not fit a version key: "), c.cast("string"))
    return F.when(
        (c < 0) | (c >= _LEAST_TOO_LARGE), F.raise_error(problem).cast("bigint")
    ).otherwise(c.cast("bigint"))


def valid_history(history: DataFrame) -> DataFrame:
    """History rows with a usable interval; role and reason trimmed."""
    return (
        history.filter(F.col("valid_from") <= F.col("valid_to"))
        .withColumn("job_role", F.trim("job_role"))
        .withColumn("change_reason", F.trim("change_reason"))
    )


def scd2_incoming(
    employees: DataFrame, history: DataFrame, departments: DataFrame, dim_department: DataFrame
) -> DataFrame:
    """Versions the sources describe: one open version per employee, plus the dated past.

    Past versions borrow the employee's present name, e-mail, age, gender, marital status and
    attrition; those in unknown departments or of unknown employees drop out.
    """
    keys = dim_department.select("department_id", "department_key")
    person = ["employee_id", "first_name", "last_name", "email", "age", "gender", "marital_status",
              "attrition"]
    current = employees.join(keys, "department_id").select(
        *person, "department_key", "job_role", "job_level", "monthly_income",
        F.coalesce("effective_from", "hire_date").alias("start_date"),
        F.lit(OPEN_END).cast("date").alias("end_date"),
        F.lit(True).alias("is_current"),
        F.lit(None).cast("string").alias("change_reason"),
        (F.lit(_LEAST_TOO_LARGE) + _source_id("employee_id")).alias("_source"),
    )
    names = departments.join(keys, "department_id").select(
        match_key(F.col("department_name")).alias("_department"), "department_key"
    )
    past = (
        valid_history(history)
        .withColumn("_department", match_key(F.col("department")))
        .join(names, "_department")
        .join(employees.select(*person), "employee_id")
        .select(
            *person, "department_key", "job_role", "job_level", "monthly_income",
            F.col("valid_from").alias("start_date"),
            F.col("valid_to").alias("end_date"),
            F.lit(False).alias("is_current"),
            "change_reason",
            _source_id("history_id").alias("_source"),
        )
    )
    return current.unionByName(past)


def _differs(left: str, right: str) -> Column:
    def col(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    return (
        (col(left, "start_date") != col(right, "start_date"))
        | (col(left, "department_key") != col(right, "department_key"))
        | (F.lower(col(left, "job_role")) != F.lower(col(right, "job_role")))
        | (col(left, "job_level") != col(right, "job_level"))
        | (col(left, "monthly_income") != col(right, "monthly_income"))
    )


def scd2_close(dim_employee: DataFrame, incoming: DataFrame) -> DataFrame:
    """End the open version of every employee whose incoming open version differs from it."""
    new = incoming.filter("is_current").select(
        "employee_id", "start_date", "department_key", "job_role", "job_level", "monthly_income"
    )
    closes = F.col("old.is_current") & F.coalesce(_differs("old", "new"), F.lit(False))
    replaced = {
        "end_date": F.when(closes, F.date_sub("new.start_date", 1)).otherwise(F.col("old.end_date")),
        "is_current": F.col("old.is_current") & ~closes,
    }
    return (
        dim_employee.alias("old")
        .join(new.alias("new"), F.col("old.employee_id") == F.col("new.employee_id"), "left")
        .select(*[
            replaced.get(c, F.col(f"old.{c}")).alias(c) for c in EMPLOYEE_VERSION_COLUMNS
        ])
    )


def scd2_insert(
    closed: DataFrame | None, incoming: DataFrame, before: DataFrame | None = None
) -> DataFrame:
    """Incoming versions not stored yet, with keys; `closed` is the dimension after scd2_close.

    Closing leaves keys alone: the stored table `before` it gives the last load number cheaper.
    """
    if closed is None:
        return _with_keys(incoming, F.lit(1).cast("bigint"))
    same = [
        F.col(f"new.{c}") == F.col(f"old.{c}")
        for c in ("employee_id", "start_date", "end_date", "department_key", "job_level",
                  "monthly_income", "is_current")
    ]
    same.append(F.lower("new.job_role") == F.lower("old.job_role"))
    unseen = incoming.alias("new").join(closed.alias("old"), same, "left_anti")
    last = max_key(closed if before is None else before, "employee_key")
    load = F.shiftright(last, _LOAD_SHIFT) + 1
    return _with_keys(unseen, load)


def _with_keys(versions: DataFrame, load: Column) -> DataFrame:
    return versions.withColumn(
        "employee_key", F.shiftleft(load, _LOAD_SHIFT) + F.col("_source")
    ).select(*EMPLOYEE_VERSION_COLUMNS)


def scd2_apply(
    dim_employee: DataFrame | None,
    employees: DataFrame,
    history: DataFrame,
    departments: DataFrame,
    dim_department: DataFrame,
    whole: DataFrame | None = None,
) -> DataFrame:
    """Close, then insert. Applying the same sources again changes nothing.

    `dim_employee` must be stored (a table or checkpoint): it is read more than once. Employees do
    not meet, so versions and sources may be those of some employees; `whole` then is the dimension
    of all, which gives the last load number.
    """
    incoming = scd2_incoming(employees, history, departments, dim_department)
    if dim_employee is None:
        return scd2_insert(None, incoming)
    closed = scd2_close(dim_employee, incoming)
    return closed.unionByName(scd2_insert(closed, incoming, dim_employee if whole is None else whole))
