"""Batches of change requests against the Silver tables.

Each request carries `seq`, its place in the queue. A function returns the judged requests
(every request once: `accepted` and a `message`) and how they change Silver. The outcome is that of
handling the requests one after the other, worked out set-wise. Silver tables and requests handed
in should be stored ones: a batch reads them more than once. `as_of` is the day of the run.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crewlens.functions.rules import employee_rules, first_broken, project_rules, review_rules, unless
from crewlens.functions.text import fill, is_blank, match_key, strip
from crewlens.model import (
    ACCOUNT_ROLES,
    ASSIGNMENT_COLUMNS,
    EMPLOYEE_COLUMNS,
    PROJECT_COLUMNS,
    PROJECT_STATUSES,
    REVIEW_COLUMNS,
    ROLE_BY_DEPARTMENT,
    Silver,
)
from crewlens.operators.lookups import own_exchange
from crewlens.operators.numbering import max_key, number_rows, previous_value
from crewlens.session import CODEC, stored

# Messages shown to users.
EMPLOYEE_CONFLICT = "Could not save: that email already exists or the department is invalid."
DEPARTMENT_INVALID = "Invalid department selected."
REFERENCE_MISSING = "Employee id or project id does not exist."
NOTHING_CHANGED = "Nothing changed - no new history record needed."
CHANGED_TODAY = "This employee was already changed today. Try again tomorrow."
LEVEL_OR_INCOME = "Job level must be 1-5 and income must be above 0."
ATTRITION_VALUE = "Attrition status must be 'Yes' or 'No'."
EMPLOYEE_UPDATED = "Employee updated and a new history record was created in the warehouse."
STATUS_VALUE = f"Status must be one of {PROJECT_STATUSES}."
ASSIGN_ROLE = "Role on project is required."
ASSIGN_RANGE = "Allocation must be between 1 and 100."
ASSIGN_TWICE = "This employee is already on this project."
ASSIGNED = "Employee assigned to project."
DELETED = "Employee deleted."
EMPLOYEE_MISSING = "Employee not found."
SYNC_FAILED = "Saved, but the warehouse update failed:"
HIRE_SYNC_FAILED = "Employee {employee_id} saved, but the warehouse update failed:"
STATUS_SYNC_FAILED = "Project status updated in Silver, but warehouse sync failed:"
ACCOUNT_ROLE = "Role must be Admin or Viewer."
ACCOUNT_NAME = "Username and password are required."
ACCOUNT_PASSWORD = "Password must be at least 8 characters long."
LEAST_PASSWORD = 8
ACCOUNT_REQUIRED = "Work email and password are required."
ACCOUNT_UNKNOWN = "That work email is not associated with an employee."
ACCOUNT_DEPARTMENT = "Your department is not eligible for access."
ACCOUNT_TAKEN = "That username already exists."
REFRESH_HINT = "Click 'Refresh warehouse' to see it in the dashboards."


@dataclass(frozen=True)
class Outcome:
    """Judged requests, and how they change Silver, or those parts of its tables that hold their
    employees. A job stores the requests first."""

    requests: DataFrame
    before: Silver
    change: Callable[[Silver, DataFrame], Silver]

    @property
    def silver(self) -> Silver:
        return self.change(self.before, self.requests)

    @property
    def accepted(self) -> DataFrame:
        return self.requests.filter("accepted")

    @property
    def rejected(self) -> DataFrame:
        return self.requests.filter(~F.col("accepted"))


def validate_employees(records: DataFrame, as_of: datetime.date) -> DataFrame:
    return records.withColumn("reason", employee_rules(F.lit(as_of)))


def validate_projects(records: DataFrame) -> DataFrame:
    return records.withColumn("reason", project_rules())


def validate_reviews(records: DataFrame, as_of: datetime.date) -> DataFrame:
    return records.withColumn("reason", review_rules(F.lit(as_of)))


def _marked(df: DataFrame, keys: DataFrame, on: str, name: str) -> DataFrame:
    """Add a boolean: does `on` occur in `keys` (unique there)?"""
    marked = df.join(own_exchange(keys.select(on, F.lit(True).alias(name)), on), on, "left")
    return marked.withColumn(name, F.coalesce(name, F.lit(False)))


def _first_per(df: DataFrame, key: str, name: str) -> DataFrame:
    """Add a boolean: is this the lowest `seq` of its key? Folded before the shuffle, so a key
    that most requests share costs no more than a rare one."""
    firsts = df.groupBy(key).agg(F.min("seq").alias("seq"))
    return _marked(df, firsts, "seq", name)


def _numbered(judged: DataFrame, table: DataFrame, id_column: str) -> DataFrame:
    """Give accepted requests the next ids in queue order; `reason` stays for the others."""
    decided = stored(judged, "judged", CODEC)
    accepted = number_rows(
        decided.filter(F.col("reason").isNull()),
        id_column, ["seq"], start=max_key(table, id_column),
    )
    rejected = decided.filter(F.col("reason").isNotNull())
    return accepted.unionByName(
        rejected.withColumn(id_column, F.lit(None).cast("bigint"))
    )


def _with_message(judged: DataFrame, success: Column) -> DataFrame:
    return (
        judged.withColumn("accepted", F.col("reason").isNull())
        .withColumn("message", F.coalesce("reason", success))
        .drop("reason")
    )


def _appending(table: str, columns: list[str]) -> Callable[[Silver, DataFrame], Silver]:
    """Silver with the accepted requests added to a table."""

    def change(silver: Silver, requests: DataFrame) -> Silver:
        rows = requests.filter("accepted").select(*columns)
        return replace(silver, **{table: getattr(silver, table).select(*columns).unionByName(rows)})

    return change


def add_employees(requests: DataFrame, silver: Silver, as_of: datetime.date) -> Outcome:
    """New staff: record rules, then unique e-mail (case aside) and known department."""
    cleaned = requests.select(
        "seq",
        strip(F.col("first_name")).alias("first_name"),
        strip(F.col("last_name")).alias("last_name"),
        F.lower(strip(F.col("email"))).alias("email"),
        "department_id",
        strip(F.col("job_role")).alias("job_role"),
        "job_level", "hire_date", F.col("hire_date").alias("effective_from"), "age", "gender",
        F.coalesce("marital_status", F.lit("Single")).alias("marital_status"),
        "monthly_income",
        F.coalesce("attrition", F.lit("No")).alias("attrition"),
    )
    taken = silver.employees.select(F.lower("email").alias("email")).distinct()
    departments = silver.departments.select("department_id")
    checked = _marked(validate_employees(cleaned, as_of), taken, "email", "_taken")
    checked = _marked(checked, departments, "department_id", "_department")
    fits = F.col("reason").isNull() & ~F.col("_taken") & F.col("_department")
    first = checked.filter(fits).groupBy("email").agg(F.min("seq").alias("seq"))
    judged = _marked(checked, first, "seq", "_first").withColumn(
        "reason",
        F.coalesce("reason", F.when(~F.col("_first"), EMPLOYEE_CONFLICT)),
    ).drop("_taken", "_department", "_first")
    success = fill("Employee {employee_id} ({first_name} {last_name}) added.")
    result = _with_message(_numbered(judged, silver.employees, "employee_id"), success)
    return Outcome(result, silver, _appending("employees", EMPLOYEE_COLUMNS))


def add_projects(requests: DataFrame, silver: Silver) -> Outcome:
    departments = silver.departments.select("department_id")
    cleaned = requests.withColumn("project_name", strip(F.col("project_name")))
    judged = _marked(validate_projects(cleaned), departments, "department_id", "_department")
    judged = judged.withColumn(
        "reason", F.coalesce("reason", F.when(~F.col("_department"), DEPARTMENT_INVALID))
    ).drop("_department")
    success = fill("Project {project_id} created. " + REFRESH_HINT)
    result = _with_message(_numbered(judged, silver.projects, "project_id"), success)
    return Outcome(result, silver, _appending("projects", PROJECT_COLUMNS))


def add_reviews(requests: DataFrame, silver: Silver, as_of: datetime.date) -> Outcome:
    judged = _marked(validate_reviews(requests, as_of), silver.projects, "project_id", "_project")
    judged = _marked(judged, silver.employees, "employee_id", "_employee")
    judged = judged.withColumn(
        "reason",
        F.coalesce(
            "reason", F.when(~(F.col("_project") & F.col("_employee")), REFERENCE_MISSING)
        ),
    ).drop("_project", "_employee")
    success = fill("Review {review_id} saved. " + REFRESH_HINT)
    result = _with_message(_numbered(judged, silver.reviews, "review_id"), success)
    return Outcome(result, silver, _appending("reviews", REVIEW_COLUMNS))


_CHANGED = ["department_id", "job_role", "job_level", "monthly_income", "attrition"]


def _unchanged(stored: str) -> Column:
    same = F.lit(True)
    for column in _CHANGED:
        same = same & F.col(f"{stored}.{column}").eqNullSafe(F.col(column))
    return same


def apply_employee_changes(requests: DataFrame, silver: Silver, as_of: datetime.date) -> Outcome:
    """Department, role, level, income or attrition changes; at most one per employee and day.

    The first request of an employee that passes every rule against the stored row is the day's
    change. Earlier requests are judged against the stored row, later ones against the new one.
    """
    today = F.lit(as_of)
    stored = silver.employees.select(
        "employee_id", F.struct(*_CHANGED, "effective_from").alias("_stored")
    )
    departments = silver.departments.select("department_id")
    wanted = requests.select(
        "seq", "employee_id", "department_id", strip(F.col("job_role")).alias("job_role"), "job_level",
        "monthly_income", "attrition",
    )
    known = _marked(wanted, departments, "department_id", "_department").join(
        stored, "employee_id", "left"
    )
    first_look = known.withColumn(
        "_reason",
        first_broken(
            (
                F.col("_stored").isNull(),
                fill("Employee {employee_id} not found."),
            ),
            (_unchanged("_stored"), NOTHING_CHANGED),
            (F.col("_stored.effective_from") >= today, CHANGED_TODAY),
            (
                unless(F.col("job_level").between(1, 5) & (F.col("monthly_income") > 0)),
                LEVEL_OR_INCOME,
            ),
            (unless(F.col("attrition").isin("Yes", "No")), ATTRITION_VALUE),
            (~F.col("_department"), DEPARTMENT_INVALID),
        ),
    )
    change = (
        first_look.filter(F.col("_reason").isNull())
        .groupBy("employee_id")
        .agg(F.min(F.struct("seq", *_CHANGED)).alias("_change"))
    )
    is_later = F.coalesce(F.col("seq") > F.col("_change.seq"), F.lit(False))
    # Most requests may be for one employee: their rows are dealt out anew and can be split.
    looked = own_exchange(first_look, "employee_id")
    judged = looked.join(own_exchange(change, "employee_id"), "employee_id", "left").withColumn(
        "reason",
        F.when(is_later & _unchanged("_change"), NOTHING_CHANGED)
        .when(is_later, CHANGED_TODAY)
        .otherwise(F.col("_reason")),
    )
    result = _with_message(judged, F.lit(EMPLOYEE_UPDATED)).select(
        "seq", "employee_id", *_CHANGED, "accepted", "message"
    )

    def change_rows(silver: Silver, judged: DataFrame) -> Silver:
        accepted = judged.filter("accepted").select("employee_id", F.struct(*_CHANGED).alias("_new"))
        changed = F.col("_new").isNotNull()
        values = {c: F.col(f"_new.{c}") for c in _CHANGED} | {"effective_from": today}
        employees = silver.employees.join(accepted, "employee_id", "left").select(*[
            F.when(changed, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
            for c in EMPLOYEE_COLUMNS
        ])
        return replace(silver, employees=employees)

    return Outcome(result, silver, change_rows)


def update_project_status(requests: DataFrame, silver: Silver) -> Outcome:
    """Status changes in queue order. A request for the status already set changes nothing, so the
    state a request meets is simply the previous valid request's status, or the stored one."""
    known = silver.projects.select(
        "project_id", "project_name", F.col("status").alias("_stored")
    )
    checked = (
        requests.select("seq", "project_id", strip(F.col("status")).alias("status"))
        .join(known, "project_id", "left")
        .withColumn(
            "_reason",
            first_broken(
                (unless(F.col("status").isin(PROJECT_STATUSES)), STATUS_VALUE),
                (
                    F.col("_stored").isNull(),
                    fill("Project ID {project_id} not found."),
                ),
            ),
        )
    )
    # Only valid requests set a status.
    judged = previous_value(
        checked.withColumn("_sets", F.when(F.col("_reason").isNull(), F.col("status"))),
        "_earlier", "project_id", "seq", "_sets",
    ).withColumn(
        "reason",
        F.coalesce(
            "_reason",
            F.when(
                F.coalesce("_earlier", "_stored") == F.col("status"),
                fill("Project is already in '{status}' status."),
            ),
        ),
    )
    success = fill("Project {project_id} ('{project_name}') status updated to '{status}'.")
    result = _with_message(judged, success).select(
        "seq", "project_id", "status", "accepted", "message"
    )

    def change(silver: Silver, judged: DataFrame) -> Silver:
        last = (
            judged.filter("accepted")
            .groupBy("project_id")
            .agg(F.max_by("status", "seq").alias("_last"))
        )
        projects = (
            silver.projects.join(last, "project_id", "left")
            .withColumn("status", F.coalesce("_last", "status"))
            .select(*PROJECT_COLUMNS)
        )
        return replace(silver, projects=projects)

    return Outcome(result, silver, change)


# At most 100 assignments of one percent fit one person. So among one person's requests of equal
# size, each for another project, only the first 100 / size can still find room, and at most 100
# more can be passed over because the project was taken meanwhile. All others cannot be accepted.
# In full: the used share never falls while a queue is handled. So a request of one size that finds no
# room is never followed by an accepted one of the same size, and before it at most 100 of that
# size were accepted and at most 100 refused because their project was taken (each by another
# accepted request, of which there are at most 100). A request past the 200th cannot be accepted.
_MOST_ASSIGNMENTS = 100
_MOST_CANDIDATES = 2 * _MOST_ASSIGNMENTS


def _accepted_assignments(possible: DataFrame, used: DataFrame) -> DataFrame:
    """Per employee, the accepted requests in order: array of (seq, project_id, before, after).

    Handling requests in turn needs state, so each employee's queue is folded. The queue is first
    cut to those requests that could be accepted at all (see above): its length has a fixed bound,
    whatever number of requests one employee receives, and nothing that matters is left out.
    """
    # Sorted, not hashed: a task that holds millions of distinct triples needs no table of them.
    earliest = F.row_number().over(
        Window.partitionBy("employee_id", "project_id", "allocation_pct").orderBy(F.col("seq").asc_nulls_last())
    )
    firsts = (
        possible.select("employee_id", "project_id", "allocation_pct", "seq")
        .withColumn("_earliest", earliest)
        .filter("_earliest = 1")
        .drop("_earliest")
    )
    nth = F.row_number().over(
        Window.partitionBy("employee_id", "allocation_pct").orderBy("seq")
    )
    queue = (
        firsts.withColumn("_nth", nth)
        .filter(F.col("_nth") <= _MOST_CANDIDATES)
        .groupBy("employee_id")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("seq", "project_id", "allocation_pct"))
            ).alias("_queue")
        )
        .join(used, "employee_id", "left")
        .withColumn("_used", F.coalesce("_used", F.lit(0).cast("bigint")))
    )
    empty = F.array().cast("array<struct<seq:bigint,project_id:bigint,before:bigint,after:bigint>>")

    def take(taken: Column, request: Column) -> Column:
        before = F.coalesce(F.get(taken, F.size(taken) - 1)["after"], F.col("_used"))
        after = before + request["allocation_pct"]
        free = ~F.exists(taken, lambda t: t["project_id"] == request["project_id"])
        step = F.struct(
            request["seq"].alias("seq"),
            request["project_id"].alias("project_id"),
            before.alias("before"),
            after.alias("after"),
        )
        return F.when((after <= 100) & free, F.concat(taken, F.array(step))).otherwise(taken)

    return queue.select("employee_id", F.aggregate("_queue", empty, take).alias("_taken"))


def assign_employees(requests: DataFrame, silver: Silver, as_of: datetime.date) -> Outcome:
    """Put people on projects; nobody may exceed 100 %, and a rejected request uses no capacity."""
    wanted = requests.select(
        F.col("seq").cast("bigint").alias("seq"),
        F.col("employee_id").cast("bigint").alias("employee_id"),
        F.col("project_id").cast("bigint").alias("project_id"),
        "role_on_project",
        F.col("allocation_pct").cast("int").alias("allocation_pct"),
    )
    assigned = silver.assignments.groupBy("employee_id", "project_id").agg(
        F.sum("allocation_pct").alias("_allocation")
    )
    used = assigned.groupBy("employee_id").agg(F.sum("_allocation").alias("_used"))
    on_project = assigned.select("employee_id", "project_id", F.lit(True).alias("_on_project"))
    checked = _marked(
        _marked(wanted, silver.projects, "project_id", "_project"),
        silver.employees, "employee_id", "_employee",
    )
    checked = checked.join(on_project, ["employee_id", "project_id"], "left").withColumn(
        "_reason",
        first_broken(
            (is_blank(F.col("role_on_project")), ASSIGN_ROLE),
            (unless(F.col("allocation_pct").between(1, 100)), ASSIGN_RANGE),
            (F.coalesce("_on_project", F.lit(False)), ASSIGN_TWICE),
        ),
    )
    possible = checked.filter(F.col("_reason").isNull() & F.col("_project") & F.col("_employee"))
    taken = stored(_accepted_assignments(possible, used), "taken")
    # Whether a request was accepted, or came after an accepted one for the same project, follows
    # from the accepted step of its employee and project.
    steps = taken.select("employee_id", F.inline("_taken")).select(
        "employee_id", "project_id", F.col("seq").alias("_since")
    )
    steps = number_rows(
        steps, "assignment_id", ["_since"],
        start=max_key(silver.assignments, "assignment_id"),
    )
    # What an employee had in use when a request came: the last earlier step (at most 100 exist).
    before = F.aggregate(
        "_taken",
        F.coalesce("_used", F.lit(0).cast("bigint")),
        lambda used_, step: F.when(step["seq"] < F.col("seq"), step["after"]).otherwise(used_),
    )
    judged = (
        checked.join(steps, ["employee_id", "project_id"], "left")
        .join(used.join(taken, "employee_id", "full"), "employee_id", "left")
        .withColumn("_accepted", F.coalesce(F.col("_since") == F.col("seq"), F.lit(False)))
        .withColumn("assignment_id", F.when(F.col("_accepted"), F.col("assignment_id")))
        .withColumn(
            "_before",
            F.coalesce(
                F.when(F.col("_reason").isNull() & ~F.col("_accepted"), before),
                "_used",
                F.lit(0).cast("bigint"),
            ),
        )
        .withColumn(
            "reason",
            first_broken(
                (F.col("_reason").isNotNull(), F.col("_reason")),
                (F.col("_accepted"), F.lit(None).cast("string")),
                (F.coalesce(F.col("_since") < F.col("seq"), F.lit(False)), ASSIGN_TWICE),
                (
                    F.col("_before") + F.col("allocation_pct") > 100,
                    fill(
                        "Employee already has {_before}% allocated. "
                        "Adding {allocation_pct}% goes over 100%."
                    ),
                ),
                (F.lit(True), REFERENCE_MISSING),
            ),
        )
        .select(
            "seq", "employee_id", "project_id", "role_on_project", "allocation_pct",
            "assignment_id", "reason",
        )
    )
    result = _with_message(judged, F.lit(ASSIGNED))

    def change(silver: Silver, requests: DataFrame) -> Silver:
        rows = requests.withColumn("role_on_project", strip(F.col("role_on_project"))).withColumn(
            "assigned_date", F.lit(as_of)
        )
        return _appending("assignments", ASSIGNMENT_COLUMNS)(silver, rows)

    return Outcome(result, silver, change)


def delete_employees(requests: DataFrame, silver: Silver) -> Outcome:
    """Remove people with their assignments and reviews; dated versions in Gold stay."""
    wanted = requests.select("seq", "employee_id")
    marked = _first_per(
        _marked(wanted, silver.employees, "employee_id", "_employee"), "employee_id", "_first"
    )
    judged = marked.withColumn(
        "reason", F.when(~(F.col("_employee") & F.col("_first")), EMPLOYEE_MISSING)
    )
    result = _with_message(judged, F.lit(DELETED)).select(
        "seq", "employee_id", "accepted", "message"
    )

    def change(silver: Silver, judged: DataFrame) -> Silver:
        gone = judged.filter("accepted").select("employee_id")

        def without(table: DataFrame) -> DataFrame:
            return table.join(gone, "employee_id", "left_anti").select(*table.columns)

        return replace(
            silver,
            employees=without(silver.employees),
            assignments=without(silver.assignments),
            reviews=without(silver.reviews),
        )

    return Outcome(result, silver, change)


def _role_of(department: Column, role_by_department: dict[str, str]) -> Column:
    pairs = [F.lit(part) for pair in role_by_department.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), match_key(department))


def _departments_by_email(silver: Silver) -> DataFrame:
    return silver.employees.select(
        match_key(F.col("email")).alias("_email"), "employee_id", "department_id"
    ).join(silver.departments, "department_id").select("_email", "employee_id", "department_name")


def account_roles(
    users: DataFrame, silver: Silver, role_by_department: dict[str, str] | None = None
) -> DataFrame:
    """Role each active account acts under: by the employee's department if the user name is a
    work e-mail, else the stored one. No role means no access."""
    mapping = role_by_department or ROLE_BY_DEPARTMENT
    is_employee = F.col("employee_id").isNotNull()
    return (
        users.filter("is_active")
        .withColumn("_email", match_key(F.col("username")))
        .join(_departments_by_email(silver), "_email", "left")
        .select(
            "username",
            "employee_id",
            "department_name",
            F.when(is_employee, _role_of(F.col("department_name"), mapping))
            .otherwise(F.col("role"))
            .alias("role"),
        )
    )


def account_eligibility(
    requests: DataFrame,
    silver: Silver,
    users: DataFrame,
    role_by_department: dict[str, str] | None = None,
) -> DataFrame:
    """Which work e-mails may open an account, and with which role.

    A column `password_length`, if the requests have one, is judged too; passwords are no data.
    """
    has_length = "password_length" in requests.columns
    length = F.col("password_length") if has_length else F.lit(LEAST_PASSWORD)
    mapping = role_by_department or ROLE_BY_DEPARTMENT
    taken = users.select(F.lower(strip(F.col("username"))).alias("username")).distinct()
    wanted = requests.select(
        "seq", F.lower(strip(F.col("email"))).alias("username"),
        F.coalesce(length, F.lit(0)).alias("_length"),
    )
    # Looked up once per name: a name that most requests give is joined back as a split key.
    names = _marked(wanted.select("username").distinct(), taken, "username", "_taken").join(
        _departments_by_email(silver).withColumnRenamed("_email", "username"), "username", "left"
    )
    checked = (
        wanted.join(own_exchange(names, "username"), "username", "left")
        .withColumn("role", _role_of(F.col("department_name"), mapping))
        .withColumn(
            "reason",
            first_broken(
                (is_blank(F.col("username")) | (F.col("_length") == 0), ACCOUNT_REQUIRED),
                (F.col("_length") < LEAST_PASSWORD, ACCOUNT_PASSWORD),
                (F.col("employee_id").isNull(), ACCOUNT_UNKNOWN),
                (F.col("role").isNull(), ACCOUNT_DEPARTMENT),
                (F.col("_taken"), ACCOUNT_TAKEN),
            ),
        )
    )
    first = (
        checked.filter(F.col("reason").isNull()).groupBy("username").agg(F.min("seq").alias("seq"))
    )
    judged = _marked(checked, first, "seq", "_first").withColumn(
        "reason", F.coalesce("reason", F.when(~F.col("_first"), ACCOUNT_TAKEN))
    )
    return _with_message(judged, F.lit("Account created.")).select(
        "seq", "username",
        F.when(F.col("accepted"), F.col("role")).alias("role"),
        "accepted", "message",
    )


def manual_accounts(requests: DataFrame, users: DataFrame) -> DataFrame:
    """Accounts opened by an administrator: seq, username, password_length, role."""
    taken = users.select(F.lower(strip(F.col("username"))).alias("_key")).distinct()
    named = requests.select(
        "seq", strip(F.col("username")).alias("username"), "password_length", "role",
        F.lower(strip(F.col("username"))).alias("_key"),
    )
    checked = _marked(named, taken, "_key", "_taken").withColumn(
        "reason",
        first_broken(
            (unless(F.col("role").isin(ACCOUNT_ROLES)), ACCOUNT_ROLE),
            (is_blank(F.col("username")) | (F.coalesce("password_length", F.lit(0)) == 0), ACCOUNT_NAME),
            (F.col("_taken"), ACCOUNT_TAKEN),
        ),
    )
    first = checked.filter("reason IS NULL").groupBy("_key").agg(F.min("seq").alias("seq"))
    judged = _marked(checked, first, "seq", "_first").withColumn(
        "reason", F.coalesce("reason", F.when(~F.col("_first"), ACCOUNT_TAKEN))
    )
    return _with_message(judged, F.lit("Account created.")).select(
        "seq", "username", "role", "accepted", "message"
    )
