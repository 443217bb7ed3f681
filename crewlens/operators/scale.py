"""Scale a raw HR table up to a full set of staging tables.

Every random choice is a draw keyed by a row id, so the tables do not depend on partitioning and a
lost task produces the same rows again. Names are placeholders made from the id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crewlens.functions.draws import (
    choose,
    draw_between,
    draw_int,
    draw_normal,
    draw_unit,
    draw_weighted,
    letters,
    pick,
)
from crewlens.operators.numbering import number_rows

# Fixed values of the generated data.
REFERENCE_DATE = "2025-12-31"
REVIEW_SHIFTS = {2023: [0.20, 0.60, 0.20], 2024: [0.15, 0.60, 0.25], 2025: [0.10, 0.55, 0.35]}
CHANGE_KINDS = ["DEPARTMENT_CHANGE", "PROMOTION", "SALARY_HIKE"]
CHANGE_WEIGHTS = [0.35, 0.25, 0.40]
ROLES_ON_PROJECT = ["Developer", "Analyst", "Lead", "Tester", "Coordinator"]
ALLOCATIONS = [50, 75, 100]
ALLOCATION_WEIGHTS = [0.4, 0.3, 0.3]
PROJECT_START_MIN = "2016-01-01"
PROJECT_START_MAX = "2023-06-30"

_ID = "employee_id"
_TODAY = f"DATE'{REFERENCE_DATE}'"
_TENURES = ["years_in_current_role", "years_with_curr_manager", "years_since_last_promotion"]
_MONEY = ["monthly_income", "hourly_rate", "daily_rate", "monthly_rate"]


def _count(df: DataFrame) -> Column:
    return df.agg(F.count("*")).scalar()


def dept_roles(base: DataFrame) -> DataFrame:
    """Sorted distinct roles of every department (duplicates are dropped before the shuffle)."""
    return (
        base.select("department", "job_role")
        .distinct()
        .groupBy("department")
        .agg(F.array_sort(F.collect_set("job_role")).alias("roles"))
    )


def _indexed_departments(base: DataFrame) -> DataFrame:
    return number_rows(dept_roles(base), "dept_index", ["department"])


def upsample_rows(base: DataFrame, target_rows: int, key: str) -> DataFrame:
    """Base rows in `key` order as ids 1..n, then rows drawn from them with replacement up to N.

    Every base row is in the result: a target below their number is an error.
    """
    if base.limit(target_rows + 1).count() > target_rows:
        raise ValueError(f"target_rows is {target_rows}, but there are more base rows.")
    indexed = number_rows(base, "_index", [key]).drop(key)
    ids = base.sparkSession.range(1, target_rows + 1).withColumnRenamed("id", _ID)
    return (
        ids.withColumn("_n", _count(base))
        .selectExpr(
            _ID,
            f"{_ID} > _n AS is_extra",
            f"CASE WHEN {_ID} <= _n THEN {_ID} ELSE {draw_int('pick', _ID)} % _n + 1 END AS _index",
        )
        .join(indexed, "_index")
        .drop("_index")
    )


def jitter_and_cap(rows: DataFrame) -> DataFrame:
    """Vary the drawn rows: age, incomes, and tenures kept consistent with the new age."""

    def vary(df: DataFrame, changes: dict[str, str]) -> DataFrame:
        return df.selectExpr(*[
            f"cast(CASE WHEN is_extra THEN {changes[c]} ELSE {c} END AS int) AS {c}"
            if c in changes else c
            for c in df.columns
        ])

    factors = {
        c: f"round({c} * (0.9D + 0.2D * {draw_unit(c, _ID)}))" for c in _MONEY
    }
    aged = {"age": f"greatest(18, least(60, age + {draw_between('age', _ID, -3, 4)}))"}
    rows = vary(rows, aged | factors)
    if "total_working_years" in rows.columns:
        worked = "least(total_working_years, greatest(age - 18, 0))"
        rows = vary(
            rows,
            {"total_working_years": worked, "years_at_company": f"least(years_at_company, {worked})"},
        )
    return vary(rows, {c: f"least({c}, years_at_company)" for c in _TENURES})


def with_names(rows: DataFrame) -> DataFrame:
    return rows.selectExpr(
        "*",
        f"concat('N', {letters(_ID)}) AS first_name",
        f"concat('S', {letters(draw_int('last', _ID) + ' % 2000')}) AS last_name",
    )


def derive_email_hire(rows: DataFrame) -> DataFrame:
    """E-mail from the name, hire date from the years at the company."""

    def plain(c: str) -> str:
        return f"regexp_replace(lower({c}), '[^a-z]', '')"

    days = f"cast(years_at_company * 365 + {draw_between('hire', _ID, 0, 330)} AS int)"
    return rows.selectExpr(
        "*",
        f"concat({plain('first_name')}, '.', {plain('last_name')}, '.', {_ID}, '@company.com') AS email",
        f"date_sub({_TODAY}, {days}) AS hire_date",
        f"date_sub({_TODAY}, {days}) AS effective_from",
    )


def sample_history(employees: DataFrame, share: float = 0.05) -> DataFrame:
    """Employees of two years' standing who changed once, and when: `share` of all staff.

    The lowest draws are taken. The cut is found from counts per range of draws, so the sample is
    exact although no task ever sorts more than one narrow range.
    """
    eligible = employees.filter("years_at_company >= 2").selectExpr(
        _ID, "hire_date", f"{draw_int('history', _ID)} AS _draw"
    )
    ranked = number_rows(eligible, "_nth", ["_draw", _ID])
    offset = f"180 + {draw_int('change', _ID)} % (datediff({_TODAY}, hire_date) - 240)"
    return ranked.filter(F.col("_nth") <= F.floor(_count(employees) * F.lit(share))).selectExpr(
        _ID, f"date_add(hire_date, cast({offset} AS int)) AS change_date"
    )


def prior_version(employees: DataFrame, sampled: DataFrame, base: DataFrame) -> DataFrame:
    """The version each sampled employee had before the change, as a staged history row."""
    departments = _indexed_departments(base)
    own = departments.selectExpr("department", "dept_index AS _own")
    others = departments.selectExpr("dept_index AS _other", "department AS _department", "roles")
    drawn = draw_weighted("kind", _ID, CHANGE_KINDS, CHANGE_WEIGHTS)
    changed = (
        employees.select(
            _ID, "department", "job_role", "job_level", "monthly_income", "hire_date"
        )
        .join(sampled, _ID)
        .join(own, "department")
        .withColumn("_n", _count(departments))
        .selectExpr(
            "*",
            f"CASE WHEN {drawn} = 'PROMOTION' AND job_level <= 1 THEN 'SALARY_HIKE' ELSE {drawn} END "
            "AS _kind",
            f"{draw_int('department', _ID)} % greatest(_n - 1, 1) + 1 AS _step",
        )
        # The n-th of the other departments.
        .selectExpr("*", "_step + CASE WHEN _step >= _own THEN 1 ELSE 0 END AS _other")
        .join(others, "_other", "left")
    )
    raised = f"round(monthly_income / (1.15D + 0.15D * {draw_unit('raise', _ID)}))"
    hiked = f"round(monthly_income / (1.05D + 0.07D * {draw_unit('raise', _ID)}))"
    rows = changed.selectExpr(
        _ID,
        "CASE _kind WHEN 'DEPARTMENT_CHANGE' THEN _department ELSE department END AS department",
        f"CASE _kind WHEN 'DEPARTMENT_CHANGE' THEN {pick('role', _ID, 'roles')} ELSE job_role END "
        "AS job_role",
        "cast(job_level - CASE _kind WHEN 'PROMOTION' THEN 1 ELSE 0 END AS int) AS job_level",
        "cast(CASE _kind WHEN 'DEPARTMENT_CHANGE' THEN monthly_income "
        f"WHEN 'PROMOTION' THEN {raised} ELSE {hiked} END AS int) AS monthly_income",
        "hire_date AS valid_from",
        "date_sub(change_date, 1) AS valid_to",
        "_kind AS change_reason",
    )
    return number_rows(rows, "history_id", [_ID]).select(
        "history_id", *rows.columns
    )


def with_last_change(employees: DataFrame, sampled: DataFrame) -> DataFrame:
    """The present version of a sampled employee is valid from the change on."""
    return (
        employees.join(sampled, _ID, "left")
        .withColumn("effective_from", F.coalesce("change_date", "effective_from"))
        .drop("change_date")
    )


def make_projects(spark: SparkSession, n_projects: int, base: DataFrame) -> DataFrame:
    """Projects spread over the departments; three in four still run after the reference date."""
    departments = _indexed_departments(base).select("dept_index", "department")
    first, last, key = f"DATE'{PROJECT_START_MIN}'", f"DATE'{PROJECT_START_MAX}'", "project_id"
    start = f"date_add({first}, cast({draw_int('start', key)} % datediff({last}, {first}) AS int))"
    running = f"date_add({_TODAY}, cast({draw_between('end', key, 30, 800)} AS int))"
    done = (
        f"least(date_add(start_date, cast({draw_between('end', key, 365, 1500)} AS int)), "
        f"date_sub({_TODAY}, 1))"
    )
    return (
        spark.range(1, n_projects + 1)
        .withColumnRenamed("id", key)
        .withColumn("_n", _count(departments))
        .selectExpr(
            key,
            f"{draw_int('dept', key)} % _n + 1 AS dept_index",
            f"{start} AS start_date",
            f"{draw_unit('active', key)} < 0.75D AS _active",
        )
        .join(departments, "dept_index")
        .selectExpr(
            key,
            "format_string('PRJ-%04d', project_id) AS project_name",
            "department",
            "start_date",
            f"CASE WHEN _active THEN {running} ELSE {done} END AS planned_end_date",
            "CASE WHEN _active THEN 'Active' ELSE 'Completed' END AS status",
            f"cast({draw_between('budget', key, 50_000, 5_000_000)} AS decimal(15,2)) AS budget",
        )
    )


def make_assignments(employees: DataFrame, projects: DataFrame) -> DataFrame:
    """Every employee on one Active project of the own department.

    Projects are numbered per department and picked by number, so the join spreads evenly even
    where one department holds most of the staff.
    """
    pool = number_rows(
        projects.filter("status = 'Active'").selectExpr(
            "department", "project_id", "start_date AS _start"
        ),
        "_nth", ["project_id"], within=["department"],
    )
    sizes = pool.groupBy("department").agg(F.count("*").alias("_size"))
    return (
        employees.select(_ID, "department", "hire_date")
        .join(sizes, "department", "left")
        .withColumn("_nth", F.expr(f"{draw_int('project', _ID)} % _size + 1"))
        .join(pool, ["department", "_nth"], "left")
        .selectExpr(
            f"{_ID} AS assignment_id",
            _ID,
            "project_id",
            "greatest(hire_date, _start) AS assigned_date",
            f"{choose('work', _ID, ROLES_ON_PROJECT)} AS role_on_project",
            f"{draw_weighted('allocation', _ID, ALLOCATIONS, ALLOCATION_WEIGHTS)} AS allocation_pct",
        )
    )


def make_reviews(employees: DataFrame, assignments: DataFrame) -> DataFrame:
    """A review each 15 December for everyone hired at least 90 days before."""
    key = "concat(employee_id, '|', year)"
    moods = ["job_satisfaction", "work_life_balance", "environment_satisfaction"]
    shifts = " ".join(
        f"WHEN {year} THEN {draw_weighted('shift', key, [-1, 0, 1], weights)}"
        for year, weights in REVIEW_SHIFTS.items()
    )
    first_project = assignments.groupBy(_ID).agg(
        F.min_by("project_id", "assignment_id").alias("project_id")
    )
    years = ", ".join(map(str, REVIEW_SHIFTS))
    in_order = F.expr(f"cast(year AS decimal(24,0)) * 10000000000000000000 + {_ID}")
    yearly = (
        employees.selectExpr(
            _ID, "hire_date", "performance_rating", *moods, f"explode(array({years})) AS year"
        )
        .selectExpr("*", "make_date(year, 12, 15) AS review_date")
        .filter("hire_date <= date_sub(review_date, 90)")
    )
    return (
        number_rows(yearly.withColumn("_order", in_order), "review_id", ["_order"])
        .selectExpr(
            "* EXCEPT (performance_rating, _order)",
            f"greatest(1, least(5, performance_rating + CASE year {shifts} END)) AS performance_rating",
        )
        .join(first_project, _ID, "left")
        .selectExpr(
            "review_id", _ID, "project_id", "review_date", "performance_rating",
            "cast(round(greatest(0.0D, least(100.0D, performance_rating * 20 + "
            f"{draw_normal('score', key, 6.0)})), 1) AS decimal(5,2)) AS review_score",
            *[f"cast(greatest(1, least(4, {c} + {draw_between(c, key, -1, 2)})) AS int) AS {c}"
              for c in moods],
        )
    )


def inject_noise(employees: DataFrame) -> DataFrame:
    """Blemishes: 1 % without education field, 2 % lower-case departments, 1 % rows twice."""
    noisy = employees.withColumns({
        "education_field": F.expr(
            f"CASE WHEN {draw_unit('gap', _ID)} >= 0.01D THEN education_field END"
        ),
        "department": F.expr(
            f"CASE WHEN {draw_unit('case', _ID)} < 0.02D THEN lower(department) ELSE department END"
        ),
    })
    # How often a row is drawn among N // 100 draws with replacement; ids run from 1 to N.
    draws = (
        employees.selectExpr(f"{_ID} - 1 AS _draw")
        .withColumn("_n", _count(employees))
        .filter("_draw < _n div 100")
    )
    times = draws.groupBy(F.expr(f"{draw_int('copy', '_draw')} % _n + 1 AS {_ID}")).agg(
        F.count("*").alias("_times")
    )
    return (
        noisy.join(times, _ID, "left")
        .selectExpr("*", "explode(sequence(0, cast(coalesce(_times, 0) AS int))) AS _copy")
        .drop("_times", "_copy")
    )
