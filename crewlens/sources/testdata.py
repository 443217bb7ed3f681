"""Staging tables and change requests derived from the order-and-parts test tables.

Customers become employees (region = department), parts become projects, order lines become
reviews and the first line of an order an assignment. The rules are those of FIXTURES.md.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession

from crewlens.functions.draws import choose, draw_between, draw_int, letters
from crewlens.model import PROJECT_STATUSES, STAGING, Bronze

# The day on which change requests are handled.
AS_OF = datetime.date(2000, 1, 1)
# Role by department, for a warehouse whose departments are the regions.
ROLE_BY_REGION = {"africa": "Admin", "america": "Viewer", "asia": "Viewer"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _typed(df: DataFrame, staging: str, **columns: str) -> DataFrame:
    """Staging columns in order from SQL text; those not given are NULL."""
    return df.selectExpr(*[
        f"cast({columns.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}"
        for f in STAGING[staging]
    ])


def _named(df: DataFrame, **columns: str) -> DataFrame:
    return df.selectExpr(*[f"{text} AS {name}" for name, text in columns.items()])


def _days(salt: str, key: str, low: int, high: int) -> str:
    return f"cast({draw_between(salt, key, low, high)} AS int)"


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = "c_custkey"
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey"
    ).selectExpr("n_nationkey AS c_nationkey", "n_regionkey", "r_name")
    hired = f"date_add(DATE'1992-01-01', {_days('hire', key, 0, 1825)})"
    changed = f"{draw_int('hist', key)} % 100 < 30"
    return (
        table(spark, sf_dir, "customer")
        .join(places, "c_nationkey")
        .selectExpr(
            "*",
            "c_custkey + 1 AS employee_id",
            f"{hired} AS hire_date",
            f"{changed} AS changed",
            f"CASE WHEN {changed} THEN date_add({hired}, {_days('chg', key, 180, 1080)}) "
            f"ELSE {hired} END AS effective_from",
            f"{draw_between('lvl', key, 1, 6)} AS job_level",
            "floor(abs(c_acctbal)) + 1000 AS monthly_income",
            f"{choose('gen', key, ['Male', 'Female'])} AS gender",
            f"{draw_between('age', key, 18, 71)} AS age",
            f"CASE WHEN {draw_int('attr', key)} % 100 < 16 THEN 'Yes' ELSE 'No' END AS attrition",
        )
    )


def stg_employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = "c_custkey"
    repeated = f"changed AND {draw_int('dup', key)} % 100 < 1"
    rows = _people(spark, sf_dir).selectExpr(
        "*", f"explode(CASE WHEN {repeated} THEN array(0, 1) ELSE array(0) END) AS stale"
    )
    return _typed(
        rows,
        "stg_employee",
        employee_id="employee_id",
        first_name=f"concat(' N', {letters(key)})",
        last_name=f"concat('S', {letters('c_nationkey')}, ' ')",
        email=f"concat('N', {letters(key)}, '.', employee_id, '@Company.com')",
        hire_date="hire_date",
        effective_from="CASE stale WHEN 1 THEN hire_date ELSE effective_from END",
        age="age",
        attrition="attrition",
        department=f"CASE WHEN {draw_int('case', key)} % 100 < 2 THEN lower(r_name) ELSE r_name END",
        gender="gender",
        job_level="job_level",
        job_role="c_mktsegment",
        marital_status=choose("mar", key, ["Single", "Married", "Divorced", None]),
        monthly_income="monthly_income - stale",
    )


def stg_employee_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = "c_custkey"
    region = table(spark, sf_dir, "region").selectExpr("r_regionkey AS past_region", "r_name AS past_name")
    rows = _people(spark, sf_dir).filter("changed").selectExpr(
        "*", f"cast({draw_int('od', key)} % 5 AS int) AS past_region"
    ).join(region, "past_region")
    return _typed(
        rows,
        "stg_employee_history",
        history_id="employee_id",
        employee_id="employee_id",
        department="past_name",
        job_role="concat(' ', c_mktsegment, ' ')",
        job_level="greatest(job_level - 1, 1)",
        monthly_income="monthly_income * 9 div 10",
        valid_from="hire_date",
        valid_to=f"CASE WHEN {draw_int('bad', key)} % 100 < 2 THEN date_sub(hire_date, 1) "
                 "ELSE date_sub(effective_from, 1) END",
        change_reason="' PROMOTION '",
    )


def stg_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = "p_partkey"
    region = table(spark, sf_dir, "region").selectExpr("r_regionkey AS own_region", "r_name")
    rows = table(spark, sf_dir, "part").selectExpr(
        "*",
        "cast(p_partkey % 5 AS int) AS own_region",
        f"date_add(DATE'1994-01-01', {_days('ps', key, 0, 365)}) AS start_date",
    ).join(region, "own_region")
    return _typed(
        rows,
        "stg_project",
        project_id="p_partkey + 1",
        project_name="concat(' ', p_name, ' ', p_partkey)",
        department="r_name",
        start_date="start_date",
        planned_end_date="date_add(start_date, p_size * 30)",
        status=choose("st", key, PROJECT_STATUSES),
        budget="p_retailprice * 1000",
    )


def stg_review(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """One review per order line; of lines with the same number the first by part and supplier.

    `dealt`: lines are dealt out once, by their order; ranking and the join with orders both find them so.
    """
    lines = table(spark, sf_dir, "lineitem")
    lines = (lines.repartition("l_orderkey") if dealt else lines).selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_shipdate",
        "row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, "
        "l_extendedprice, l_shipdate, l_quantity, l_discount) AS place",
    ).filter("place = 1")
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS l_orderkey", "o_custkey")
    rows = lines.join(orders, "l_orderkey").selectExpr(
        "*", "l_orderkey * 10 + l_linenumber AS review_id"
    )

    def mood(salt: str) -> str:
        return f"nullif({draw_int(salt, 'review_id')} % 5, 0)"

    return _typed(
        rows,
        "stg_review",
        review_id="review_id",
        employee_id="o_custkey + 1",
        project_id="l_partkey + 1",
        review_date="l_shipdate",
        performance_rating="cast(round(l_discount * 100) AS int) % 4 + 1",
        review_score="l_quantity * 2",
        job_satisfaction=mood("js"),
        work_life_balance=mood("wl"),
        environment_satisfaction=mood("es"),
    )


def stg_assignment(reviews: DataFrame) -> DataFrame:
    """The first line of an order puts the employee on the project."""
    first = reviews.filter("review_id % 10 = 1").selectExpr(
        "employee_id", "project_id", "review_id", "review_date"
    )
    pairs = first.groupBy("employee_id", "project_id").agg(
        {"review_id": "min", "review_date": "min"}
    )
    return _typed(
        pairs.withColumnsRenamed(
            {"min(review_id)": "assignment_id", "min(review_date)": "assigned_date"}
        ),
        "stg_assignment",
        assignment_id="assignment_id",
        employee_id="employee_id",
        project_id="project_id",
        assigned_date="assigned_date",
        role_on_project="'Developer '",
        allocation_pct=f"10 + 10 * ({draw_int('al', 'assignment_id')} % 3)",
    )


def bronze(spark: SparkSession, sf_dir: str, reviews: DataFrame | None = None) -> Bronze:
    """The staging tables; with `reviews` (those of `stg_review`, stored), made from them."""
    if reviews is None:
        reviews = stg_review(spark, sf_dir)
    return Bronze(
        employee=stg_employee(spark, sf_dir),
        employee_history=stg_employee_history(spark, sf_dir),
        project=stg_project(spark, sf_dir),
        assignment=stg_assignment(reviews),
        review=reviews,
    )


def raw_hr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw HR table (PascalCase columns, constant columns included): one row per customer."""
    key = "c_custkey"

    def number(salt: str, low: int, high: int) -> str:
        return f"cast({draw_between(salt, key, low, high)} AS int)"

    return _named(
        _people(spark, sf_dir),
        Age="cast(age AS int)",
        Attrition="attrition",
        DailyRate=number("dr", 100, 1500),
        Department="r_name",
        EducationField=choose("ef", key, ["Life Sciences", "Medical", "Marketing", "Other"]),
        EmployeeCount="1",
        EmployeeNumber="cast(employee_id AS int)",
        EnvironmentSatisfaction=number("es", 1, 5),
        Gender="gender",
        HourlyRate=number("hr", 30, 101),
        JobLevel="cast(job_level AS int)",
        JobRole="c_mktsegment",
        JobSatisfaction=number("js", 1, 5),
        MonthlyIncome="cast(monthly_income AS int)",
        MonthlyRate=number("mr", 2000, 27000),
        Over18="'Y'",
        PerformanceRating=number("pr", 3, 5),
        StandardHours="80",
        TotalWorkingYears=number("tw", 0, 41),
        WorkLifeBalance=number("wl", 1, 5),
        YearsAtCompany=number("yc", 0, 21),
        YearsInCurrentRole=number("yr", 0, 15),
        YearsSinceLastPromotion=number("yp", 0, 12),
        YearsWithCurrManager=number("ym", 0, 15),
    )


def changed_snapshot(employees: DataFrame) -> DataFrame:
    """A second Silver employee snapshot: every kind of change a later load can bring."""
    changed = {
        "job_role": "CASE WHEN roll < 10 THEN 'ANALYST' ELSE job_role END",
        "monthly_income": "CASE WHEN roll BETWEEN 10 AND 14 THEN monthly_income + 500 "
                          "ELSE monthly_income END",
        "email": "CASE WHEN roll BETWEEN 15 AND 19 THEN concat('new.', email) ELSE email END",
        "department_id": "CASE WHEN roll BETWEEN 25 AND 29 THEN department_id % 5 + 1 "
                         "ELSE department_id END",
        "effective_from": "CASE WHEN roll < 10 THEN date_add(effective_from, 200) "
                          "WHEN roll BETWEEN 20 AND 24 THEN date_sub(effective_from, 30) "
                          "WHEN roll BETWEEN 25 AND 29 THEN date_add(effective_from, 100) "
                          "ELSE effective_from END",
    }
    rolled = employees.selectExpr("*", f"{draw_int('snap', 'employee_id')} % 100 AS roll")
    return _named(rolled.filter("roll < 97"), **{c: changed.get(c, c) for c in employees.columns})


# -- change requests ---------------------------------------------------------------------------


def new_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applications, one per customer: some broken, some under an e-mail already in use."""
    key = "c_custkey"
    people = _people(spark, sf_dir).selectExpr("*", f"{draw_int('flaw', key)} % 20 AS flaw")
    return _named(
        people,
        seq="employee_id",
        first_name=f"CASE flaw WHEN 0 THEN ' ' WHEN 1 THEN 'R2' ELSE concat(' N', {letters(key)}) END",
        last_name=f"CASE flaw WHEN 2 THEN '9' ELSE concat('O\\'S', {letters('c_nationkey')}) END",
        email="CASE flaw WHEN 3 THEN 'invalid' "
              f"WHEN 4 THEN concat('team.', {letters('c_nationkey')}, '@company.com') "
              f"WHEN 5 THEN concat('N', {letters(key)}, '.', employee_id, '@Company.com') "
              f"ELSE concat(' New.', {letters(key)}, '@Company.com ') END",
        department_id=f"{draw_int('dep', key)} % 5 + CASE flaw WHEN 6 THEN 6 ELSE 1 END",
        job_role="CASE flaw WHEN 7 THEN '' WHEN 8 THEN 'Dev 2' ELSE 'Research & Sales-Lead' END",
        job_level="cast(job_level + CASE flaw WHEN 9 THEN 5 ELSE 0 END AS int)",
        hire_date=f"date_add(hire_date, {_days('join', key, 0, 2000)})",
        age="cast(age + CASE flaw WHEN 10 THEN 60 ELSE 0 END AS int)",
        monthly_income="cast(monthly_income * CASE flaw WHEN 11 THEN 0 ELSE 1 END AS int)",
        gender="gender",
        marital_status="cast(NULL AS string)",
        attrition="'No'",
    )


def new_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = "p_partkey"
    parts = table(spark, sf_dir, "part").selectExpr(
        "*",
        f"{draw_int('flaw', key)} % 20 AS flaw",
        f"date_add(DATE'2000-01-01', {_days('ps', key, 0, 365)}) AS start_date",
    )
    return _named(
        parts,
        seq="p_partkey + 1",
        project_name="CASE flaw WHEN 0 THEN ' ' WHEN 1 THEN '0000' WHEN 2 THEN '* new' "
                     "ELSE concat(' ', p_name, ' (phase 2) ') END",
        department_id=f"{draw_int('dep', key)} % 5 + CASE flaw WHEN 3 THEN 6 ELSE 1 END",
        start_date="start_date",
        planned_end_date="date_add(start_date, CASE flaw WHEN 4 THEN 0 ELSE p_size * 7 END)",
        status="'Planned'",
        budget="cast(p_retailprice * CASE flaw WHEN 5 THEN -1 ELSE 100 END AS decimal(15,2))",
    )


def new_reviews(reviews: DataFrame) -> DataFrame:
    """Every review handed in once more, some of them broken."""
    key = "review_id"
    return _named(
        reviews.selectExpr("*", f"{draw_int('flaw', key)} % 20 AS flaw"),
        seq=key,
        employee_id="employee_id * CASE flaw WHEN 0 THEN -1 ELSE 1 END",
        project_id="project_id * CASE flaw WHEN 1 THEN -1 ELSE 1 END",
        review_date=f"date_add(review_date, {_days('late', key, 0, 400)})",
        performance_rating="performance_rating + CASE flaw WHEN 2 THEN 4 ELSE 0 END",
        review_score="cast(review_score + CASE flaw WHEN 3 THEN 100 ELSE 0 END AS decimal(5,2))",
        job_satisfaction="job_satisfaction + CASE flaw WHEN 4 THEN 4 ELSE 0 END",
        work_life_balance="work_life_balance",
        environment_satisfaction="environment_satisfaction",
    )


def employee_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change wished for with every order: back to the customer's own values, or to drawn ones."""
    key = "o_orderkey"
    people = _people(spark, sf_dir).selectExpr(
        "c_custkey AS o_custkey", "c_mktsegment", "attrition", "n_regionkey", "job_level",
        "monthly_income",
    )
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey", f"{draw_int('same', key)} % 4 = 0 AS same",
        f"{draw_int('flaw', key)} % 20 AS flaw",
    )
    return _named(
        orders.join(people, "o_custkey"),
        seq="o_orderkey + 1",
        employee_id="o_custkey + CASE flaw WHEN 0 THEN 100000000 ELSE 1 END",
        department_id=f"CASE WHEN same THEN n_regionkey + 1 ELSE {draw_between('dep', key, 1, 7)} END",
        job_role="concat(' ', c_mktsegment, ' ')",
        job_level=f"cast(CASE WHEN same THEN job_level ELSE {draw_between('lvl', key, 1, 7)} END AS int)",
        monthly_income="cast(CASE WHEN same THEN monthly_income "
                       f"ELSE {draw_between('inc', key, 0, 9000)} END AS int)",
        attrition="CASE flaw WHEN 1 THEN 'Maybe' ELSE attrition END",
    )


def status_changes(reviews: DataFrame) -> DataFrame:
    """A project status reported with every review."""
    key = "review_id"
    return _named(
        reviews,
        seq=key,
        project_id=f"project_id + CASE WHEN {draw_int('gone', key)} % 50 = 0 THEN 100000000 ELSE 0 END",
        status=choose("status", key, [*PROJECT_STATUSES, " Active ", "Cancelled"]),
    )


def assignment_requests(reviews: DataFrame) -> DataFrame:
    """Everyone asks to join the projects they were reviewed on."""
    key = "review_id"
    return _named(
        reviews.selectExpr("*", f"{draw_int('flaw', key)} % 40 AS flaw"),
        seq=key,
        employee_id="employee_id * CASE flaw WHEN 0 THEN -1 ELSE 1 END",
        project_id="project_id * CASE flaw WHEN 1 THEN -1 ELSE 1 END",
        role_on_project="CASE flaw WHEN 2 THEN '  ' ELSE ' Tester ' END",
        allocation_pct=f"cast({draw_between('share', key, 0, 30)} AS int)",
    )


def departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in debt leave; those with full accounts are asked for under unknown ids."""
    return _named(
        table(spark, sf_dir, "customer").filter("c_acctbal < 0 OR c_acctbal > 9900"),
        seq="c_custkey + 1",
        employee_id="c_custkey + CASE WHEN c_acctbal > 9900 THEN 100000000 ELSE 1 END",
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An account per customer: under the work e-mail, or a free user name with a stored role."""
    key = "c_custkey"
    return _named(
        table(spark, sf_dir, "customer"),
        username=f"CASE WHEN {draw_int('user', key)} % 4 = 0 THEN concat('user-', {letters(key)}) "
                 f"ELSE concat('n', {letters(key)}, '.', c_custkey + 1, '@COMPANY.com') END",
        role=choose("role", key, ["Admin", "Viewer"]),
        is_active=f"{draw_int('active', key)} % 10 <> 0",
    )


def existing_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts that exist before the sign-ups: those kept active."""
    return users(spark, sf_dir).filter("is_active")


def account_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-ups with every order, under the work e-mail, an unknown one or none."""
    return _named(
        table(spark, sf_dir, "orders"),
        seq="o_orderkey + 1",
        email=f"CASE {draw_int('flaw', 'o_orderkey')} % 20 WHEN 0 THEN ' ' "
              "WHEN 1 THEN 'stranger@company.com' "
              f"ELSE concat(' N', {letters('o_custkey')}, '.', o_custkey + 1, '@company.com ') END",
    )
