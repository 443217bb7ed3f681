import pytest
from pyspark.sql import functions as F

from conftest import day, rows
from crewlens.model import STG_EMPLOYEE_HISTORY, STG_REVIEW
from crewlens.operators import dims, scd2
from crewlens.operators.fact import fact_point_in_time

EMPLOYEE = (
    "employee_id bigint, first_name string, last_name string, email string, department_id bigint, "
    "job_role string, job_level int, hire_date date, effective_from date, age int, gender string, "
    "marital_status string, monthly_income int, attrition string"
)


@pytest.fixture(scope="module")
def departments(spark):
    return spark.createDataFrame(
        [(1, "Sales"), (2, "Legal")], "department_id bigint, department_name string"
    )


@pytest.fixture(scope="module")
def dim_department(spark, departments):
    return departments.withColumn("department_key", F.col("department_id"))


def employees(spark, *people):
    base = {
        "first_name": "A", "last_name": "B", "email": "a@x.com", "department_id": 1,
        "job_role": "Rep", "job_level": 1, "hire_date": day("2020-01-01"), "effective_from": None,
        "age": 30, "gender": None, "marital_status": "Single", "monthly_income": 100,
        "attrition": "No",
    }
    names = [c.split()[0] for c in EMPLOYEE.split(", ")]
    return spark.createDataFrame(
        [tuple((base | p).get(n) for n in names) for p in people], EMPLOYEE
    )


def history(spark, *versions):
    return spark.createDataFrame(
        [(i, e, d, " Rep ", 1, 90, day(a), day(b), " PROMOTION ")
         for i, e, d, a, b in versions],
        STG_EMPLOYEE_HISTORY,
    )


def load(spark, departments, dim_department, dim, people, past=()):
    """Versions after a load, kept as a small local table."""
    df = scd2.scd2_apply(
        dim, employees(spark, *people), history(spark, *past), departments, dim_department
    )
    return spark.createDataFrame(df.collect(), df.schema)


INTERVAL = ("employee_id", "start_date", "end_date", "is_current")
OPEN = day("9999-12-31")


def test_first_load_joins_present_and_past(spark, departments, dim_department):
    dim = load(
        spark, departments, dim_department, None,
        [{"employee_id": 1, "effective_from": day("2021-01-01")}, {"employee_id": 2}],
        [(1, 1, " LEGAL", "2020-01-01", "2020-12-31"), (2, 1, "Legal", "2020-06-01", "2020-05-31"),
         (3, 1, "Nowhere", "2019-01-01", "2019-12-31"), (4, 9, "Legal", "2019-01-01", "2019-12-31")],
    )
    assert rows(dim, *INTERVAL) == [
        (1, day("2020-01-01"), day("2020-12-31"), False),
        (1, day("2021-01-01"), OPEN, True),
        (2, day("2020-01-01"), OPEN, True),
    ]
    past = dim.filter("NOT is_current").first()
    assert (past.department_key, past.job_role, past.change_reason) == (2, "Rep", "PROMOTION")
    assert past.first_name == "A"
    assert dim.select("employee_key").distinct().count() == 3


@pytest.mark.parametrize(
    "change",
    [{"department_id": 2}, {"job_role": "Lead"}, {"job_level": 2}, {"monthly_income": 101}],
)
def test_second_load_closes_and_opens(spark, departments, dim_department, change):
    before = [{"employee_id": 1}]
    dim = load(spark, departments, dim_department, None, before)
    after = [{"employee_id": 1, "effective_from": day("2022-03-01"), **change}]
    again = load(spark, departments, dim_department, dim, after)
    assert rows(again, *INTERVAL) == [
        (1, day("2020-01-01"), day("2022-02-28"), False), (1, day("2022-03-01"), OPEN, True),
    ]
    # A later load has larger keys, and a repeated load changes nothing.
    keys = [r.employee_key for r in again.orderBy("start_date").collect()]
    assert keys[0] < keys[1]
    assert rows(load(spark, departments, dim_department, again, after)) == rows(again)


def test_start_date_alone_opens_a_version(spark, departments, dim_department):
    dim = load(spark, departments, dim_department, None, [{"employee_id": 1}])
    out = load(
        spark, departments, dim_department, dim,
        [{"employee_id": 1, "effective_from": day("2021-01-01")}],
    )
    assert out.count() == 2


def test_change_on_the_same_start_date_leaves_an_empty_interval(spark, departments, dim_department):
    dim = load(spark, departments, dim_department, None, [{"employee_id": 1}])
    out = load(spark, departments, dim_department, dim, [{"employee_id": 1, "job_level": 2}])
    assert rows(out, *INTERVAL) == [
        (1, day("2020-01-01"), day("2019-12-31"), False), (1, day("2020-01-01"), OPEN, True),
    ]


def test_person_details_and_role_case_do_not_open_versions(spark, departments, dim_department):
    dim = load(spark, departments, dim_department, None, [{"employee_id": 1}])
    out = load(
        spark, departments, dim_department, dim,
        [{"employee_id": 1, "email": "new@x.com", "age": 31, "attrition": "Yes", "job_role": "REP"}],
    )
    assert rows(out) == rows(dim)


def test_reload_of_an_older_row_reopens_it_and_the_newer_load_wins(
    spark, departments, dim_department
):
    old, new = [{"employee_id": 1}], [{"employee_id": 1, "effective_from": day("2022-01-01"),
                                       "job_level": 2}]
    dim = load(spark, departments, dim_department, None, old)
    dim = load(spark, departments, dim_department, dim, new)
    dim = load(spark, departments, dim_department, dim, old)
    assert rows(dim, *INTERVAL) == [
        (1, day("2020-01-01"), day("2021-12-31"), False),
        (1, day("2020-01-01"), OPEN, True),
        (1, day("2022-01-01"), day("2019-12-31"), False),
    ]
    reviews = review_rows(spark, (1, 1, "2021-06-01"))
    linked = fact_point_in_time(reviews, dim, dim_projects(spark)).first()
    current = dim.filter("is_current").first()
    assert linked.employee_key == current.employee_key


def test_deleted_employees_stay_current(spark, departments, dim_department):
    dim = load(spark, departments, dim_department, None, [{"employee_id": 1}, {"employee_id": 2}])
    out = load(spark, departments, dim_department, dim, [{"employee_id": 2}])
    assert rows(out) == rows(dim)


def dim_projects(spark):
    return spark.createDataFrame([(1, 1)], "project_id bigint, project_key bigint")


def review_rows(spark, *reviews):
    return spark.createDataFrame(
        [(i, e, 1, day(d), 3, None, 1, 2, 3) for i, e, d in reviews], STG_REVIEW
    )


def test_each_review_meets_exactly_one_version(spark, departments, dim_department):
    dim = load(
        spark, departments, dim_department, None,
        [{"employee_id": 1, "effective_from": day("2021-01-01")}],
        # Overlapping and nested versions, and a copy of one.
        [(1, 1, "Legal", "2019-01-01", "2020-12-31"), (2, 1, "Legal", "2019-03-01", "2019-04-30"),
         (3, 1, "Legal", "2019-03-01", "2019-04-30"), (4, 1, "Legal", "2020-06-01", "2022-12-31")],
    )
    reviews = review_rows(
        spark, (1, 1, "2018-12-31"), (2, 1, "2019-02-01"), (3, 1, "2019-04-30"),
        (4, 1, "2019-05-01"), (5, 1, "2020-12-31"), (6, 1, "2021-01-01"), (7, 1, "2030-01-01"),
        (8, 2, "2020-01-01"),
    )
    fact = fact_point_in_time(reviews, dim, dim_projects(spark))
    starts = dim.select("employee_key", "start_date")
    linked = rows(fact.join(starts, "employee_key"), "review_id", "start_date")
    assert linked == [
        (2, day("2019-01-01")), (3, day("2019-03-01")), (4, day("2019-01-01")),
        (5, day("2020-06-01")), (6, day("2021-01-01")), (7, day("2021-01-01")),
    ]
    assert fact.count() == 6


def test_calendar(spark):
    reviews = review_rows(
        spark, (1, 1, "2024-12-30"), (2, 1, "2021-01-03"), (3, 1, "2024-02-29"), (4, 1, "2024-02-29")
    )
    out = {r.full_date.isoformat(): r for r in dims.dim_date(reviews).collect()}
    assert len(out) == 3
    assert (out["2024-12-30"].week_number, out["2021-01-03"].week_number) == (1, 53)
    leap = out["2024-02-29"]
    assert (leap.date_key, leap.month_name, leap.day_name, leap.quarter_number) == (
        20240229, "February", "Thursday", 1,
    )
    more = dims.dim_date(review_rows(spark, (5, 1, "2025-01-01")), dims.dim_date(reviews))
    assert more.count() == 4


def test_upsert_updates_inserts_and_never_deletes(spark):
    schema = "department_id bigint, department_name string"
    known = dims.dim_department_upsert(
        None, spark.createDataFrame([(3, "C"), (5, "E")], schema)
    )
    out = dims.dim_department_upsert(
        known, spark.createDataFrame([(1, "A"), (5, "E2"), (9, "I")], schema)
    )
    assert rows(out) == [(1, 3, "C"), (2, 5, "E2"), (3, 1, "A"), (4, 9, "I")]


def test_skewed_employee_is_split_and_result_is_whole(spark, departments, dim_department):
    """One employee holds most reviews: the join splits the hot partition, no review is lost."""
    dim = load(
        spark, departments, dim_department, None, [{"employee_id": i} for i in range(1, 41)]
    )
    reviews = spark.range(200_000).selectExpr(
        "id AS review_id",
        "CASE WHEN id % 3 = 0 THEN id % 40 + 1 ELSE 7 END AS employee_id",
        "1L AS project_id", "DATE'2021-01-01' AS review_date", "3 AS performance_rating",
        "cast(50 AS decimal(5,2)) AS review_score", "1 AS job_satisfaction",
        "2 AS work_life_balance", "3 AS environment_satisfaction",
    )
    old = {}
    for key, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }.items():
        old[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)
    try:
        spread = reviews.repartition(8, "review_id")
        fact = fact_point_in_time(spread, dim, dim_projects(spark))
        assert fact.selectExpr("count(*)", "count(DISTINCT review_id)").first()[:] == (
            200_000, 200_000,
        )
        fact.collect()
        assert "skew=true" in fact._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
