import pytest
from pyspark.sql import functions as F

from conftest import day, rows
from crewlens.model import STG_ASSIGNMENT, STG_EMPLOYEE, STG_PROJECT
from crewlens.operators import silver
from crewlens.operators import numbering
from crewlens.operators.numbering import number_rows, previous_value
from crewlens.session import stored


def staged(spark, *people):
    names = STG_EMPLOYEE.names
    return spark.createDataFrame(
        [tuple(p.get(n) for n in names) for p in people], STG_EMPLOYEE
    )


def person(i, department="Sales", hire="2020-01-01", since=None, **more):
    return {
        "employee_id": i, "first_name": f" P{i} ", "last_name": "Q ", "email": f" P{i}@X.com ",
        "department": department, "job_role": " Rep ", "job_level": 1, "age": 30,
        "hire_date": day(hire), "effective_from": day(since), "monthly_income": 100, **more,
    }


def test_departments_are_sentence_cased_and_numbered_by_name(spark):
    df = staged(
        spark, person(1, " RESEARCH & development"), person(2, "sales "), person(3, "SALES"),
        person(4, None), person(5, "  "),
    )
    assert rows(silver.clean_departments(df)) == [(1, "Research & development"), (2, "Sales")]


def test_known_departments_keep_their_ids(spark):
    known = spark.createDataFrame([(7, "Sales")], "department_id bigint, department_name string")
    df = staged(spark, person(1, "sales"), person(2, "Admin"), person(3, "Legal"))
    assert rows(silver.clean_departments(df, known)) == [(7, "Sales"), (8, "Admin"), (9, "Legal")]


def test_latest_row_wins_and_is_cleaned(spark):
    df = staged(
        spark,
        person(1, monthly_income=1, since="2021-01-01"),
        person(1, monthly_income=2, since="2022-01-01", marital_status="Married"),
        person(1, monthly_income=3, hire="2021-06-01"),
        person(None), person(2, department=" "),
    )
    out = silver.latest_employee(df).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.first_name, r.last_name, r.email, r.job_role) == ("P1", "Q", "p1@x.com", "Rep")
    assert (r.monthly_income, r.marital_status) == (2, "Married")


def test_copies_are_reduced_before_the_shuffle(spark):
    df = staged(spark, *[person(1) for _ in range(50)], person(2))
    latest = silver.latest_employee(df)
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert latest.count() == 2


def test_projects_and_assignments_need_known_references(spark):
    people = staged(spark, person(1), person(2, "Legal"))
    departments = stored(silver.clean_departments(people), "departments")
    lookup = silver.department_lookup(departments)
    employees = silver.clean_employees(people, lookup)
    project = (1, " One ", "SALES", day("2020-01-01"), day("2021-01-01"), "Active", None)
    projects = silver.clean_projects(
        spark.createDataFrame(
            [project, project, (2, "Two", "Nowhere", None, None, "Active", None)], STG_PROJECT
        ),
        lookup,
    )
    assert rows(projects, "project_id", "project_name") == [(1, "One")]
    assigned = spark.createDataFrame(
        [(1, 1, 1, None, " Dev ", 10), (1, 1, 1, None, "Dev", 10), (2, 9, 1, None, "Dev", 10),
         (3, 2, 2, None, "Dev", 10)],
        STG_ASSIGNMENT,
    )
    out = silver.fk_filtered_assignments(assigned, employees, projects)
    assert rows(out, "assignment_id", "role_on_project") == [(1, "Dev")]


@pytest.fixture
def many_ranges(spark):
    """Small ranges are otherwise put together at run time."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_numbers_run_through_ranges_and_groups(spark, many_ranges):
    df = spark.range(0, 5_000_000, 500_000).withColumn("g", F.col("id") % 1_000_000)
    out = number_rows(df, "n", ["id"], start=100)
    assert rows(out, "id", "n") == sorted(
        ((i * 500_000, 101 + i) for i in range(10)), key=repr
    )
    grouped = number_rows(df, "n", ["id"], within=["g"])
    assert sorted(r.n for r in grouped.collect()) == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    turned = number_rows(df, "n", [F.col("id").desc()], within=["g"])
    assert [r.n for r in turned.filter("g = 0").orderBy("id").collect()] == [5, 4, 3, 2, 1]


def test_previous_value_crosses_ranges(spark, many_ranges):
    data = [(1, 1, "a"), (1, 5, "b"), (1, 2_000_000, "c"), (1, 9_000_000, "d"), (2, 3, "x")]
    df = spark.createDataFrame(data, "k bigint, seq bigint, v string")
    out = previous_value(df, "p", "k", "seq", "v")
    assert rows(out, "v", "p") == [("a", None), ("b", "a"), ("c", "b"), ("d", "c"), ("x", None)]


def test_previous_value_of_a_key_in_many_ranges(spark, many_ranges):
    """Also through ranges that hold no value at all."""
    data = [(0, s, f"v{s}" if s < 100 or s > 900 else None) for s in range(1000)] + [(k, 1, "y") for k in range(1, 40)]
    df = spark.createDataFrame(data, "k bigint, seq bigint, v string")
    found = {r.seq: r.p for r in previous_value(df, "p", "k", "seq", "v").filter("k = 0").collect()}
    assert found[0] is None and found[50] == "v49" and found[902] == "v901"
    assert {found[s] for s in range(101, 902)} == {"v99"} and len(found) == 1000


def test_ranges_hold_even_shares_however_rows_are_spaced(spark, many_ranges):
    spaced = (range(0, 5_000_000_000 * 3000, 5_000_000_000), range(3000), [7, *range(10**15, 10**15 + 2999)])
    for ids in spaced:
        df = spark.createDataFrame([(i,) for i in ids], "id bigint")
        counts = [r["count"] for r in numbering.in_ranges(df, ["id"]).groupBy("_range").count().collect()]
        assert len(counts) > 1 and max(counts) < 2 * 3000 / len(counts)
        assert [r.n for r in number_rows(df, "n", ["id"]).orderBy("id").collect()] == list(range(1, 3001))
    # Rows that agree in the first column are told apart by the next one.
    tied = spark.range(3000).withColumn("first", F.lit(1))
    counts = [r["count"] for r in numbering.in_ranges(tied, ["first", "id"]).groupBy("_range").count().collect()]
    assert len(counts) > 1 and max(counts) < 2 * 3000 / len(counts)
    assert [r.n for r in number_rows(tied, "n", ["first", "id"]).orderBy("id").collect()] == list(range(1, 3001))


def test_vanished_departments_go_and_keep_their_id(spark):
    first = silver.clean_departments(staged(spark, person(1, "Sales"), person(2, "Ops")))
    assert rows(first, "department_name", "department_id") == [("Ops", 1), ("Sales", 2)]
    later = silver.clean_departments(staged(spark, person(1, "SALES"), person(2, "Law")), first)
    assert rows(later, "department_name", "department_id") == [("Law", 3), ("Sales", 2)]


def test_spellings_of_one_project_are_one_row(spark):
    people = staged(spark, person(1))
    lookup = silver.department_lookup(stored(silver.clean_departments(people), "departments"))
    project = (1, "Alpha", "SALES", day("2020-01-01"), day("2021-01-01"), "Active", None)
    df = spark.createDataFrame([project, (1, "ALPHA ", *project[2:])], STG_PROJECT)
    assert rows(silver.clean_projects(df, lookup), "project_id", "project_name") == [(1, "ALPHA")]
