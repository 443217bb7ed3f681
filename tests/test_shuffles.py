"""Whole rows are shuffled no more often than needed, and results stay those of the plain forms."""

import glob
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import rows
from crewlens.model import Silver
from crewlens.operators import changes, quality
from crewlens.operators.lookups import without_lost
from crewlens.session import CODEC, stored
from crewlens.sources import testdata
from crewlens.sources.store import LayerStore, bucket_of


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def orders(spark, tmp_path):
    """Three orders; of one, a line stands twice under its number."""
    lines = [(o, n, 10 * o + n, 5, 100.0, date(1995, 1, n), 2.0, 0.03) for o in (1, 2, 3) for n in (1, 2)]
    lines += [(1, 1, 7, 5, 100.0, date(1995, 2, 1), 4.0, 0.05)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, "
                          "l_extendedprice double, l_shipdate date, l_quantity double, l_discount double"
                          ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 4), (2, 4), (3, 6)], "o_orderkey bigint, o_custkey bigint"
                          ).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_order_lines_are_dealt_once(spark, orders, no_broadcast):
    reviews = testdata.stg_review(spark, orders, dealt=True)
    assert plan(reviews).count("Exchange hashpartitioning") == 2  # lines, orders
    assert rows(reviews, "review_id", "employee_id", "project_id") == rows(
        testdata.stg_review(spark, orders), "review_id", "employee_id", "project_id") == [
        (11, 5, 8), (12, 5, 13), (21, 5, 22), (22, 5, 23), (31, 7, 32), (32, 7, 33)]


def test_assignments_are_made_from_stored_reviews(spark, orders):
    plain = testdata.stg_assignment(testdata.stg_review(spark, orders))
    reviews = stored(testdata.stg_review(spark, orders), "reviews")
    again = testdata.stg_assignment(reviews)
    for name in ("customer", "nation", "region", "part"):  # only the names are asked for here
        columns = {"customer": "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
                   "nation": "n_nationkey int, n_regionkey int", "region": "r_regionkey int, r_name string",
                   "part": "p_partkey bigint, p_name string, p_size int, p_retailprice double"}
        spark.createDataFrame([], columns[name]).write.parquet(f"{orders}/{name}.parquet")
    bronze = testdata.bronze(spark, orders, reviews)
    assert "lineitem" not in "".join(bronze.assignment.inputFiles())
    assert rows(bronze.assignment) == rows(again) == rows(plain)


@pytest.mark.parametrize("known", [[1, 2, 3], [2], []])
def test_rows_without_their_reference_drop_out(spark, known):
    table = stored(spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, None), (None, "c")], "id bigint, t string"), "t")
    keys = stored(spark.createDataFrame([(k,) for k in known], "id bigint"), "keys")
    found = without_lost(table, keys, "id")
    assert found.exceptAll(table.join(keys, "id", "left_semi")).count() == 0
    assert found.count() == sum(i in known for i in (1, 1, 2, 3))


def test_whole_rows_meet_only_the_lost_ids(spark):
    table = stored(spark.range(1000).selectExpr("id", "id % 7 AS other"), "t")
    keys = stored(spark.range(2000), "keys")
    assert "Exchange hashpartitioning" not in plan(without_lost(table, keys, "id").select("id", "other"))


def test_dealt_rows_are_not_shuffled_for_their_buckets(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path), buckets=4)
    # Nine in ten rows are of one person.
    table = spark.range(500).select(F.when(F.col("id") % 10 > 0, 7).otherwise(F.col("id")).alias("employee_id"), "id")
    with store.load("silver") as load:
        kept = load.put_buckets("t", table.repartition(3, "id"), "employee_id", dealt=True)
    assert rows(kept, "id", "employee_id") == rows(table, "id", "employee_id")
    own = spark.range(1).select(F.lit(7).cast("bigint").alias("e")).select(bucket_of("e", 4))
    hot = own.first()[0]
    files = glob.glob(f"{tmp_path}/silver/t/*/bucket={hot}/*.parquet")
    assert len(files) == 3 and all(".zstd." in f for f in files)  # by the tasks that had the rows
    assert store.read("silver", "t", [hot]).filter("employee_id = 7").count() == 450


def test_rules_are_one_pass_without_a_join(spark):
    """Repeated keys (text case aside), nulls, references to nothing and to null, and hot keys."""
    def table(columns, *data):
        return spark.createDataFrame(list(data), columns)

    person = ("employee_id bigint, first_name string, last_name string, email string, department_id bigint, "
              "job_role string, job_level int, hire_date date, effective_from date, age int, monthly_income int")

    def employee(i, email, department):
        return i, "A", "B", email, department, "Rep", 1, date(2020, 1, 1), None, 30, 1

    day = date(2020, 1, 1)
    silver = Silver(
        departments=table("department_id bigint, department_name string", (1, "Sales"), (2, "SALES"), (2, None)),
        employees=table(person, employee(1, "a@x", 1), employee(1, "A@X", 9), employee(2, None, None)),
        projects=table("project_id bigint, project_name string, department_id bigint, start_date date, "
                       "planned_end_date date, status string, budget int", (1, "P", 1, day, day, "Active", 1)),
        assignments=table("assignment_id bigint, employee_id bigint, project_id bigint, assigned_date date, "
                          "role_on_project string, allocation_pct int", (1, 3, 1, day, "Dev", 1), (1, 3, 5, day, "Dev", 1)),
        reviews=table("review_id int, employee_id bigint, project_id bigint, review_date date, "
                      "performance_rating int, review_score int", *[(k, 1, 8, day, 1, 1) for k in range(20)]),
    )
    both = quality._silver_report(silver, True, True)
    assert "Join" not in plan(both)
    broken = dict(rows(both.filter("violations > 0")))
    assert broken == {
        "departments.department_id unique": 1, "departments.department_name unique": 1,
        "departments.department_name not null": 1, "employees.employee_id unique": 1, "employees.email unique": 1,
        "employees.email not null": 1, "employees.department_id not null": 1, "employees.effective_from not null": 3,
        "employees.department_id in departments": 2, "assignments.assignment_id unique": 1,
        "assignments.employee_id in employees": 2, "assignments.project_id in projects": 1,
        "reviews.project_id in projects": 20,
    }
    assert both.count() == 45  # a row per rule, also where nothing breaks it
    keys, references = quality.key_rules(silver), quality.reference_rules(silver)
    assert rows(keys.unionByName(references)) == rows(both)


def test_requests_of_one_kind_are_found_without_hashing(spark):
    """The earliest request of each employee, project and size goes on, once."""
    data = [(5, 1, 1, 10), (3, 1, 1, 10), (None, 1, 1, 10), (4, 1, 2, 60), (6, 1, 3, 60), (7, 2, 1, 100), (8, 2, 1, 100)]
    possible = spark.createDataFrame(data, "seq bigint, employee_id bigint, project_id bigint, allocation_pct int")
    used = spark.createDataFrame([(1, 20)], "employee_id bigint, _used bigint")
    taken = changes._accepted_assignments(possible, used)
    assert "HashAggregate(keys=[employee_id" not in plan(taken).replace("ObjectHashAggregate", "")
    got = {r["employee_id"]: [tuple(t) for t in r["_taken"]] for r in taken.collect()}
    assert got == {1: [(3, 1, 20, 30), (4, 2, 30, 90)], 2: [(7, 1, 0, 100)]}


def test_tables_between_stages_take_less_disk(spark):
    words = spark.range(2000).select(F.concat_ws(" ", F.sha2(F.col("id").cast("string"), 256)).alias("text"))
    sizes = []
    for codec in (None, CODEC):
        path = stored(words, "words", codec).inputFiles()[0].removeprefix("file://")
        folder = path.rsplit("/", 1)[0]
        sizes.append(sum(len(open(f, "rb").read()) for f in glob.glob(f"{folder}/*.parquet")))
    assert sizes[1] < 0.8 * sizes[0]
