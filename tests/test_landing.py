"""CSV files as other programs write them, and refusals instead of silent losses."""

import pytest
from pyspark.sql import functions as F

from crewlens.operators import changes, kpi, scale, scd2
from crewlens.operators.lookups import own_exchange
from crewlens.sources import landing
from tests.conftest import rows

PROJECT = "project_id,project_name,department,start_date,planned_end_date,status,budget\n"


def test_quotes_and_line_ends_inside_values(spark, tmp_path):
    for name in landing.STAGING:
        (tmp_path / f"{name}.csv").write_text(",".join(landing.STAGING[name].names[:-1]) + "\n")
    (tmp_path / "stg_project.csv").write_text(
        PROJECT + '1,"PRJ ""Big"" one",Sales,2020-01-01,2021-01-01,Active,10.50\n'
        '2,"two\nlines, and \\ sign",Sales,2020-01-01,2021-01-01,Active,\n')
    staged = landing.read_staging(spark, str(tmp_path)).project
    want = [(1, 'PRJ "Big" one'), (2, "two\nlines, and \\ sign")]
    assert rows(staged, "project_id", "project_name") == want
    folder = str(tmp_path / "again")
    landing.write_staging({"stg_project": staged}, folder)
    again = spark.read.schema("project_id int, project_name string").options(**landing._CSV)
    assert rows(again.option("enforceSchema", True).csv(f"{folder}/stg_project.csv"), "project_id", "project_name") == want


@pytest.mark.parametrize("name, snake", [
    ("MonthlyIncome", "monthly_income"), ("age", "age"), ("A", "a"), ("", ""), ("Over18", "over18"),
    ("HRCode", "h_r_code"),
])
def test_snake_case(name, snake):
    assert landing.snake_case(name) == snake


def test_upsampling_never_drops_base_rows(spark):
    base = spark.range(1, 101).withColumnRenamed("id", "employee_number")
    with pytest.raises(ValueError):
        scale.upsample_rows(base, 40, "employee_number")
    assert scale.upsample_rows(base, 100, "employee_number").count() == 100


def test_version_keys_refuse_ids_that_do_not_fit(spark):
    ids = spark.createDataFrame([(2**42 - 1,)], "history_id bigint")
    assert ids.select(scd2._source_id("history_id")).first()[0] == 2**42 - 1
    for bad in (2**42, -1):
        with pytest.raises(Exception, match="does not fit a version key"):
            ids.select((F.lit(bad)).alias("history_id")).select(scd2._source_id("history_id")).collect()


def test_department_filters_ignore_case(spark):
    fact = spark.createDataFrame([(1, 1, 20240101, 5.0, 3)], "review_id int, department_key int, date_key int, review_score double, performance_rating int")
    names = spark.createDataFrame([(1, "Sales")], "department_key int, department_name string")
    assert kpi.yoy_performance(fact, names, " sales").count() == 1
    assert kpi.yoy_performance(fact, names, "ops").count() == 0


def test_frequent_keys_of_folded_tables_are_split(spark):
    """Half of the rows share a key that is joined with a folded table."""
    old = {k: spark.conf.get(k, None) for k in (
        "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    try:
        for key, value in zip(old, ("-1", "8", "4k", "1.5", "4k"), strict=True):
            spark.conf.set(key, value)
        big = spark.range(60_000).select(
            F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 97)).alias("k"), "id").repartition(6)
        folded = big.groupBy("k").agg(F.min("id").alias("least"))
        joined = big.join(own_exchange(folded, "k"), "k", "left")
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.agg(F.count("*")).first()[0] == 60_000
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_white_space_of_any_kind_is_stripped(spark):
    df = spark.createDataFrame([("\t Planned\n ",)], "s string")
    assert df.select(changes.strip(F.col("s"))).first()[0] == "Planned"
