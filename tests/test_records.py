"""CSV read in blocks equals CSV read whole."""

import numpy as np
import pytest
from pyspark.sql import types as T

from conftest import rows
from crewlens.model import STG_PROJECT
from crewlens.sources import landing, records

SCHEMA = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType()), T.StructField("c", T.StringType())])


@pytest.fixture
def small_blocks(spark):
    """Files are cut every 150 bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "150", "spark.sql.files.openCostInBytes": "0"}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name in names:
        spark.conf.unset(name)


def write(folder, seed, end="\n", long=1, stray=False):
    draws = np.random.default_rng(seed)
    pieces = ["x", '"', ",", "\n", "\r\n", " ", '""', "y z", "\\", "'", "\r"]
    folder.mkdir()
    written = []
    for f in range(2):
        with open(folder / f"{f}.csv", "w", newline="") as out:
            out.write("a,b,c" + end)
            for i in range(40):
                values = ["".join(draws.choice(pieces, int(draws.integers(9)))) * int(draws.integers(1, long + 1)) for _ in range(2)]
                texts = ['"' + v.replace('"', '""') + '"' if set(v) & set('",\r\n') or draws.random() < 0.5 else v for v in values]
                if stray and draws.random() < 0.3:
                    texts[0] = 'st"ray" q'
                    values[0] = texts[0]
                out.write(f"{i},{texts[0]},{texts[1]}{end}")
                written.append((i, *(v or None for v in values)))
                if draws.random() < 0.1:
                    out.write(end)  # empty lines are no rows
    return sorted(written, key=repr)


@pytest.mark.parametrize(("seed", "end", "long", "stray"), [
    (1, "\n", 1, False), (2, "\r\n", 1, False), (3, "\n", 60, False), (4, "\r\n", 60, True), (5, "\n", 3, True)])
def test_blocks_give_the_rows_of_the_whole_file(spark, small_blocks, tmp_path, seed, end, long, stray):
    folder = tmp_path / "f.csv"
    written = write(folder, seed, end, long, stray)
    whole = spark.read.schema(SCHEMA).options(**records.STRICT, multiLine=True).csv(str(folder))
    assert records.has_long_records(spark, str(folder))
    blocks = records._lines(spark, str(folder)).select("file", "block").distinct().count()
    assert blocks > 8  # some begin inside a value
    got = records.read_csv(spark, str(folder), SCHEMA)
    assert rows(got) == written
    if end == "\n":  # else that reader changes line ends inside values
        assert rows(whole) == written


def test_a_value_longer_than_blocks(spark, small_blocks, tmp_path):
    path = tmp_path / "f.csv"
    value = "\n".join(["line", '""quoted""', "", ","] * 200)
    path.write_text(f'a,b,c\n1,"{value}",z\n2,"x\n",y\n')
    assert rows(records.read_csv(spark, str(path), SCHEMA)) == [(1, value.replace('""', '"'), "z"), (2, "x\n", "y")]


def test_plain_files_are_split_by_the_reader(spark, small_blocks, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text("a,b,c\n" + "".join(f'{i},"q, {i}",w""x\n' for i in range(200)))
    assert not records.has_long_records(spark, str(path))
    got = records.read_csv(spark, str(path), SCHEMA)
    assert got.rdd.getNumPartitions() > 5 and got.count() == 200


def test_odd_headers_and_values_fail(spark, small_blocks, tmp_path):
    long = '1,"x\ny",z\n'
    one, two, three = (tmp_path / n for n in ("one.csv", "two.csv", "three.csv"))
    one.mkdir()
    (one / "a.csv").write_text("a,b,c\n" + long)
    (one / "b.csv").write_text("a,c,b\n" + long)
    with pytest.raises(ValueError, match="header does not conform"):
        records.read_csv(spark, str(one), SCHEMA)
    two.write_text("a,b,c\n" + long + "no number,b,c\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        records.read_csv(spark, str(two), SCHEMA).collect()
    three.write_text("a,b,c\n" + long + "1,2\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        records.read_csv(spark, str(three), SCHEMA).collect()


def test_staging_files_with_line_ends_come_back(spark, small_blocks, tmp_path):
    given = spark.createDataFrame(
        [(i, f'Pro"ject\n{i}', "Sales, \r\nEMEA" if i % 2 else None, None, None, "Hold\n", None) for i in range(60)], STG_PROJECT)
    names = ("stg_employee", "stg_employee_history", "stg_assignment", "stg_review")
    empty = {n: spark.createDataFrame([], landing.STAGING[n]) for n in names}
    landing.write_staging({**empty, "stg_project": given}, str(tmp_path))
    again = landing.read_staging(spark, str(tmp_path))
    assert rows(again.project.drop("_loaded_at")) == rows(given)
