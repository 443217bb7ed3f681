from decimal import Decimal

from pyspark.sql import functions as F

from conftest import day, rows
from crewlens.model import Silver
from crewlens.operators import kpi, roster

FACT = (
    "review_id bigint, employee_key bigint, project_key bigint, date_key int, department_key bigint, "
    "performance_rating int, review_score decimal(5,2), job_satisfaction int, work_life_balance int"
)
VERSION = (
    "employee_key bigint, employee_id bigint, first_name string, last_name string, "
    "department_key bigint, job_role string, attrition string, is_current boolean"
)


def fact_rows(spark, *reviews):
    """(review, employee key, year, score[, department, project])"""
    data = []
    for i, e, year, score, *more in reviews:
        department, project = (more + [1, 1])[:2]
        data.append((i, e, project, year * 10000 + 101, department, 3, Decimal(str(score)), 2, None))
    return spark.createDataFrame(data, FACT)


def departments(spark):
    return spark.createDataFrame([(1, "Sales"), (2, "Legal")], "department_key bigint, department_name string")


def versions(spark, *people):
    return spark.createDataFrame(
        [(k, i, f"P{i}", "Q", 1, "Rep", attrition, current) for k, i, attrition, current in people],
        VERSION,
    )


def test_change_is_from_the_last_year_present(spark):
    fact = fact_rows(spark, (1, 1, 2021, 50), (2, 1, 2023, 60.5), (3, 1, 2023, 61.5), (4, 1, 2022, 9, 2))
    out = kpi.yoy_performance(fact, departments(spark))
    assert rows(out, "department_name", "review_year", "review_count", "score_change_from_prior_year") == [
        ("Legal", 2022, 1, None), ("Sales", 2021, 1, None), ("Sales", 2023, 2, Decimal("11.00")),
    ]
    one = kpi.yoy_performance(fact, departments(spark), "Legal")
    assert rows(one, "review_year") == [(2022,)]


def test_top_employees_keep_ties_and_merge_versions(spark):
    people = [(i, i, "No", True) for i in range(1, 13)] + [(20, 1, "No", False)]
    # Employee 1 has two versions averaging 95; 2 and 3 tie; the rest fall off one by one.
    scores = [(1, 1, 2022, 90), (2, 20, 2022, 100), (3, 2, 2022, 94), (4, 3, 2022, 94)]
    scores += [(i + 1, i, 2022, 90 - i) for i in range(4, 13)]
    out = kpi.top_employees(fact_rows(spark, *scores), versions(spark, *people), departments(spark))
    ranks = dict(rows(out, "employee_id", "department_rank"))
    assert ranks == {1: 1, 2: 2, 3: 2, **{i: i - 1 for i in range(4, 12)}}
    best = kpi.top_employees(
        fact_rows(spark, *scores), versions(spark, *people), departments(spark),
        year=2022, department="Sales", top_n=2,
    )
    assert sorted(r[0] for r in rows(best, "employee_id")) == [1, 2, 3]
    assert kpi.top_employees(
        fact_rows(spark, *scores), versions(spark, *people), departments(spark), year=2021
    ).count() == 0


def test_only_reviews_of_the_current_version_count(spark):
    people = versions(spark, (1, 1, "No", False), (2, 1, "No", True), (3, 2, "yes", True))
    fact = fact_rows(spark, (1, 1, 2022, 10), (2, 2, 2022, 80), (3, 2, 2022, 81))
    out = kpi.attrition_performance(people, departments(spark), fact)
    assert rows(out, "employee_id", "review_count", "average_review_score") == [
        (1, 2, Decimal("80.50")), (2, 0, None),
    ]
    by_department = kpi.attrition_by_department(out).first()
    assert (by_department.employees, by_department.left_company, by_department.attrition_rate_pct) == (
        2, 1, 50.0,
    )


def test_risk_needs_both_measures(spark):
    schema = (
        "employee_id bigint, employee_name string, department_name string, job_role string, "
        "attrition string, review_count bigint, average_review_score decimal(9,2), "
        "average_job_satisfaction decimal(9,2), average_work_life_balance decimal(9,2)"
    )
    d = Decimal
    performance = spark.createDataFrame(
        [(1, "a", "S", "r", "No", 1, d("1"), d("1.00"), d("2.50")),
         (2, "b", "S", "r", "No", 1, d("1"), d("2.00"), d("3.00")),
         (3, "c", "S", "r", "No", 1, d("1"), d("4.00"), d("4.00")),
         (4, "d", "S", "r", "Yes", 1, d("1"), d("1.00"), d("1.00")),
         (5, "e", "S", "r", "No", 1, d("1"), None, d("1.00")),
         (6, "f", "S", "r", "No", 0, None, None, None)],
        schema,
    )
    risk = kpi.attrition_risk(performance)
    assert rows(risk, "employee_id", "risk_score", "risk_level") == [
        (1, d("4.50"), "High"), (2, d("3.00"), "Medium"), (3, d("0.00"), "Low"),
    ]
    assert rows(kpi.risk_level_counts(kpi.attrition_risk(performance, 1))) == [
        ("High", 1), ("Low", 0), ("Medium", 0),
    ]


def test_bottleneck_flags(spark):
    schema = (
        "project_id bigint, budget decimal(15,2), assigned_employee_count bigint, "
        "total_allocation_pct bigint, average_review_score decimal(9,2)"
    )
    allocation, score = [100, 98, 90, 40, 30, 0], [10, 100, 50, 40, 80, 80]
    workload = spark.createDataFrame(
        [(i + 1, None, int(i < 5), allocation[i], Decimal(score[i])) for i in range(6)], schema
    )
    out = kpi.project_bottlenecks(workload)
    assert rows(out, "project_id", "flag") == [
        (1, "Critical"), (2, "Busy"), (3, "OK"), (4, "Low scores"), (5, "OK"), (6, "OK"),
    ]
    assert [r.project_id for r in out.collect()][-1] == 6
    assert out.filter("project_id = 6").first().avg_allocation_pct is None
    assert rows(kpi.flag_counts(out)) == [("Busy", 1), ("Critical", 1), ("Low scores", 1), ("OK", 3)]
    assert kpi.flagged_projects(out).count() == 3
    assert rows(kpi.bottleneck_points(out), "budget")[0] == (Decimal("0.00"),)


def test_workload_keeps_projects_without_people_or_reviews(spark):
    projects = spark.createDataFrame(
        [(1, 1, "One", 1, "Active", None), (2, 2, "Two", 1, "Active", None)],
        "project_key bigint, project_id bigint, project_name string, department_key bigint, "
        "status string, budget decimal(15,2)",
    )
    assigned = spark.createDataFrame(
        [(1, 5, 50), (1, 5, 10), (1, 6, 20)],
        "project_id bigint, employee_id bigint, allocation_pct int",
    )
    out = kpi.project_workload(projects, departments(spark), assigned, fact_rows(spark, (1, 1, 2022, 70)))
    assert rows(
        out, "project_id", "assigned_employee_count", "total_allocation_pct", "review_count",
        "average_review_score",
    ) == [(1, 2, 80, 1, Decimal("70.00")), (2, 0, 0, 0, None)]


def card(spark, people, fact, projects, assigned):
    return kpi.kpi_card(
        versions(spark, *people),
        fact,
        spark.createDataFrame([(Decimal(b),) for b in projects], "budget decimal(15,2)"),
        spark.createDataFrame(assigned, "employee_id bigint, allocation_pct int"),
    ).first().asDict()


def test_kpi_card(spark):
    people = [(i, i, "Yes" if i < 2 else "No", True) for i in range(10)] + [(99, 1, "Yes", False)]
    reviews = fact_rows(spark, (1, 1, 2022, 80.45), (2, 1, 2022, 80.46))
    out = card(spark, people, reviews, ["1000.25", "250.25"], [(1, 60), (1, 50), (2, 100)])
    assert out == {
        "total_employees": 10, "attrition_rate_pct": 20.0, "total_reviews": 2,
        "avg_review_score": 80.46, "avg_performance_rating": 3.0, "avg_job_satisfaction": 2.0,
        "avg_work_life_balance": 0.0, "total_projects": 2, "total_project_budget": 1250.5,
        "overallocated_employees": 1,
    }


def test_kpi_card_of_an_empty_warehouse(spark):
    out = card(spark, [], fact_rows(spark), [], [])
    assert set(out.values()) == {0}


def test_rounding_is_half_away_from_zero(spark):
    out = spark.range(1).select(F.round(F.lit(2.345), 2).alias("x")).first()
    assert out.x == 2.35


# -- lists -------------------------------------------------------------------------------------


def small_silver(spark):
    people = spark.createDataFrame(
        [(1, "Ada", "Cloud", "ada@x.com", 1), (2, "Bob", "Ray", "bob@cloud.com", 1),
         (3, "Cy", "Dee", "cy@x.com", 2)],
        "employee_id bigint, first_name string, last_name string, email string, department_id bigint",
    )
    for column, value in {"job_role": "'Rep'", "job_level": "1", "monthly_income": "5",
                          "effective_from": "DATE'2020-01-01'", "attrition": "'No'"}.items():
        people = people.withColumn(column, F.expr(value))
    projects = spark.createDataFrame(
        [(41, "Cloud one", 1), (42, "cloud 2", 1), (43, "Sky 42", 2)],
        "project_id bigint, project_name string, department_id bigint",
    )
    for column, value in {"start_date": "DATE'2020-01-01'", "planned_end_date": "DATE'2021-01-01'",
                          "status": "'Active'", "budget": "cast(1 AS decimal(15,2))"}.items():
        projects = projects.withColumn(column, F.expr(value))
    assignments = spark.createDataFrame(
        [(1, 1, 41, day("2021-01-01"), "Dev", 10), (2, 1, 41, day("2021-01-02"), "Dev", 10),
         (3, 1, 43, day("2021-01-02"), "Dev", 10), (4, 2, 42, day("2020-01-01"), "Dev", 10)],
        "assignment_id bigint, employee_id bigint, project_id bigint, assigned_date date, "
        "role_on_project string, allocation_pct int",
    )
    reviews = spark.createDataFrame(
        [(1, 1, 41, day("2021-01-01")), (2, 1, 43, day("2021-05-01")), (3, 2, 42, day("2021-05-01"))],
        "review_id bigint, employee_id bigint, project_id bigint, review_date date",
    )
    for column in ("performance_rating", "review_score", "job_satisfaction", "work_life_balance",
                   "environment_satisfaction"):
        reviews = reviews.withColumn(column, F.lit(1))
    names = spark.createDataFrame([(1, "Sales"), (2, "Legal")], "department_id bigint, department_name string")
    return Silver(names, people, projects, assignments, reviews)


def ids(df, column):
    return [r[column] for r in df.collect()]


def test_lists(spark):
    s = small_silver(spark)
    assert ids(roster.departments(s), "department_name") == ["Legal", "Sales"]
    assert ids(roster.list_employees(s, "CLOUD"), "employee_id") == [1, 2]
    assert ids(roster.list_employees(s, "a c"), "employee_id") == [1]
    assert ids(roster.list_employees(s, limit=2), "employee_id") == [1, 2]
    assert ids(roster.list_projects(s, "Cloud"), "project_id") == [42, 41]
    assert ids(roster.list_projects(s, "42"), "project_id") == [42]
    assert ids(roster.list_projects(s, ""), "project_id") == [43, 42, 41]
    assert ids(roster.list_projects(s, employee_id=1), "project_id") == [43, 41]
    assert ids(roster.employee_projects(s, 1), "project_id") == [43, 41]
    assert ids(roster.employee_projects(s, 1, limit=1), "project_id") == [43]
    assert roster.employee_projects(s).count() == 3
    assert ids(roster.list_assignments(s), "assignment_id") == [3, 2, 1, 4]
    assert ids(roster.list_assignments(s, project_id=41, limit=1), "assignment_id") == [2]
    assert ids(roster.list_reviews(s), "review_id") == [3, 2, 1]
    assert ids(roster.list_reviews(s, employee_id=1), "review_id") == [2, 1]
    assert roster.employee(s, 2).count() == 1 and roster.employee(s, 9).count() == 0


def test_labels_and_search_guard(spark):
    from crewlens.functions.text import person_label, project_label, searchable

    s = small_silver(spark)
    assert rows(s.employees.filter("employee_id = 1").select(person_label())) == [
        ("Ada Cloud (ada@x.com)",)
    ]
    project = s.projects.filter("project_id = 43")
    assert rows(project.select(project_label(), project_label(with_status=True))) == [
        ("Sky 42 (ID: 43)", "Sky 42 (ID: 43 | Status: Active)")
    ]
    assert [searchable(t) for t in ("ada", "@", "42", "", None)] == [True, True, False, False, False]


def test_history_and_timeline(spark):
    dim = versions(spark, (1, 1, "No", False), (2, 1, "No", True)).selectExpr(
        "*", "1 AS job_level", "10 AS monthly_income",
        "CASE WHEN is_current THEN DATE'2021-01-01' ELSE DATE'2020-01-01' END AS start_date",
        "CASE WHEN is_current THEN DATE'9999-12-31' ELSE DATE'2020-12-31' END AS end_date",
    )
    history = roster.employee_history(dim, departments(spark), 1)
    assert ids(history, "start_date") == [day("2020-01-01"), day("2021-01-01")]
    plot = roster.history_timeline(history, day("2025-06-01"))
    assert rows(plot, "version", "end_plot", "end_label") == [
        ("Sales / Rep", day("2020-12-31"), "2020-12-31"), ("Sales / Rep", day("2025-06-01"), "current"),
    ]
