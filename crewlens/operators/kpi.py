"""Questions asked of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crewlens.functions.text import exact_avg, full_name, match_key, said_yes
from crewlens.model import PROJECT_FLAGS, RISK_LEVELS, Gold
from crewlens.sources.landing import row_counts


def review_year() -> Column:
    """The year is the leading part of the yyyymmdd key, so the fact needs no calendar join."""
    return F.expr("date_key div 10000").cast("int").alias("review_year")


def _named(df: DataFrame, dim_department: DataFrame) -> DataFrame:
    return df.join(dim_department.select("department_key", "department_name"), "department_key")


def _wanted(dim_department: DataFrame, department: str) -> DataFrame:
    """Keys of the department of that name, whatever its case."""
    same = match_key(F.col("department_name")) == match_key(F.lit(department))
    return dim_department.filter(same).select("department_key")


def yoy_performance(
    fact: DataFrame, dim_department: DataFrame, department: str | None = None
) -> DataFrame:
    """Reviews and averages per department and year, and the change from the last year present.

    The fact holds a review once, so counting rows counts distinct reviews.
    """
    if department is not None:
        fact = fact.join(_wanted(dim_department, department), "department_key", "left_semi")
    yearly = fact.groupBy(review_year(), "department_key").agg(
        F.count("review_id").alias("review_count"),
        F.avg("review_score").alias("_score"),
        exact_avg("performance_rating").alias("_rating"),
    )
    prior = F.lag("_score").over(Window.partitionBy("department_key").orderBy("review_year"))
    return _named(yearly, dim_department).select(
        "review_year",
        "department_name",
        "review_count",
        F.round("_score", 2).alias("average_review_score"),
        F.round("_rating", 2).alias("average_performance_rating"),
        F.round(F.col("_score") - prior, 2).alias("score_change_from_prior_year"),
    ).orderBy("department_name", "review_year")


_SUMS = ["review_count", "score_sum", "score_count", "rating_sum", "rating_count"]


def review_sums(fact: DataFrame, *keys: str) -> DataFrame:
    """Counts and sums per department and year (and further keys), which can be added up."""
    return fact.groupBy(*keys, review_year(), "department_key").agg(
        F.count("review_id").alias("review_count"),
        F.sum(F.col("review_score").cast("decimal(28,2)")).alias("score_sum"),
        F.count("review_score").alias("score_count"),
        F.sum(F.col("performance_rating").cast("bigint")).alias("rating_sum"),
        F.count("performance_rating").alias("rating_count"),
    )


def yoy_of_sums(sums: DataFrame, dim_department: DataFrame) -> DataFrame:
    """`yoy_performance` from stored sums of parts of the fact."""
    def mean(name: str) -> Column:
        count = F.col(f"{name}_count").cast("decimal(19,0)")
        return F.when(count > 0, F.col(f"{name}_sum").cast("decimal(28,2)") / count)

    whole = sums.groupBy("review_year", "department_key").agg(*(F.sum(c).alias(c) for c in _SUMS))
    yearly = whole.select(
        "review_year", "department_key", "review_count",
        mean("score").cast("decimal(9,6)").alias("_score"), mean("rating").cast("decimal(14,4)").alias("_rating"),
    )
    prior = F.lag("_score").over(Window.partitionBy("department_key").orderBy("review_year"))
    return _named(yearly, dim_department).select(
        "review_year", "department_name", "review_count",
        F.round("_score", 2).alias("average_review_score"),
        F.round("_rating", 2).alias("average_performance_rating"),
        F.round(F.col("_score") - prior, 2).alias("score_change_from_prior_year"),
    ).orderBy("department_name", "review_year")


def yoy_overall(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy(review_year())
        .agg(
            F.count("*").alias("review_count"),
            F.round(F.avg("review_score"), 2).alias("average_review_score"),
        )
        .orderBy("review_year")
    )


def top_employees(
    fact: DataFrame,
    dim_employee: DataFrame,
    dim_department: DataFrame,
    year: int | None = None,
    department: str | None = None,
    top_n: int = 10,
) -> DataFrame:
    """Best average scores per year and department; ties share a rank and are all kept (1..10).

    Ranks are worked out on the distinct averages, of which at most ten per group survive, and
    then looked up: a department with most of the staff never has to be sorted in one task.
    """
    reviews = fact.select(review_year(), "employee_key", "department_key", "review_score")
    if year is not None:
        reviews = reviews.filter(F.col("review_year") == year)
    if department is not None:
        reviews = reviews.join(_wanted(dim_department, department), "department_key", "left_semi")
    # Versions first, so a person's reviews are folded together before names are joined on.
    per_version = reviews.groupBy("review_year", "department_key", "employee_key").agg(
        F.sum((F.col("review_score") * 100).cast("bigint")).alias("_cents"),
        F.count("review_score").alias("_n"),
    )
    people = dim_employee.select("employee_key", "employee_id", "first_name", "last_name")
    averages = (
        per_version.join(people, "employee_key")
        .groupBy("review_year", "department_key", "employee_id", "first_name", "last_name")
        .agg(
            F.try_divide(F.sum("_cents").cast("decimal(20,2)") / 100, F.sum("_n"))
            .cast("decimal(9,6)")
            .alias("_average")
        )
    )
    group = ["review_year", "department_key"]
    rank = F.dense_rank().over(Window.partitionBy(*group).orderBy(F.col("_average").desc()))
    ranks = (
        averages.select(*group, "_average")
        .distinct()
        .withColumn("department_rank", rank)
        .filter(F.col("department_rank") <= min(int(top_n), 10))
    )
    return (
        _named(averages.join(ranks, [*group, "_average"]), dim_department)
        .select(
            "review_year",
            "department_name",
            "employee_id",
            full_name().alias("employee_name"),
            F.round("_average", 2).alias("average_review_score"),
            "department_rank",
        )
        .orderBy(F.col("review_year").desc(), "department_name", "department_rank", "employee_id")
    )


def attrition_performance(
    dim_employee: DataFrame, dim_department: DataFrame, fact: DataFrame
) -> DataFrame:
    """Every current employee with the averages of the reviews linked to that version."""
    reviews = fact.groupBy("employee_key").agg(
        F.count("review_id").alias("review_count"),
        F.round(F.avg("review_score"), 2).alias("average_review_score"),
        F.round(exact_avg("job_satisfaction"), 2).alias("average_job_satisfaction"),
        F.round(exact_avg("work_life_balance"), 2).alias("average_work_life_balance"),
    )
    current = dim_employee.filter("is_current")
    return (
        _named(current, dim_department)
        .join(reviews, "employee_key", "left")
        .select(
            "employee_id",
            full_name().alias("employee_name"),
            "department_name",
            "job_role",
            "attrition",
            F.coalesce("review_count", F.lit(0)).alias("review_count"),
            "average_review_score",
            "average_job_satisfaction",
            "average_work_life_balance",
        )
    )


def attrition_by_department(performance: DataFrame) -> DataFrame:
    left = F.count_if(said_yes(F.col("attrition")))
    return (
        performance.groupBy("department_name")
        .agg(
            F.count("*").alias("employees"),
            left.alias("left_company"),
            F.round(F.lit(100) * left / F.count("*"), 2).alias("attrition_rate_pct"),
            F.round(F.avg("average_review_score"), 2).alias("avg_review_score"),
        )
        .orderBy(F.col("attrition_rate_pct").desc(), "department_name")
    )


def attrition_risk(performance: DataFrame, top_n: int = 25) -> DataFrame:
    """Staff most likely to leave: (4 - job satisfaction) + (4 - work-life balance), highest first."""
    score = F.round(
        (F.lit(4) - F.col("average_job_satisfaction"))
        + (F.lit(4) - F.col("average_work_life_balance")),
        2,
    )
    level = (
        F.when(F.col("risk_score") >= 4, "High").when(F.col("risk_score") >= 3, "Medium").otherwise("Low")
    )
    return (
        performance.filter((F.lower("attrition") == "no") & (F.col("review_count") > 0))
        .filter(score.isNotNull())
        .select(
            "employee_id", "employee_name", "department_name", "job_role", "average_review_score",
            "average_job_satisfaction", "average_work_life_balance", score.alias("risk_score"),
        )
        .withColumn("risk_level", level)
        .orderBy(F.col("risk_score").desc(), "employee_id")
        .limit(int(top_n))
    )


def category_counts(df: DataFrame, column: str, categories: list[str], name: str) -> DataFrame:
    """Rows per category, 0 where there is none, in one pass."""
    counts = F.array(*[
        F.struct(F.lit(c).alias(column), F.count_if(F.col(column) == c).alias(name))
        for c in categories
    ])
    return df.agg(counts.alias("_counts")).select(F.inline("_counts"))


def risk_level_counts(risk: DataFrame) -> DataFrame:
    return category_counts(risk, "risk_level", RISK_LEVELS, "employees")


def project_workload(
    dim_project: DataFrame, dim_department: DataFrame, assignments: DataFrame, fact: DataFrame
) -> DataFrame:
    """People, allocation and review quality per project; both sides are aggregated before joining."""
    people = (
        assignments.groupBy("project_id", "employee_id")
        .agg(F.sum("allocation_pct").alias("_allocation"))
        .groupBy("project_id")
        .agg(
            F.count("employee_id").alias("assigned_employee_count"),
            F.sum("_allocation").alias("total_allocation_pct"),
        )
    )
    quality = fact.groupBy("project_key").agg(
        F.count("*").alias("review_count"),
        F.round(F.avg("review_score"), 2).alias("average_review_score"),
    )
    return (
        _named(dim_project, dim_department)
        .join(people, "project_id", "left")
        .join(quality, "project_key", "left")
        .select(
            "project_id", "project_name", "department_name", "status", "budget",
            *[
                F.coalesce(c, F.lit(0)).alias(c)
                for c in ("assigned_employee_count", "total_allocation_pct", "review_count")
            ],
            "average_review_score",
        )
    )


def project_bottlenecks(workload: DataFrame) -> DataFrame:
    """Workload with a flag: top-quarter allocation is Busy, bottom-quarter scores are Low scores.

    The quartiles are exact; `percentile` keeps one counter per distinct value, and both columns
    hold two-decimal numbers of limited range, so its state does not grow with the projects.
    """
    people = F.col("assigned_employee_count")
    projects = workload.withColumn(
        "avg_allocation_pct", F.round(F.when(people > 0, F.col("total_allocation_pct") / people), 2)
    )
    quartiles = projects.agg(
        F.struct(
            F.percentile("avg_allocation_pct", F.lit(0.75)).alias("busy"),
            F.percentile(F.col("average_review_score").cast("double"), F.lit(0.25)).alias("weak"),
        )
    ).scalar()
    busy = F.coalesce(F.col("avg_allocation_pct") >= F.col("_q.busy"), F.lit(False))
    weak = F.coalesce(
        F.col("average_review_score").cast("double") <= F.col("_q.weak"), F.lit(False)
    )
    return (
        projects.withColumn("_q", quartiles)
        .withColumn(
            "flag",
            F.when(busy & weak, "Critical").when(weak, "Low scores").when(busy, "Busy").otherwise("OK"),
        )
        .drop("_q")
        .orderBy(F.col("avg_allocation_pct").desc_nulls_last(), "project_id")
    )


def flag_counts(bottlenecks: DataFrame) -> DataFrame:
    return category_counts(bottlenecks, "flag", PROJECT_FLAGS, "projects")


def flagged_projects(bottlenecks: DataFrame, flags: list[str] | None = None) -> DataFrame:
    """Projects under the chosen flags (everything but OK when none are chosen)."""
    return bottlenecks.filter(F.col("flag").isin(flags or PROJECT_FLAGS[:3]))


def bottleneck_points(bottlenecks: DataFrame) -> DataFrame:
    """Projects that have both measures; a missing budget counts as 0."""
    return bottlenecks.dropna(subset=["avg_allocation_pct", "average_review_score"]).withColumn(
        "budget", F.coalesce("budget", F.lit(0).cast("decimal(15,2)"))
    )


def project_status_counts(dim_project: DataFrame) -> DataFrame:
    return (
        dim_project.groupBy("status")
        .agg(F.count("*").alias("projects"), F.round(F.sum("budget"), 2).alias("total_budget"))
        .orderBy(F.col("projects").desc(), "status")
    )


def overallocated_employees(assignments: DataFrame) -> DataFrame:
    return (
        assignments.groupBy("employee_id")
        .agg(F.sum("allocation_pct").alias("total_allocation_pct"))
        .filter(F.col("total_allocation_pct") > 100)
    )


def kpi_card(
    dim_employee: DataFrame, fact: DataFrame, dim_project: DataFrame, assignments: DataFrame
) -> DataFrame:
    """The ten headline numbers as one row.

    Each source is reduced to one row; the rows are stacked and folded, so nothing is joined.
    """

    def mean(c: Column) -> Column:
        return F.coalesce(F.round(c, 2), F.lit(0)).cast("double")

    total = F.count("*")
    left = F.count_if(said_yes(F.col("attrition")))
    rate = F.when(total > 0, F.round(F.try_divide(F.lit(100) * left, total), 2)).otherwise(F.lit(0.0))
    parts = [
        dim_employee.filter("is_current").agg(
            total.alias("total_employees"), rate.cast("double").alias("attrition_rate_pct")
        ),
        fact.agg(
            F.count("*").alias("total_reviews"),
            mean(F.avg("review_score")).alias("avg_review_score"),
            mean(exact_avg("performance_rating")).alias("avg_performance_rating"),
            mean(exact_avg("job_satisfaction")).alias("avg_job_satisfaction"),
            mean(exact_avg("work_life_balance")).alias("avg_work_life_balance"),
        ),
        dim_project.agg(
            F.count("*").alias("total_projects"),
            F.coalesce(F.sum("budget"), F.lit(0)).cast("double").alias("total_project_budget"),
        ),
        overallocated_employees(assignments).agg(F.count("*").alias("overallocated_employees")),
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def years(dim_date: DataFrame) -> DataFrame:
    return dim_date.select("year_number").distinct().orderBy(F.col("year_number").desc())


def department_names(dim_department: DataFrame) -> DataFrame:
    return dim_department.select("department_name").orderBy("department_name")


def refresh_summary(gold: Gold) -> DataFrame:
    """Rows per Gold table."""
    return row_counts(gold.tables())
