"""Declared rules as a report: one row per rule with the number of rows that break it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crewlens.functions.text import is_blank, match_key
from crewlens.model import ACCOUNT_ROLES, Bronze, Gold, Silver
from crewlens.operators.scd2 import valid_history

_REQUIRED = {
    "departments": ["department_id", "department_name"],
    "employees": ["employee_id", "first_name", "last_name", "email", "department_id", "job_role",
                  "job_level", "hire_date", "effective_from", "age", "monthly_income"],
    "projects": ["project_id", "project_name", "department_id", "start_date", "planned_end_date",
                 "status", "budget"],
    "assignments": ["assignment_id", "employee_id", "project_id", "assigned_date",
                    "role_on_project", "allocation_pct"],
    "reviews": ["review_id", "employee_id", "project_id", "review_date", "performance_rating",
                "review_score"],
}
_UNIQUE = {
    "departments": ["department_id", "department_name"],
    "employees": ["employee_id", "email"],
    "projects": ["project_id"],
    "assignments": ["assignment_id"],
    "reviews": ["review_id"],
}
_REFERENCES = {
    "employees": [("department_id", "departments")],
    "projects": [("department_id", "departments")],
    "assignments": [("employee_id", "employees"), ("project_id", "projects")],
    "reviews": [("employee_id", "employees"), ("project_id", "projects")],
}


def _counted(df: DataFrame, rule: str) -> DataFrame:
    return df.agg(F.count("*").alias("violations")).select(F.lit(rule).alias("rule"), "violations")


def _broken(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """All row rules of a table in one pass."""
    rows = F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.count_if(broken).alias("violations"))
        for rule, broken in rules.items()
    ])
    return df.agg(rows.alias("_rows")).select(F.inline("_rows"))


def unique(rule: str, df: DataFrame, key: Column) -> DataFrame:
    """Surplus rows: those beyond the first of each key."""
    sizes = df.select(key.alias("_key")).filter("_key IS NOT NULL").groupBy("_key").count()
    surplus = sizes.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("violations"))
    return surplus.select(F.lit(rule).alias("rule"), "violations")


def _domains(keys: dict[str, dict[str, Column]], references: dict[str, dict[str, tuple[str, str]]]) -> dict[str, list[str]]:
    """The rule of each key, with the rules of the references to it, in the order of their places."""
    domains = {rule: [rule] for of_table in keys.values() for rule in of_table}
    for of_table in references.values():
        for rule, (_, parent) in of_table.items():
            domains[parent].append(rule)
    return domains


def _tags(df: DataFrame, keys: dict[str, Column], references: dict[str, tuple[str, str]],
          domains: dict[str, list[str]]) -> DataFrame:
    """domain, place, number, text: the keys of each row and those it refers to. Whole numbers stay such."""
    number = list(domains)

    def tag(parent: str, rule: str, key: Column) -> Column:
        whole = isinstance(df.select(key).schema[0].dataType, T.IntegralType)
        return F.struct(F.lit(number.index(parent)).alias("domain"), F.lit(domains[parent].index(rule)).alias("place"),
                        (key if whole else F.lit(None)).cast("bigint").alias("number"),
                        (F.lit(None) if whole else key).cast("string").alias("text"))

    tags = [F.when(key.isNotNull(), tag(rule, rule, key)) for rule, key in keys.items()]
    tags += [tag(parent, rule, F.col(c)) for rule, (c, parent) in references.items()]
    return df.select(F.explode(F.array_compact(F.array(*tags))).alias("tag")).select("tag.*")


def _report(tables: dict[str, DataFrame], nulls: dict[str, dict[str, str]], keys: dict[str, dict[str, Column]],
            references: dict[str, dict[str, tuple[str, str]]], rules: list[str]) -> DataFrame:
    """NOT NULL, UNIQUE and reference rules of several tables: one pass over their keys, in which a key
    meets the references to it, and one scan for nulls. A reference names the rule of the key that it refers to.

    Rows of one value are counted by place: the key itself first, then each reference to it.
    """
    domains = _domains(keys, references)
    tags = reduce(DataFrame.unionByName, [
        _tags(tables[name], keys.get(name, {}), references.get(name, {}), domains)
        for name in tables if keys.get(name) or references.get(name)])
    places = range(max(map(len, domains.values())))
    counted = tags.groupBy("domain", "number", "text").agg(
        *[F.count_if(F.col("place") == p).alias(f"_{p}") for p in places])
    # Surplus rows are those beyond the first of a key; lost are references to a value that no key has.
    violations = [F.greatest(F.col("_0") - 1, F.lit(0)), *[F.when(F.col("_0") == 0, F.col(f"_{p}")) for p in places[1:]]]
    sums = counted.groupBy("domain").agg(*[F.sum(v).alias(f"_{p}") for p, v in zip(places, violations)])
    names = F.array(*[F.array(*[F.lit(rule) for rule in of_domain]) for of_domain in domains.values()])
    found = sums.select(F.explode(F.arrays_zip(
        F.get(names, F.col("domain")).alias("rule"), F.array(*[f"_{p}" for p in places]).alias("n"))).alias("r"))
    counts = [
        found.select("r.rule", "r.n"),
        *[_broken(tables[name], {rule: F.col(c).isNull() for rule, c in of_table.items()}).toDF("rule", "n")
          for name, of_table in nulls.items()],
        tags.sparkSession.createDataFrame([(rule, 0) for rule in rules], "rule string, n bigint"),
    ]
    asked = F.col("rule").isin(rules)
    return reduce(DataFrame.unionByName, counts).filter(asked).groupBy("rule").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))


def _key(df: DataFrame, column: str) -> Column:
    """Text is compared case aside."""
    return F.lower(column) if dict(df.dtypes)[column] == "string" else F.col(column)


def _silver_report(silver: Silver, of_keys: bool, of_references: bool) -> DataFrame:
    tables = silver.tables()
    nulls = {t: {f"{t}.{c} not null": c for c in _REQUIRED[t]} for t in tables} if of_keys else {}
    keys = {t: {f"{t}.{c} unique": _key(tables[t], c) for c in _UNIQUE[t]} for t in tables}
    references = {
        t: {f"{t}.{c} in {parent}": (c, f"{parent}.{c} unique") for c, parent in _REFERENCES.get(t, [])} for t in tables
    } if of_references else {}
    parts = [*([nulls, keys] if of_keys else []), *([references] if of_references else [])]
    rules = [rule for part in parts for of_table in part.values() for rule in of_table]
    return _report(tables, nulls, keys, references, rules)


def key_rules(silver: Silver) -> DataFrame:
    """NOT NULL and UNIQUE rules of the conformed layer."""
    return _silver_report(silver, True, False)


def reference_rules(silver: Silver) -> DataFrame:
    return _silver_report(silver, False, True)


_GOLD_UNIQUE = {
    "dim_department": ["department_id", "department_name"], "dim_project": ["project_id"], "dim_date": ["full_date"],
    "dim_employee": ["employee_key"], "fact_performance_reviews": ["review_id"],
}
_FACT_REFERENCES = [("employee_key", "dim_employee"), ("project_key", "dim_project"), ("date_key", "dim_date"),
                    ("department_key", "dim_department")]


def gold_rules(gold: Gold) -> DataFrame:
    """Keys and references of the star schema, and department names that two ids share."""
    tables, fact = gold.tables(), "fact_performance_reviews"
    keys = {t: {f"{t}.{c} unique": _key(tables[t], c) for c in columns} for t, columns in _GOLD_UNIQUE.items()}
    references = {fact: {f"{fact}.{c} in {parent}": (c, f"{parent}.{c} unique") for c, parent in _FACT_REFERENCES}}
    rules = [rule for of_table in (*keys.values(), *references.values()) for rule in of_table]
    # Keys that the fact refers to, and that no rule of their own asks about.
    for column, parent in _FACT_REFERENCES:
        keys[parent].setdefault(f"{parent}.{column} unique", F.col(column))
    return _report(tables, {}, keys, references, rules)


def history_key_rules(history: DataFrame) -> DataFrame:
    return unique(
        "stg_employee_history.history_id unique", history, F.col("history_id")
    ).unionByName(
        _broken(history, {"stg_employee_history.history_id not null": F.col("history_id").isNull()})
    )


def account_rules(users: DataFrame) -> DataFrame:
    return _broken(
        users,
        {
            "users.username not null": F.col("username").isNull(),
            "users.role allowed": ~F.coalesce(F.col("role").isin(ACCOUNT_ROLES), F.lit(False)),
        },
    ).unionByName(unique("users.username unique", users, F.lower("username")))


def dropped_rows(bronze: Bronze, silver: Silver, dim_employee: DataFrame) -> DataFrame:
    """Staged rows that cannot reach the star schema, by reason."""
    names = silver.departments.select(match_key(F.col("department_name")).alias("_department"))

    def in_no_department(df: DataFrame, rule: str) -> DataFrame:
        keyed = df.select(match_key(F.col("department")).alias("_department"))
        return _counted(keyed.join(names, "_department", "left_anti"), rule)

    starts = dim_employee.groupBy("employee_id").agg(F.min("start_date").alias("_first"))
    early = silver.reviews.join(starts, "employee_id").filter(F.col("review_date") < F.col("_first"))
    reports = [
        _broken(
            bronze.employee,
            {
                "stg_employee without id": F.col("employee_id").isNull(),
                "stg_employee without department": is_blank(F.col("department")),
            },
        ),
        _broken(
            bronze.employee_history,
            {
                "stg_employee_history invalid interval": ~F.coalesce(
                    F.col("valid_from") <= F.col("valid_to"), F.lit(False)
                ),
            },
        ),
        history_key_rules(bronze.employee_history),
        unique(
            "stg_employee_history version repeated",
            valid_history(bronze.employee_history),
            F.struct("employee_id", "valid_from", "valid_to",
                     match_key(F.col("department")), F.lower("job_role"), "job_level",
                     "monthly_income"),
        ),
        in_no_department(valid_history(bronze.employee_history),
                         "stg_employee_history unknown department"),
        in_no_department(bronze.project, "stg_project unknown department"),
        _counted(early, "reviews before first version"),
    ]
    return reduce(DataFrame.unionByName, reports)


def data_quality(
    bronze: Bronze, silver: Silver, dim_employee: DataFrame, users: DataFrame | None = None,
    gold: Gold | None = None,
) -> DataFrame:
    """The rules of Silver, rows that staging loses, and those of accounts and Gold if given."""
    reports = [_silver_report(silver, True, True), dropped_rows(bronze, silver, dim_employee)]
    if users is not None:
        reports.append(account_rules(users))
    if gold is not None:
        reports.append(gold_rules(gold))
    return reduce(DataFrame.unionByName, reports)


def enforce(report: DataFrame) -> None:
    """Fail when a declared rule is broken (the report has one row per rule)."""
    broken = [f"{r['rule']}: {r['violations']}" for r in report.filter("violations > 0").collect()]
    if broken:
        raise ValueError("Rules broken: " + "; ".join(sorted(broken)))
