"""Record rules: the first broken rule gives the message, NULL means the record is fine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crewlens.functions.text import is_blank

# Patterns and messages shown to users.
NAME_PATTERN = r"[A-Za-z]+(?:[ '-][A-Za-z]+)*"
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z]{2,})"
ROLE_PATTERN = r"[A-Za-z]+(?:[ '&/-][A-Za-z]+)*"
PROJECT_NAME_PATTERN = r"(?=.*[A-Za-z])[A-Za-z0-9][A-Za-z0-9 '&/_().-]*"

NAMES_REQUIRED = "First name and last name are required."
FIRST_NAME_LETTERS = "First name must contain letters only."
LAST_NAME_LETTERS = "Last name must contain letters only."
EMAIL_INVALID = "Please enter a valid email address."
ROLE_REQUIRED = "Job role is required."
ROLE_LETTERS = "Job role must contain letters only."
AGE_RANGE = "Age must be between 18 and 70."
LEVEL_RANGE = "Job level must be between 1 and 5."
INCOME_POSITIVE = "Monthly income must be greater than 0."
HIRE_FUTURE = "Hire date cannot be in the future."

PROJECT_NAME_REQUIRED = "Project name is required."
PROJECT_NAME_INVALID = "Project name is invalid. Please include at least one letter."
PROJECT_DATES = "Planned end date must be after the start date."
BUDGET_NEGATIVE = "Budget cannot be negative."

RATING_RANGE = "Performance rating must be 1, 2, 3 or 4."
SCORE_RANGE = "Review score must be between 0 and 100."
SATISFACTION_RANGE = "Satisfaction values must be 1 to 4."
REVIEW_FUTURE = "Review date cannot be in the future."


def first_broken(*rules: tuple[Column, str | Column]) -> Column:
    """Message of the first rule whose condition (a broken one) is true; NULL if none is."""
    chain = None
    for broken, message in rules:
        text = message if isinstance(message, Column) else F.lit(message)
        chain = F.when(broken, text) if chain is None else chain.when(broken, text)
    return chain.otherwise(F.lit(None).cast("string"))


def unless(ok: Column) -> Column:
    """True where `ok` is false or unknown."""
    return ~F.coalesce(ok, F.lit(False))


def matches(c: Column, pattern: str) -> Column:
    """The whole value, outer whitespace aside, fits the pattern."""
    return c.rlike(rf"^\s*(?:{pattern})\s*\z")


def employee_rules(as_of: Column) -> Column:
    c = F.col
    return first_broken(
        (is_blank(c("first_name")) | is_blank(c("last_name")), NAMES_REQUIRED),
        (unless(matches(c("first_name"), NAME_PATTERN)), FIRST_NAME_LETTERS),
        (unless(matches(c("last_name"), NAME_PATTERN)), LAST_NAME_LETTERS),
        (unless(matches(c("email"), EMAIL_PATTERN)), EMAIL_INVALID),
        (is_blank(c("job_role")), ROLE_REQUIRED),
        (unless(matches(c("job_role"), ROLE_PATTERN)), ROLE_LETTERS),
        (unless(c("age").between(18, 70)), AGE_RANGE),
        (unless(c("job_level").between(1, 5)), LEVEL_RANGE),
        (unless(c("monthly_income") > 0), INCOME_POSITIVE),
        (unless(c("hire_date") <= as_of), HIRE_FUTURE),
    )


def project_rules() -> Column:
    c = F.col
    return first_broken(
        (is_blank(c("project_name")), PROJECT_NAME_REQUIRED),
        (unless(matches(c("project_name"), PROJECT_NAME_PATTERN)), PROJECT_NAME_INVALID),
        (unless(c("planned_end_date") > c("start_date")), PROJECT_DATES),
        (unless(c("budget") >= 0), BUDGET_NEGATIVE),
    )


def review_rules(as_of: Column) -> Column:
    c = F.col
    satisfied = [
        c(name).isNull() | c(name).between(1, 4)
        for name in ("job_satisfaction", "work_life_balance", "environment_satisfaction")
    ]
    return first_broken(
        (unless(c("performance_rating").between(1, 4)), RATING_RANGE),
        (unless(c("review_score").between(0, 100)), SCORE_RANGE),
        (~(satisfied[0] & satisfied[1] & satisfied[2]), SATISFACTION_RANGE),
        (unless(c("review_date") <= as_of), REVIEW_FUTURE),
    )
