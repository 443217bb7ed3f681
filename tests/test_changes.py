"""Change requests: single rules, and whole queues against a plain one-by-one replay."""

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import day, rows
from crewlens.model import Silver
from crewlens.operators import changes

TODAY = day("2024-06-01")
PAST = day("2020-01-01")

EMPLOYEES = (
    "employee_id bigint, first_name string, last_name string, email string, department_id bigint, "
    "job_role string, job_level int, hire_date date, effective_from date, age int, gender string, "
    "marital_status string, monthly_income int, attrition string"
)
PROJECTS = (
    "project_id bigint, project_name string, department_id bigint, start_date date, "
    "planned_end_date date, status string, budget decimal(15,2)"
)
ASSIGNMENTS = (
    "assignment_id bigint, employee_id bigint, project_id bigint, assigned_date date, "
    "role_on_project string, allocation_pct int"
)
REVIEWS = (
    "review_id bigint, employee_id bigint, project_id bigint, review_date date, "
    "performance_rating int, review_score decimal(5,2), job_satisfaction int, "
    "work_life_balance int, environment_satisfaction int"
)


def snapshot(spark, people=5, projects=8, assignments=(), since=PAST):
    return Silver(
        departments=spark.createDataFrame(
            [(1, "Sales"), (2, "Human resources"), (3, "Finance")],
            "department_id bigint, department_name string",
        ),
        employees=spark.createDataFrame(
            [(i, "A", "B", f"p{i}@x.com", 1 + i % 3, "Rep", 2, PAST, since, 30, None, "Single", 100, "No")
             for i in range(1, people + 1)],
            EMPLOYEES,
        ),
        projects=spark.createDataFrame(
            [(i, f"Project {i}", 1, PAST, TODAY, "Active", None) for i in range(1, projects + 1)],
            PROJECTS,
        ),
        assignments=spark.createDataFrame(
            [(n + 1, e, p, PAST, "Dev", a) for n, (e, p, a) in enumerate(assignments)], ASSIGNMENTS
        ),
        reviews=spark.createDataFrame([(1, 1, 1, PAST, 3, Decimal(50), 1, 1, 1)], REVIEWS),
    )


GOOD = {
    "first_name": "Ada", "last_name": "Lovelace", "email": "ada@example.com", "department_id": 1,
    "job_role": "Engineer", "job_level": 3, "hire_date": TODAY, "effective_from": TODAY, "age": 30,
    "gender": None, "marital_status": None, "monthly_income": 5000, "attrition": None,
}


def applications(spark, *records):
    names = [c.split()[0] for c in EMPLOYEES.split(", ")][1:]
    return spark.createDataFrame(
        [(n + 1, *[(GOOD | r)[c] for c in names]) for n, r in enumerate(records)],
        "seq bigint, " + EMPLOYEES.split(", ", 1)[1],
    )


@pytest.mark.parametrize("record, message", [
    ({}, None),
    ({"first_name": " "}, "First name and last name are required."),
    ({"last_name": " \t"}, "First name and last name are required."),
    ({"first_name": "12333"}, "First name must contain letters only."),
    ({"last_name": "12333"}, "Last name must contain letters only."),
    ({"last_name": "O'Neil-Smith"}, None),
    ({"email": "invalid"}, "Please enter a valid email address."),
    ({"email": "abc*gmail.com"}, "Please enter a valid email address."),
    ({"email": "a@b.co.uk"}, "Please enter a valid email address."),
    ({"email": " abc@gmail.com "}, None),
    ({"job_role": ""}, "Job role is required."),
    ({"job_role": "12333"}, "Job role must contain letters only."),
    ({"job_role": "Engineer\n2"}, "Job role must contain letters only."),
    ({"age": 17}, "Age must be between 18 and 70."),
    ({"age": 71}, "Age must be between 18 and 70."),
    ({"job_level": 6}, "Job level must be between 1 and 5."),
    ({"monthly_income": 0}, "Monthly income must be greater than 0."),
    ({"hire_date": TODAY + datetime.timedelta(1)}, "Hire date cannot be in the future."),
])
def test_employee_rules(spark, record, message):
    out = changes.validate_employees(applications(spark, record), TODAY).first()
    assert out.reason == message


@pytest.mark.parametrize("name, end, budget, message", [
    ("Platform migration", 30, 1, None),
    ("", 30, 1, "Project name is required."),
    ("0000", 30, 1, "Project name is invalid. Please include at least one letter."),
    ("-x", 30, 1, "Project name is invalid. Please include at least one letter."),
    ("P", -1, 1, "Planned end date must be after the start date."),
    ("P", 0, 1, "Planned end date must be after the start date."),
    ("P", 1, -1, "Budget cannot be negative."),
])
def test_project_rules(spark, name, end, budget, message):
    row = (1, name, 1, TODAY, TODAY + datetime.timedelta(end), "Planned", Decimal(budget))
    out = changes.validate_projects(spark.createDataFrame([row], PROJECTS)).first()
    assert out.reason == message


@pytest.mark.parametrize("rating, score, satisfaction, late, message", [
    (3, 80, 3, 0, None),
    (3, 80, None, 0, None),
    (5, 80, 3, 0, "Performance rating must be 1, 2, 3 or 4."),
    (3, 101, 3, 0, "Review score must be between 0 and 100."),
    (3, 80, 5, 0, "Satisfaction values must be 1 to 4."),
    (3, 80, 3, 1, "Review date cannot be in the future."),
])
def test_review_rules(spark, rating, score, satisfaction, late, message):
    row = (1, 1, 1, TODAY + datetime.timedelta(late), rating, Decimal(score), satisfaction, 3, None)
    out = changes.validate_reviews(spark.createDataFrame([row], REVIEWS), TODAY).first()
    assert out.reason == message


def test_new_employees(spark):
    silver = snapshot(spark)
    requests = applications(
        spark, {"email": "P1@x.com"}, {"email": "New@x.com"}, {"email": " new@X.com"},
        {"department_id": 9}, {"age": 5}, {"email": "second@x.com"},
    )
    outcome = changes.add_employees(requests, silver, TODAY)
    conflict = "Could not save: that email already exists or the department is invalid."
    assert rows(outcome.requests, "seq", "employee_id", "message") == [
        (1, None, conflict), (2, 6, "Employee 6 (Ada Lovelace) added."), (3, None, conflict),
        (4, None, conflict), (5, None, "Age must be between 18 and 70."),
        (6, 7, "Employee 7 (Ada Lovelace) added."),
    ]
    added = outcome.silver.employees.filter("employee_id > 5")
    assert rows(added, "email", "marital_status", "attrition") == [
        ("new@x.com", "Single", "No"), ("second@x.com", "Single", "No"),
    ]
    assert outcome.accepted.count() + outcome.rejected.count() == 6


def test_new_projects_and_reviews(spark):
    silver = snapshot(spark)
    wanted = spark.createDataFrame(
        [(1, " Good ", 1, PAST, TODAY, "Planned", Decimal(1)),
         (2, "Good", 9, PAST, TODAY, "Planned", Decimal(1))],
        PROJECTS.replace("project_id", "seq"),
    )
    outcome = changes.add_projects(wanted, silver)
    assert rows(outcome.requests, "seq", "project_id", "message") == [
        (1, 9, "Project 9 created. Click 'Refresh warehouse' to see it in the dashboards."),
        (2, None, "Invalid department selected."),
    ]
    assert outcome.silver.projects.count() == 9
    reviews = spark.createDataFrame(
        [(n, e, p, PAST, 3, Decimal(5), 1, None, 1) for n, e, p in [(1, 1, 1), (2, 99, 1), (3, 1, 99)]],
        REVIEWS.replace("review_id", "seq"),
    )
    outcome = changes.add_reviews(reviews, silver, TODAY)
    missing = "Employee id or project id does not exist."
    assert rows(outcome.requests, "seq", "review_id", "message") == [
        (1, 2, "Review 2 saved. Click 'Refresh warehouse' to see it in the dashboards."),
        (2, None, missing), (3, None, missing),
    ]
    assert outcome.silver.reviews.count() == 2


CHANGE = (
    "seq bigint, employee_id bigint, department_id bigint, job_role string, job_level int, "
    "monthly_income int, attrition string"
)


def replay_changes(people, queue):
    """One request after the other, as the rules are written."""
    out = {}
    for seq, e, department, role, level, income, attrition in sorted(queue):
        role = role.strip()
        row = people.get(e)
        if row is None:
            out[seq] = f"Employee {e} not found."
        elif row[:5] == (department, role, level, income, attrition):
            out[seq] = changes.NOTHING_CHANGED
        elif row[5] >= TODAY:
            out[seq] = changes.CHANGED_TODAY
        elif level not in (1, 2, 3, 4, 5) or income <= 0:
            out[seq] = changes.LEVEL_OR_INCOME
        elif attrition not in ("Yes", "No"):
            out[seq] = changes.ATTRITION_VALUE
        elif department not in (1, 2, 3):
            out[seq] = changes.DEPARTMENT_INVALID
        else:
            out[seq] = changes.EMPLOYEE_UPDATED
            people[e] = (department, role, level, income, attrition, TODAY)
    return out


def test_employee_changes_equal_a_replay(spark):
    rng = random.Random(5)
    queue = [
        (seq, rng.choice([1, 1, 1, 2, 3, 4, 9]), rng.choice([1, 2, 3, 7]),
         rng.choice([" Rep", "Lead "]), rng.choice([2, 2, 3, 6]), rng.choice([100, 100, 200, 0]),
         rng.choice(["No", "No", "Yes", "Maybe"]))
        for seq in rng.sample(range(1, 5_000_000), 150)
    ]
    silver = snapshot(spark)
    people = {i: (1 + i % 3, "Rep", 2, 100, "No", PAST) for i in range(1, 6)}
    expected = replay_changes(people, queue)
    outcome = changes.apply_employee_changes(spark.createDataFrame(queue, CHANGE), silver, TODAY)
    assert dict(rows(outcome.requests, "seq", "message")) == expected
    after = {
        r[0]: tuple(r[1:]) for r in outcome.silver.employees.select(
            "employee_id", "department_id", "job_role", "job_level", "monthly_income", "attrition",
            "effective_from").collect()
    }
    assert after == people


def test_nobody_changes_twice_a_day(spark):
    queue = [(1, 1, 3, "Rep", 2, 100, "No")]
    outcome = changes.apply_employee_changes(
        spark.createDataFrame(queue, CHANGE), snapshot(spark, since=TODAY), TODAY
    )
    assert outcome.requests.first().message == changes.CHANGED_TODAY


def test_status_changes_equal_a_replay(spark):
    rng = random.Random(6)
    statuses = ["Planned", "Active", "Completed", "On Hold", " Active ", "Cancelled"]
    queue = [
        (seq, rng.choice([1, 1, 1, 2, 3, 99]), rng.choice(statuses))
        for seq in rng.sample(range(1, 5_000_000), 200)
    ]
    stored, expected = {i: "Active" for i in range(1, 9)}, {}
    for seq, p, status in sorted(queue):
        status = status.strip()
        if status not in statuses[:4]:
            expected[seq] = "Status must be one of ['Planned', 'Active', 'Completed', 'On Hold']."
        elif p not in stored:
            expected[seq] = f"Project ID {p} not found."
        elif stored[p] == status:
            expected[seq] = f"Project is already in '{status}' status."
        else:
            stored[p] = status
            expected[seq] = f"Project {p} ('Project {p}') status updated to '{status}'."
    requests = spark.createDataFrame(queue, "seq bigint, project_id bigint, status string")
    outcome = changes.update_project_status(requests, snapshot(spark))
    assert dict(rows(outcome.requests, "seq", "message")) == expected
    assert dict(rows(outcome.silver.projects, "project_id", "status")) == stored


def replay_assignments(existing, queue, people, projects):
    used, taken, out = {}, set(), {}
    for e, p, a in existing:
        used[e] = used.get(e, 0) + a
        taken.add((e, p))
    for seq, e, p, role, a in sorted(queue):
        if not role.strip():
            out[seq] = changes.ASSIGN_ROLE
        elif not 1 <= a <= 100:
            out[seq] = changes.ASSIGN_RANGE
        elif (e, p) in taken:
            out[seq] = changes.ASSIGN_TWICE
        elif used.get(e, 0) + a > 100:
            out[seq] = (
                f"Employee already has {used.get(e, 0)}% allocated. Adding {a}% goes over 100%."
            )
        elif e > people or p > projects:
            out[seq] = changes.REFERENCE_MISSING
        else:
            taken.add((e, p))
            used[e] = used.get(e, 0) + a
            out[seq] = changes.ASSIGNED
    return out


@pytest.mark.parametrize("seed, most", [(1, 60), (2, 12), (3, 2), (4, 1)])
def test_assignments_equal_a_replay(spark, seed, most):
    """Small shares reach 100 accepted requests of one person; that person asks most often."""
    rng = random.Random(seed)
    people, projects = 4, 300
    existing = [(1, 1, 20), (2, 1, 50), (2, 2, 50), (3, 3, 130)]
    queue = [
        (seq, 1 if rng.random() < 0.6 else rng.randint(2, people + 1),
         rng.randint(1, projects + 5), "Dev" if rng.random() < 0.95 else " ",
         rng.randint(0, most) if most > 2 else rng.randint(1, most))
        for seq in rng.sample(range(1, 3_000_000), 900)
    ]
    silver = snapshot(spark, people, projects, existing)
    requests = spark.createDataFrame(
        queue,
        "seq bigint, employee_id bigint, project_id bigint, role_on_project string, allocation_pct int",
    )
    outcome = changes.assign_employees(requests, silver, TODAY)
    expected = replay_assignments(existing, queue, people, projects)
    assert dict(rows(outcome.requests, "seq", "message")) == expected
    accepted = sorted(seq for seq, m in expected.items() if m == changes.ASSIGNED)
    ids = dict(rows(outcome.accepted, "seq", "assignment_id"))
    assert [ids[seq] for seq in accepted] == list(range(5, 5 + len(accepted)))
    totals = outcome.silver.assignments.groupBy("employee_id").agg(F.sum("allocation_pct").alias("t"))
    assert all(t <= 100 for e, t in rows(totals) if e != 3)


def test_departures_cascade(spark):
    silver = snapshot(spark, assignments=[(1, 1, 10), (2, 1, 10)])
    requests = spark.createDataFrame([(1, 1), (2, 1), (3, 77)], "seq bigint, employee_id bigint")
    outcome = changes.delete_employees(requests, silver)
    assert rows(outcome.requests, "seq", "message") == [
        (1, "Employee deleted."), (2, "Employee not found."), (3, "Employee not found."),
    ]
    after = outcome.silver
    assert (after.employees.count(), after.assignments.count(), after.reviews.count()) == (4, 1, 0)


def test_account_roles_and_eligibility(spark):
    silver = snapshot(spark)
    users = spark.createDataFrame(
        [("P1@x.com ", "Viewer", True), ("p3@x.com", "Admin", True), ("p2@x.com", "Admin", True),
         ("hr-admin", "Admin", True), ("gone", "Admin", False)],
        "username string, role string, is_active boolean",
    )
    assert rows(changes.account_roles(users, silver), "username", "role") == [
        ("P1@x.com ", "Admin"), ("hr-admin", "Admin"), ("p2@x.com", None), ("p3@x.com", "Viewer"),
    ]
    requests = spark.createDataFrame(
        [(1, " "), (2, "who@x.com"), (3, "p5@x.com"), (4, " P4@X.com "), (5, "p4@x.com"),
         (6, "p3@x.com")],
        "seq bigint, email string",
    )
    out = changes.account_eligibility(requests, silver, users)
    assert rows(out, "seq", "role", "message") == [
        (1, None, changes.ACCOUNT_REQUIRED), (2, None, changes.ACCOUNT_UNKNOWN),
        (3, None, changes.ACCOUNT_DEPARTMENT), (4, "Admin", "Account created."),
        (5, None, changes.ACCOUNT_TAKEN), (6, None, changes.ACCOUNT_TAKEN),
    ]


def test_requests_without_ids_are_rejected(spark):
    """A missing id must never read as accepted."""
    silver = snapshot(spark)
    change = spark.createDataFrame([(1, None, 1, "Rep", 2, 5, "No")], CHANGE)
    out = changes.apply_employee_changes(change, silver, TODAY).requests.first()
    assert (out.accepted, out.message) == (False, "Employee None not found.")
    status = spark.createDataFrame([(1, None, "Active")], "seq bigint, project_id bigint, status string")
    out = changes.update_project_status(status, silver).requests.first()
    assert (out.accepted, out.message) == (False, "Project ID None not found.")
    assign = spark.createDataFrame(
        [(1, None, 1, "Dev", 5), (2, 1, None, "Dev", 5), (3, 1, 1, None, 5), (4, 1, 1, "Dev", None)],
        "seq bigint, employee_id bigint, project_id bigint, role_on_project string, allocation_pct int",
    )
    out = changes.assign_employees(assign, silver, TODAY).requests
    assert out.filter("accepted").count() == 0 and out.count() == 4
