"""A mixed queue equals handling its requests one after the other."""

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import day, rows
from crewlens.model import (
    ASSIGNMENT_COLUMNS, EMPLOYEE_COLUMNS, PROJECT_COLUMNS, PROJECT_STATUSES, REVIEW_COLUMNS, STG_ASSIGNMENT, STG_REVIEW, Silver,
)
from crewlens.operators import changes, queue
from crewlens.session import stored

AS_OF = day("2026-01-10")
EMPLOYEES = ("employee_id bigint, first_name string, last_name string, email string, department_id bigint, job_role string, "
             "job_level int, hire_date date, effective_from date, age int, gender string, marital_status string, "
             "monthly_income int, attrition string")
PROJECTS = ("project_id bigint, project_name string, department_id bigint, start_date date, planned_end_date date, "
            "status string, budget decimal(15,2)")
HIRES = ("seq bigint, first_name string, last_name string, email string, department_id bigint, job_role string, job_level int, "
         "hire_date date, age int, gender string, marital_status string, monthly_income int, attrition string")
CHANGES = ("seq bigint, employee_id bigint, department_id bigint, job_role string, job_level int, monthly_income int, attrition string")
REVIEWS = ("seq bigint, employee_id bigint, project_id bigint, review_date date, performance_rating int, review_score decimal(5,2), "
           "job_satisfaction int, work_life_balance int, environment_satisfaction int")
ASSIGNMENTS = "seq bigint, employee_id bigint, project_id bigint, role_on_project string, allocation_pct int"
STATUSES = "seq bigint, project_id bigint, status string"
OPENED = "seq bigint, project_name string, department_id bigint, start_date date, planned_end_date date, status string, budget decimal(15,2)"
SCHEMAS = {"hires": HIRES, "projects": OPENED, "reviews": REVIEWS, "employee_changes": CHANGES, "statuses": STATUSES,
           "assignments": ASSIGNMENTS, "departures": "seq bigint, employee_id bigint"}


def company(spark):
    people = [(i, f"P{'abcdef'[i]}", "Q", f"p{i}@x.com", 1 + i % 2, "Rep", 2, day("2020-01-01"), day("2020-01-01"), 30, "Male",
               "Single", 1000, "No") for i in range(1, 5)]
    works = [(i, f"W{i}", 1, day("2025-01-01"), day("2026-12-31"), "Active", None) for i in range(1, 4)]
    assigned = [(1, 1, 1, day("2025-01-01"), "Dev", 60), (2, 2, 1, day("2025-01-01"), "Dev", 30)]
    seen = [(1, 1, 1, day("2025-05-05"), 3, None, None, None, None)]
    return Silver(
        departments=spark.createDataFrame([(1, "Sales"), (2, "Ops")], "department_id bigint, department_name string"),
        employees=spark.createDataFrame(people, EMPLOYEES), projects=spark.createDataFrame(works, PROJECTS),
        assignments=spark.createDataFrame(assigned, STG_ASSIGNMENT), reviews=spark.createDataFrame(seen, STG_REVIEW))


def some_queue(seed, length):
    draws = random.Random(seed)
    found = {kind: [] for kind in SCHEMAS}
    for seq in range(1, length + 1):
        who, what = draws.randint(1, 9), draws.randint(1, 6)
        kind = draws.choice(list(SCHEMAS))
        if kind == "hires":
            found[kind].append((seq, draws.choice(["Ann", "Bob", "9"]), "New", f"{draws.choice(['p1', 'p2', 'n1', 'n2'])}@x.com",
                                draws.choice([1, 2, 2, 7]), "Rep", 3, day("2026-01-05"), 30, "Male", None, 900, None))
        elif kind == "projects":
            found[kind].append((seq, draws.choice(["More", "00"]), 1, day("2026-01-01"), day("2026-02-01"), "Planned", Decimal(5)))
        elif kind == "reviews":
            found[kind].append((seq, who, what, day("2026-01-02"), draws.choice([3, 9]), Decimal(50), None, None, None))
        elif kind == "employee_changes":
            found[kind].append((seq, who, draws.choice([1, 2]), draws.choice(["Rep", "Lead"]), draws.choice([2, 3, 9]), 1500, "No"))
        elif kind == "statuses":
            found[kind].append((seq, what, draws.choice([*PROJECT_STATUSES, "Odd"])))
        elif kind == "assignments":
            found[kind].append((seq, who, what, draws.choice(["Dev", ""]), draws.choice([20, 50, 80, 0])))
        else:
            found[kind].append((seq, who))
    return found


FUNCTIONS = {
    "hires": lambda df, s: changes.add_employees(df, s, AS_OF), "projects": changes.add_projects,
    "reviews": lambda df, s: changes.add_reviews(df, s, AS_OF),
    "employee_changes": lambda df, s: changes.apply_employee_changes(df, s, AS_OF),
    "statuses": changes.update_project_status, "assignments": lambda df, s: changes.assign_employees(df, s, AS_OF),
    "departures": changes.delete_employees,
}


class Replay:
    """The same queue, one request after the other, on plain rows."""

    def __init__(self, silver):
        self.people = {r.employee_id: r.asDict() for r in silver.employees.collect()}
        self.works = {r.project_id: r.asDict() for r in silver.projects.collect()}
        self.assigned = {r.assignment_id: r.asDict() for r in silver.assignments.collect()}
        self.reviews = {r.review_id: r.asDict() for r in silver.reviews.collect()}
        self.next = {name: max(table) + 1 for name, table in vars(self).items()}

    def new(self, table):
        self.next[table] += 1
        return self.next[table] - 1

    def hires(self, r):
        if r["first_name"] == "9":
            return "First name must contain letters only."
        if r["email"] in {p["email"] for p in self.people.values()} or r["department_id"] not in (1, 2):
            return changes.EMPLOYEE_CONFLICT
        i = self.new("people")
        self.people[i] = {**r, "employee_id": i, "effective_from": r["hire_date"], "marital_status": "Single", "attrition": "No"}
        return None

    def projects(self, r):
        if r["project_name"] == "00":
            return "Project name is invalid. Please include at least one letter."
        i = self.new("works")
        self.works[i] = {**r, "project_id": i}
        return None

    def reviews_(self, r):
        if r["performance_rating"] == 9:
            return "Performance rating must be 1, 2, 3 or 4."
        if r["employee_id"] not in self.people or r["project_id"] not in self.works:
            return changes.REFERENCE_MISSING
        i = self.new("reviews")
        self.reviews[i] = {**r, "review_id": i}
        return None

    def employee_changes(self, r):
        p = self.people.get(r["employee_id"])
        if p is None:
            return f"Employee {r['employee_id']} not found."
        fields = ("department_id", "job_role", "job_level", "monthly_income", "attrition")
        if all(p[f] == r[f] for f in fields):
            return changes.NOTHING_CHANGED
        if p["effective_from"] >= AS_OF:
            return changes.CHANGED_TODAY
        if r["job_level"] == 9:
            return changes.LEVEL_OR_INCOME
        p.update({f: r[f] for f in fields}, effective_from=AS_OF)
        return None

    def statuses(self, r):
        if r["status"] not in PROJECT_STATUSES:
            return changes.STATUS_VALUE
        if r["project_id"] not in self.works:
            return f"Project ID {r['project_id']} not found."
        if self.works[r["project_id"]]["status"] == r["status"]:
            return f"Project is already in '{r['status']}' status."
        self.works[r["project_id"]]["status"] = r["status"]
        return None

    def assignments(self, r):
        if not r["role_on_project"]:
            return changes.ASSIGN_ROLE
        if not r["allocation_pct"]:
            return changes.ASSIGN_RANGE
        own = [a for a in self.assigned.values() if a["employee_id"] == r["employee_id"]]
        if r["project_id"] in {a["project_id"] for a in own}:
            return changes.ASSIGN_TWICE
        used = sum(a["allocation_pct"] for a in own)
        if used + r["allocation_pct"] > 100:
            return f"Employee already has {used}% allocated. Adding {r['allocation_pct']}% goes over 100%."
        if r["employee_id"] not in self.people or r["project_id"] not in self.works:
            return changes.REFERENCE_MISSING
        i = self.new("assigned")
        self.assigned[i] = {**r, "assignment_id": i, "assigned_date": AS_OF}
        return None

    def departures(self, r):
        if self.people.pop(r["employee_id"], None) is None:
            return changes.EMPLOYEE_MISSING
        for table in (self.assigned, self.reviews):
            for i in [i for i, x in table.items() if x["employee_id"] == r["employee_id"]]:
                del table[i]
        return None


def tables(silver):
    return {name: rows(getattr(silver, name), *columns) for name, columns in (
        ("employees", EMPLOYEE_COLUMNS), ("projects", PROJECT_COLUMNS), ("assignments", ASSIGNMENT_COLUMNS), ("reviews", REVIEW_COLUMNS))}


def check(spark, given, least=0):
    silver = company(spark)
    frames = {kind: stored(spark.createDataFrame(some, SCHEMAS[kind]), kind) for kind, some in given.items() if some}
    handled = queue.handle(queue.Requests(**frames), silver, AS_OF)
    replay, want = Replay(silver), []
    order = sorted((r["seq"], kind, r.asDict()) for kind, df in frames.items() for r in df.collect())
    for seq, kind, r in order:
        reason = getattr(replay, "reviews_" if kind == "reviews" else kind)(r)
        want.append((kind, seq, reason is None, reason))
    got = {(r["kind"], r["seq"]): r for r in handled.messages().collect()}
    assert len(got) == len(want) == handled.messages().count()
    for kind, seq, accepted, reason in want:
        assert got[kind, seq].accepted == accepted, (kind, seq, reason, got[kind, seq].message)
        assert accepted or got[kind, seq].message == reason
    assert sum(w[2] for w in want) >= least
    result = tables(handled.silver)
    for name, rows_, columns in (("employees", replay.people, EMPLOYEE_COLUMNS), ("projects", replay.works, PROJECT_COLUMNS),
                                 ("assignments", replay.assigned, ASSIGNMENT_COLUMNS), ("reviews", replay.reviews, REVIEW_COLUMNS)):
        assert result[name] == sorted((tuple(r.get(c) for c in columns) for r in rows_.values()), key=repr), name
    return want


def hire(seq, email):
    return (seq, "Ann", "New", email, 1, "Rep", 3, day("2026-01-05"), 30, "Male", None, 900, None)


def test_hire_then_assign_review_and_delete(spark):
    given = {
        "hires": [hire(5, "n@x.com"), hire(20, "n@x.com"), hire(11, "n@x.com")],
        "assignments": [(4, 5, 1, "Dev", 50), (9, 5, 1, "Dev", 50), (10, 5, 2, "Dev", 60), (13, 5, 2, "Dev", 60)],
        "reviews": [(8, 5, 4, day("2026-01-02"), 3, Decimal(50), None, None, None), (15, 6, 4, day("2026-01-02"), 3, Decimal(50), None, None, None),
                    (21, 6, 4, day("2026-01-02"), 3, Decimal(50), None, None, None)],
        "projects": [(7, "More", 1, day("2026-01-01"), day("2026-02-01"), "Planned", Decimal(5))],
        "statuses": [(6, 4, "Active"), (14, 4, "Active"), (16, 4, "Active")],
        "departures": [(3, 5), (12, 5), (17, 5)],
        "employee_changes": [(2, 5, 2, "Lead", 4, 1, "No"), (6, 5, 2, "Lead", 4, 1, "No"), (18, 5, 2, "Lead", 4, 1, "No")],
    }
    want = {(kind, seq): ok for kind, seq, ok, _ in check(spark, given)}
    assert want["assignments", 9] and not want["assignments", 4] and not want["assignments", 10]
    assert want["hires", 20] and not want["hires", 11] and want["reviews", 21] and want["statuses", 14]


def test_addresses_that_are_used_again_and_again(spark):
    """Each hire waits for the deletion of the one before, whose id hangs on all hires before."""
    given = {"hires": [hire(1, "p1@x.com"), hire(3, "p1@x.com"), hire(4, "other@x.com"), hire(6, "p1@x.com"), hire(7, "p1@x.com"),
                       hire(9, "p1@x.com"), hire(12, "other@x.com")],
             "departures": [(2, 1), (5, 5), (8, 7), (10, 8), (11, 6)]}
    want = check(spark, given)
    assert sum(ok for kind, _, ok, _ in want if kind == "hires") >= 4


@pytest.mark.parametrize("seed", [1, 2])
def test_random_queues_equal_a_replay(spark, seed):
    check(spark, some_queue(seed, 120), least=20)


def test_one_kind_alone_and_nothing_accepted(spark):
    check(spark, {"departures": [(1, 1), (2, 1), (3, 77)]})
    check(spark, {"hires": [hire(1, "p1@x.com")], "statuses": [(2, 9, "Active")]})
