"""One queue of requests of all kinds, judged together with the outcome of handling them in turn.

`seq` is the place in the queue over all kinds. A request sees what earlier ones did: somebody hired
at 5 can be assigned at 9, and is gone after a deletion at 12. Employee and project ids are never
given twice, so all that one kind has to know of another is when an id comes into being and when it
goes. With these two moments each kind is judged as a whole, by the rules it has on its own.

Only hires wait for deletions, as a deletion frees the e-mail address, and deletions of new staff wait
for hires, as these give ids. The two are settled by turns: with the ids of a turn the deletions are
found, with these the hires. A turn confirms all hires up to the first that the turn before had
wrong, and nothing changes after the last; turns follow from re-used addresses alone, and are few.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewlens.functions.text import strip
from crewlens.model import EMPLOYEE_COLUMNS, PROJECT_COLUMNS, Silver
from crewlens.operators import changes
from crewlens.operators.lookups import own_exchange
from crewlens.operators.numbering import max_key, number_rows
from crewlens.session import stored


@dataclass(frozen=True)
class Requests:
    """Requests by kind, each with its columns as in `changes`; None for a kind without any."""

    hires: DataFrame | None = None
    projects: DataFrame | None = None
    reviews: DataFrame | None = None
    employee_changes: DataFrame | None = None
    statuses: DataFrame | None = None
    assignments: DataFrame | None = None
    departures: DataFrame | None = None


@dataclass(frozen=True)
class Handled:
    """Judged requests of each kind, and Silver after all of them."""

    judged: dict[str, DataFrame]
    silver: Silver

    def messages(self) -> DataFrame:
        """kind, seq, accepted, message of every request."""
        rows = [df.select(F.lit(kind).alias("kind"), F.col("seq").cast("bigint").alias("seq"), "accepted", "message")
                for kind, df in self.judged.items()]
        out = rows[0]
        for more in rows[1:]:
            out = out.unionByName(more)
        return out


def _deaths(lives: DataFrame, departures: DataFrame | None) -> DataFrame:
    """lives: employee_id, born. Adds died: the first request to delete the id after that, or null."""
    if departures is None:
        return lives.withColumn("died", F.lit(None).cast("bigint"))
    asked = departures.select("employee_id", F.col("seq").cast("bigint").alias("seq"))
    later = asked.join(own_exchange(lives, "employee_id"), "employee_id").filter(F.col("seq") > F.col("born"))
    died = later.groupBy("employee_id").agg(F.min("seq").alias("died"))
    return lives.join(died, "employee_id", "left")


def _in_turn(fitting: DataFrame, taken: DataFrame, deaths: DataFrame) -> DataFrame:
    """email, seq of the hires that go through. fitting: email, seq of those that nothing but a taken
    address stops; taken: email, died of stored staff; deaths: seq, died of hires, as far as known.

    Per address the first one after its last holder has gone, again and again."""
    never = F.lit(2**62)
    free = fitting.select("email").distinct().join(taken, "email", "left").select(
        "email", F.when(F.col("held"), F.coalesce("died", never)).otherwise(F.lit(-1).cast("bigint")).alias("from"))
    found, free = None, stored(free, "free")
    while True:
        holders = fitting.join(own_exchange(free, "email"), "email").filter(F.col("seq") > F.col("from")).groupBy("email").agg(
            F.min("seq").alias("seq"))
        holders = stored(holders, "holders")
        found = holders if found is None else found.unionByName(holders)
        free = stored(holders.join(deaths, "seq").filter("died IS NOT NULL").select("email", F.col("died").alias("from")), "free")
        if free.isEmpty():
            return found


def _settled_hires(requests: DataFrame, silver: Silver, departures: DataFrame | None, as_of: datetime.date) -> DataFrame:
    """The hires, judged: seq, the columns of an employee, accepted, message."""
    # Without a taken address: the rules of a record and of its department.
    nobody = silver.employees.limit(0)
    alone = requests.withColumn("_email", F.col("email")).withColumn(
        "email", F.concat(F.col("seq").cast("string"), F.lit("."), F.col("email")))
    rules = changes.add_employees(alone.drop("_email"), replace(silver, employees=nobody), as_of).requests
    fits = rules.filter("accepted").select("seq")
    fitting = stored(requests.join(fits, "seq", "left_semi").select(
        F.col("seq").cast("bigint").alias("seq"), F.lower(strip(F.col("email"))).alias("email")), "fitting")
    stored_lives = silver.employees.select("employee_id", F.lit(-1).cast("bigint").alias("born"), F.lower("email").alias("email"))
    taken = stored(_deaths(stored_lives, departures).groupBy("email").agg(
        F.lit(True).alias("held"), F.when(F.count_if(F.col("died").isNull()) == 0, F.max("died")).alias("died")), "taken")
    last_id = max_key(silver.employees, "employee_id")
    deaths = silver.employees.sparkSession.createDataFrame([], "seq bigint, died bigint")
    before = None
    while True:
        accepted = stored(_in_turn(fitting, taken, deaths), "accepted")
        if before is not None and before.exceptAll(accepted).isEmpty() and accepted.exceptAll(before).isEmpty():
            break
        numbered = number_rows(accepted, "employee_id", ["seq"], start=last_id)
        lives = numbered.select("employee_id", F.col("seq").alias("born"))
        deaths = stored(_deaths(lives, departures).select(F.col("born").alias("seq"), "died"), "deaths")
        before = accepted
    # Judged once more as a batch, in which an accepted address meets no other request.
    own = accepted.select("seq", F.lit(True).alias("_own"))
    cleared = requests.join(own, "seq", "left")
    going = changes.add_employees(cleared.filter("_own").drop("_own"), replace(silver, employees=nobody), as_of)
    return _hired(going.requests, cleared.filter("_own IS NULL").drop("_own"), silver, as_of, last_id)


def _hired(going, refused: DataFrame, silver: Silver, as_of: datetime.date, last_id) -> DataFrame:
    numbered = number_rows(going.drop("employee_id"), "employee_id", ["seq"], start=last_id)
    success = changes.fill("Employee {employee_id} ({first_name} {last_name}) added.")
    accepted = numbered.withColumn("accepted", F.lit(True)).withColumn("message", success)
    judged = changes.add_employees(refused, replace(silver, departments=silver.departments.limit(0)), as_of).requests
    return accepted.unionByName(judged.select(*accepted.columns))


def _split(requests: DataFrame, lives: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Requests whose id is there when they come, and the others."""
    times = own_exchange(lives.select(key, "born", "died", F.lit(True).alias("_known")), key)
    seq = F.col("seq")
    there = F.coalesce(F.col("_known") & (seq > F.col("born")) & (F.col("died").isNull() | (seq < F.col("died"))), F.lit(False))
    marked = stored(requests.join(times, key, "left").withColumn("_there", there).drop("born", "died", "_known"), "split")
    return marked.filter("_there").drop("_there"), marked.filter("NOT _there").drop("_there")


def _without(requests: DataFrame, lives: DataFrame, key: str) -> DataFrame:
    """The requests, with no id where it is not there when they come."""
    there, other = _split(requests, lives, key)
    return there.unionByName(other.withColumn(key, F.lit(None).cast("bigint")))


def _with_ids(judged: DataFrame, requests: DataFrame, keys: list[str]) -> DataFrame:
    """The ids as they were asked for."""
    given = requests.select(F.col("seq").cast("bigint").alias("seq"), *keys)
    return judged.drop(*keys).join(given, "seq").select(*judged.columns)


def handle(requests: Requests, silver: Silver, as_of: datetime.date) -> Handled:
    """Judge all requests and work out Silver. Requests and Silver should be stored ones."""
    judged: dict[str, DataFrame] = {}
    always = F.lit(-1).cast("bigint")
    lives = silver.employees.select("employee_id", always.alias("born"))
    after = replace(silver, employees=silver.employees.select(*EMPLOYEE_COLUMNS), projects=silver.projects.select(*PROJECT_COLUMNS))
    if requests.hires is not None:
        judged["hires"] = stored(_settled_hires(requests.hires, silver, requests.departures, as_of), "hires")
        hired = judged["hires"].filter("accepted")
        lives = lives.unionByName(hired.select("employee_id", F.col("seq").cast("bigint").alias("born")))
        after = replace(after, employees=after.employees.unionByName(hired.select(*EMPLOYEE_COLUMNS)))
    people = stored(_deaths(lives, requests.departures), "lives")
    works = silver.projects.select("project_id", always.alias("born"))
    if requests.projects is not None:
        outcome = changes.add_projects(requests.projects, silver)
        judged["projects"] = stored(outcome.requests, "projects")
        opened = judged["projects"].filter("accepted")
        works = works.unionByName(opened.select("project_id", F.col("seq").cast("bigint").alias("born")))
        after = outcome.change(after, judged["projects"])
    works = stored(works.withColumn("died", F.lit(None).cast("bigint")), "works")
    after = replace(after, employees=stored(after.employees, "employees"), projects=stored(after.projects, "projects"))
    # From here on every table holds all ids that there ever are in the queue.
    everyone = after

    def apart(kind: str, wanted: DataFrame, key: str, times: DataFrame, judge, table: str) -> None:
        """Requests for ids that are there, and for others: these find the table empty."""
        nonlocal after
        there, other = _split(wanted, times, key)
        outcome = judge(there, everyone)
        none = judge(other, replace(everyone, **{table: getattr(everyone, table).limit(0)}))
        judged[kind] = stored(outcome.requests.unionByName(none.requests.select(*outcome.requests.columns)), kind)
        after = outcome.change(after, judged[kind])

    if requests.employee_changes is not None:
        apart("employee_changes", requests.employee_changes, "employee_id", people,
              lambda rows, tables: changes.apply_employee_changes(rows, tables, as_of), "employees")
    if requests.statuses is not None:
        apart("statuses", requests.statuses, "project_id", works, changes.update_project_status, "projects")
    for kind, wanted, judge in (
        ("assignments", requests.assignments, lambda rows: changes.assign_employees(rows, everyone, as_of)),
        ("reviews", requests.reviews, lambda rows: changes.add_reviews(rows, everyone, as_of)),
    ):
        if wanted is not None:
            there = _without(_without(wanted, people, "employee_id"), works, "project_id")
            outcome = judge(there)
            judged[kind] = stored(_with_ids(outcome.requests, wanted, ["employee_id", "project_id"]), kind)
            after = outcome.change(after, judged[kind])
    if requests.departures is not None:
        # The first request after an id came into being; no later one finds it.
        born = own_exchange(people.select("employee_id", "born"), "employee_id")
        wanted = requests.departures.join(born, "employee_id", "left")
        known = F.coalesce(F.col("seq") > F.col("born"), F.lit(False))
        marked = stored(wanted.withColumn("_there", known).drop("born"), "split")
        outcome = changes.delete_employees(marked.filter("_there").drop("_there"), everyone)
        none = changes.delete_employees(marked.filter("NOT _there").drop("_there"), replace(everyone, employees=everyone.employees.limit(0)))
        judged["departures"] = stored(outcome.requests.unionByName(none.requests), "departures")
        after = outcome.change(after, judged["departures"])
    return Handled(judged, after)
