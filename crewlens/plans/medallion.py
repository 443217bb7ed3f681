"""The batch job: staging files to stored Bronze, Silver and Gold layers, in order, failing fast."""

from __future__ import annotations

import datetime
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crewlens.functions.text import fill
from crewlens.model import STAGING, Bronze, Gold, Silver
from crewlens.operators import changes, dims, quality, scale
from crewlens.operators.fact import fact_point_in_time
from crewlens.operators.kpi import refresh_summary, review_sums, yoy_of_sums
from crewlens.operators.scd2 import scd2_apply
from crewlens.operators.silver import (
    clean_departments,
    clean_employees,
    clean_projects,
    department_lookup,
    fk_filtered_assignments,
    fk_filtered_reviews,
)
from crewlens.plans.warehouse import Warehouse
from crewlens.session import tune
from crewlens.sources import landing
from crewlens.sources.store import Commit, LayerStore, Load, bucket_of, stored_bucket

log = logging.getLogger("crewlens")

BRONZE, SILVER, GOLD, JUDGED = "bronze", "silver", "gold", "judged"
# Tables kept in buckets of the employee, in Silver; in Gold, versions and fact are.
KEY = "employee_id"
BY_EMPLOYEE = ("employees", "assignments", "reviews")
SUMS = "review_sums"


def stored_bronze(store: LayerStore | Commit) -> Bronze:
    return Bronze(*[store.read(BRONZE, name) for name in STAGING])


def stored_silver(store: LayerStore | Commit, buckets: list[int] | None = None) -> Silver:
    """Silver; of the tables kept in buckets, those named."""
    return Silver(**{name: store.read(SILVER, name, buckets) for name in Silver.__dataclass_fields__})


def stored_gold(store: LayerStore | Commit) -> Gold | None:
    if not store.exists(GOLD):
        return None
    return Gold(**{name: store.read(GOLD, name) for name in Gold.__dataclass_fields__})


def find_employee(store: LayerStore | Commit, employee_id: int) -> DataFrame:
    """One person, or none, read from the one bucket that can hold them."""
    buckets = len(store.tables(SILVER)["employees"]["folders"])
    asked = store.spark.range(1).select(F.lit(employee_id).cast("bigint").alias(KEY))
    own = asked.select(bucket_of(KEY, buckets)).first()[0]
    return store.read(SILVER, "employees", [own]).filter(F.col(KEY) == employee_id).limit(1)


def store_bronze(store: LayerStore, bronze: Bronze) -> None:
    """Full refresh: all five staging tables become visible together."""
    put_bronze(store, lambda load: bronze)


def put_bronze(store: LayerStore, make: Callable[[Load], Bronze]) -> None:
    """The same for tables made with the load at hand; those that `make` has put are not put again."""
    with store.load(BRONZE) as load:
        for name, df in make(load).tables().items():
            if not load.has_put(name):
                load.put(name, df)


def load_bronze(store: LayerStore, folder: str) -> Bronze:
    """Full refresh from `<folder>/<table>.csv`, one file or folder per staging table."""
    store_bronze(store, landing.read_staging(store.spark, folder))
    return stored_bronze(store)


def load_silver(store: LayerStore, bronze: Bronze) -> Silver:
    """Rebuild Silver from Bronze; the old snapshot stays until the new one is checked and whole."""
    given = [t for t in ("department_ids", "departments") if store.exists(SILVER) and t in store.tables(SILVER)]
    existing = store.read(SILVER, given[0]) if given else None
    with store.load(SILVER) as load:
        departments = load.put("departments", clean_departments(bronze.employee, existing))
        # Every id ever given, also of departments without staff now.
        ids = departments if existing is None else existing.unionByName(departments).distinct()
        load.put("department_ids", ids)
        lookup = department_lookup(departments)
        employees = load.put_buckets("employees", clean_employees(bronze.employee, lookup), KEY)
        projects = load.put("projects", clean_projects(bronze.project, lookup))
        silver = Silver(
            departments=departments,
            employees=employees,
            projects=projects,
            assignments=load.put_buckets(
                "assignments", fk_filtered_assignments(bronze.assignment, employees, projects, from_store=True), KEY,
                dealt=True,
            ),
            reviews=load.put_buckets(
                "reviews", fk_filtered_reviews(bronze.review, employees, projects, from_store=True), KEY, dealt=True
            ),
        )
        # References hold by construction; keys and required values are up to the data.
        quality.enforce(quality.key_rules(silver))
    return silver


def _made_from(load: Load, whole: list[tuple[str, str]], by_bucket: list[tuple[str, str]]) -> dict:
    """The folders that a Gold table is made from: of whole tables, and of those in buckets."""
    def entry(layer: str, table: str) -> dict:
        return (load.tables() if layer == GOLD else load.commit.tables(layer)).get(table, {})

    folders = [entry(*table).get("folders") or [] for table in by_bucket]
    return {"whole": [entry(*table).get("folder") for table in whole], "buckets": [list(f) for f in zip(*folders)]}


def _outdated(load: Load, table: str, made_from: dict) -> list[int] | None:
    """Buckets of a stored Gold table that were made from other folders; None if all must be made."""
    seen = load.tables().get(table, {}).get("seen")
    now = made_from["buckets"]
    if not seen or seen["whole"] != made_from["whole"] or len(seen["buckets"]) != len(now):
        return None
    return [k for k, (old, new) in enumerate(zip(seen["buckets"], now)) if old != new]


def _put_versions(
    load: Load, old: Gold | None, silver: Silver, bronze: Bronze, dim_department: DataFrame
) -> DataFrame:
    """Versions of the employees in those buckets of Silver that changed since they were made."""
    history = bronze.employee_history
    made_from = _made_from(
        load, [(BRONZE, "stg_employee_history"), (SILVER, "departments")], [(SILVER, "employees")]
    )
    outdated = _outdated(load, "dim_employee", made_from) if old else None
    if outdated is None:
        # Version keys are made from the history id.
        quality.enforce(quality.history_key_rules(history))
        versions = scd2_apply(
            old and old.dim_employee, silver.employees, history, silver.departments, dim_department
        )
        return load.put_buckets("dim_employee", versions, KEY, seen=made_from)
    if not outdated:
        return old.dim_employee
    versions = scd2_apply(
        load.read("dim_employee", outdated),
        load.commit.read(SILVER, "employees", outdated),
        history.filter(bucket_of(KEY, len(made_from["buckets"])).isin(outdated)),
        silver.departments, dim_department, whole=old.dim_employee,
    )
    return load.put_buckets("dim_employee", versions, KEY, only=outdated, seen=made_from)


def load_gold(store: LayerStore | Commit, silver: Silver, bronze: Bronze) -> Gold:
    """Upsert the dimensions, add employee versions, link reviews. silver and bronze are the stored
    ones: versions and facts are made for the buckets of employees that changed since the last load.

    Facts of other buckets stand: they depend on their employees' reviews and versions, and on keys
    of projects, which stay.
    """
    old = stored_gold(store)
    with store.load(GOLD) as load:
        departments = load.put(
            "dim_department",
            dims.dim_department_upsert(old and old.dim_department, silver.departments),
        )
        projects = load.put(
            "dim_project",
            dims.dim_project_upsert(old and old.dim_project, silver.projects, departments),
        )
        employees = _put_versions(load, old, silver, bronze, departments)
        made_from = _made_from(load, [], [(SILVER, "reviews"), (GOLD, "dim_employee")])
        outdated = _outdated(load, "fact_performance_reviews", made_from) if old else None
        if outdated == []:
            return Gold(departments, projects, old.dim_date, employees, old.fact_performance_reviews)
        reviews, versions = silver.reviews, employees
        if outdated is not None:
            reviews = load.commit.read(SILVER, "reviews", outdated)
            versions = load.read("dim_employee", outdated)
        dates = load.put("dim_date", dims.dim_date(reviews, old and old.dim_date))
        fact = load.put_buckets(
            "fact_performance_reviews",
            fact_point_in_time(reviews, versions, projects, keep=(KEY,)),
            KEY, only=outdated, seen=made_from, drop_key=True, dealt=True,
        )
        # Sums of each bucket, made with it: yearly answers add them up and read no fact.
        made = load.read("fact_performance_reviews", outdated).withColumn("_bucket", stored_bucket())
        load.put_buckets(SUMS, review_sums(made, "_bucket"), "_bucket", only=outdated, drop_key=True, numbered=True)
    return Gold(departments, projects, dates, employees, fact)


def yoy_performance(store: LayerStore | Commit) -> DataFrame:
    """Year-over-year scores from the stored sums."""
    return yoy_of_sums(store.read(GOLD, SUMS), store.read(GOLD, "dim_department"))


def warehouse_refresh(store: LayerStore) -> tuple[bool, str]:
    """Rebuild Gold from the stored Silver; reports instead of raising."""
    try:
        gold = load_gold(store, stored_silver(store), stored_bronze(store))
        rows = {r["table_name"]: r["row_count"] for r in refresh_summary(gold).collect()}
    except Exception as error:  # reported to the caller, who decides
        return False, f"Refresh failed: {error}"
    log.info("gold rows: %s", rows)
    return True, "Warehouse refreshed."


def synthesize(
    spark: SparkSession,
    raw_csv: str,
    folder: str,
    target_rows: int = 100_000,
    history_share: float = 0.05,
    n_projects: int = 1000,
) -> dict[str, tuple[int, int]]:
    """Staging files of the wanted size from the raw HR file; returns (rows, columns) per table."""
    with LayerStore(spark, f"{folder}/_work").load("synthetic") as work:
        raw = work.put("raw", landing.raw_hr_ingest(spark, raw_csv, keep=("employee_number",)))
        rows = scale.jitter_and_cap(scale.upsample_rows(raw, target_rows, "employee_number"))
        hired = work.put(
            "hired", scale.derive_email_hire(scale.with_names(rows)).drop("is_extra")
        )
        sampled = work.put("sampled", scale.sample_history(hired, history_share))
        projects = work.put("projects", scale.make_projects(spark, n_projects, raw))
        assignments = work.put("assignments", scale.make_assignments(hired, projects))
    tables = {
        "stg_employee": scale.inject_noise(scale.with_last_change(hired, sampled)),
        "stg_employee_history": scale.prior_version(hired, sampled, raw),
        "stg_project": projects,
        "stg_assignment": assignments,
        "stg_review": scale.make_reviews(hired, assignments),
    }
    landing.write_staging(tables, folder)
    return landing.shapes(landing.read_staging(spark, folder).tables())


def run(
    spark: SparkSession,
    raw_csv: str,
    folder: str,
    root: str,
    target_rows: int = 100_000,
    history_share: float = 0.05,
    n_projects: int = 1000,
) -> Warehouse:
    """Everything in order: scale up, load Bronze, Silver, Gold. Any failure ends the job."""
    tune(spark)
    store = LayerStore(spark, root)
    sizes = synthesize(spark, raw_csv, folder, target_rows, history_share, n_projects)
    log.info("staged %s", sizes)
    bronze = load_bronze(store, folder)
    silver = load_silver(store, bronze)
    return Warehouse(silver, load_gold(store, silver, bronze))


def _put_changes(load: Load, outcome: changes.Outcome, requests: DataFrame) -> None:
    """Store the Silver tables that accepted requests change: of those kept by employee, the buckets
    of the employees that the requests name."""
    accepted, buckets = requests.filter("accepted"), None
    kept = load.tables()
    if KEY in requests.columns:
        number = bucket_of(KEY, len(kept["employees"]["folders"]))
        buckets = [r[0] for r in accepted.select(number).distinct().collect()]  # one per bucket
    if buckets == [] or accepted.isEmpty():
        return
    silver = stored_silver(load.commit, buckets)
    for table, df in outcome.change(silver, requests).tables().items():
        if df is not silver.tables()[table]:
            if table in BY_EMPLOYEE:
                load.put_buckets(table, df, KEY, only=buckets, dealt=True)
            else:
                load.put(table, df)


def _apply(
    store: LayerStore,
    name: str,
    judge: Callable[[Silver], changes.Outcome],
    batch: str | None,
    sync: Callable[[Commit], None] | None = None,
    failed: str = "",
) -> DataFrame:
    """Judge a batch; store the judged requests, the Silver tables they change and the Gold tables
    that follow in one commit. A batch that was answered before gets that answer.

    Where Gold cannot follow, the change is kept without it: the accepted requests say so, and a
    later refresh catches up.
    """
    answer = store.answer(batch) if batch is not None else None
    if answer is None:
        note = None
        with store.commit(batch) as commit:
            outcome = judge(stored_silver(commit))
            with commit.load(JUDGED) as load:
                requests = load.put(name, outcome.requests)
            with commit.load(SILVER) as load:
                _put_changes(load, outcome, requests)
            if sync is not None:
                try:
                    sync(commit)
                except Exception as error:  # reported to the caller, as the change itself is saved
                    log.exception("sync failed")
                    note = {"failed": failed, "error": str(error)}
            commit.answers(JUDGED, name, note)
    else:
        requests, note = store.spark.read.parquet(f"{store.root}/{answer['folder']}"), answer["note"]
    if note is None:
        return requests
    said = F.concat(fill(note["failed"]), F.lit(f" {note['error']}"))
    return requests.withColumn("message", F.when(F.col("accepted"), said).otherwise(F.col("message")))


def sync_employees(store: LayerStore | Commit) -> None:
    """Bring employee versions up to date; projects, dates and fact wait for a refresh."""
    silver, bronze, old = stored_silver(store), stored_bronze(store), stored_gold(store)
    if old is None:
        load_gold(store, silver, bronze)
        return
    with store.load(GOLD) as load:
        _put_versions(load, old, silver, bronze, old.dim_department)


def sync_projects(store: LayerStore | Commit) -> None:
    """Bring the project dimension up to date; nothing else depends on a status."""
    silver, old = stored_silver(store), stored_gold(store)
    if old is None:
        load_gold(store, silver, stored_bronze(store))
        return
    with store.load(GOLD) as load:
        load.put(
            "dim_project",
            dims.dim_project_upsert(old.dim_project, silver.projects, old.dim_department),
        )


def change_employees(
    store: LayerStore, requests: DataFrame, as_of: datetime.date, batch: str | None = None
) -> DataFrame:
    """Apply employee changes and sync Gold. Returns the judged requests."""
    return _apply(
        store, "employee_changes", lambda silver: changes.apply_employee_changes(requests, silver, as_of),
        batch, sync_employees, changes.SYNC_FAILED,
    )


def hire_employees(
    store: LayerStore, requests: DataFrame, as_of: datetime.date, batch: str | None = None
) -> DataFrame:
    return _apply(
        store, "new_employees", lambda silver: changes.add_employees(requests, silver, as_of),
        batch, sync_employees, changes.HIRE_SYNC_FAILED,
    )


def change_project_status(
    store: LayerStore, requests: DataFrame, batch: str | None = None
) -> DataFrame:
    return _apply(
        store, "project_status", lambda silver: changes.update_project_status(requests, silver),
        batch, sync_projects, changes.STATUS_SYNC_FAILED,
    )


def open_projects(store: LayerStore, requests: DataFrame, batch: str | None = None) -> DataFrame:
    return _apply(store, "new_projects", lambda silver: changes.add_projects(requests, silver), batch)


def record_reviews(
    store: LayerStore, requests: DataFrame, as_of: datetime.date, batch: str | None = None
) -> DataFrame:
    return _apply(
        store, "new_reviews", lambda silver: changes.add_reviews(requests, silver, as_of), batch
    )


def staff_projects(
    store: LayerStore, requests: DataFrame, as_of: datetime.date, batch: str | None = None
) -> DataFrame:
    return _apply(
        store, "new_assignments", lambda silver: changes.assign_employees(requests, silver, as_of), batch
    )


def remove_employees(store: LayerStore, requests: DataFrame, batch: str | None = None) -> DataFrame:
    return _apply(
        store, "departures", lambda silver: changes.delete_employees(requests, silver), batch
    )
