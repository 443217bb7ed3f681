
from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crewlens.model import Bronze, Gold, Silver
from crewlens.operators import changes, dims, kpi, quality, roster, scale, scd2, silver
from crewlens.operators.fact import build_gold
from crewlens.operators.fact import fact_point_in_time as link_reviews
from crewlens.plans import medallion
from crewlens.plans.warehouse import Warehouse
from crewlens.session import scratch_path, tune
from crewlens.sources import landing, records, testdata
from crewlens.sources.store import LayerStore
from oracle.sql import QUERIES as ORACLE

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint, decimals as double, dates as text: the types both engines share."""
    columns = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, T.DateType):
            c = c.cast("string")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def register(function: Query) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(function(tune(spark), sf_dir))

    _REGISTRY[function.__name__] = query
    return function


class Layers:
    """Bronze, Silver and Gold of one data folder, each loaded once per session into the shared
    folder when a query first needs it. Queries then compute their operator from the stored layer
    below it, as a dashboard or job does."""

    _known: dict[tuple, Layers] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.store = LayerStore(spark, scratch_path(spark, "layers"))

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Layers:
        key = (spark.sparkContext.applicationId, sf_dir, landing.last_change(spark, sf_dir))
        if key not in cls._known:
            cls._known[key] = cls(spark, sf_dir)
        return cls._known[key]

    @classmethod
    def forget(cls) -> None:
        """Load anew at the next use (old files stay until the shared folder is cleaned)."""
        cls._known.clear()

    @cached_property
    def bronze(self) -> Bronze:
        def make(load):
            # Assignments are made from the stored reviews.
            reviews = load.put("stg_review", testdata.stg_review(self.spark, self.sf_dir, dealt=True))
            return testdata.bronze(self.spark, self.sf_dir, reviews)

        medallion.put_bronze(self.store, make)
        return medallion.stored_bronze(self.store)

    @cached_property
    def silver(self) -> Silver:
        return medallion.load_silver(self.store, self.bronze)

    @cached_property
    def gold(self) -> Gold:
        return medallion.load_gold(self.store, self.silver, self.bronze)

    @cached_property
    def warehouse(self) -> Warehouse:
        return Warehouse(self.silver, self.gold)

    @cached_property
    def changed(self) -> LayerStore:
        """A branch on which batches of changes, reviews and departures were applied, and Gold was
        refreshed where they touched it."""
        assert self.gold  # loaded before the branch starts
        branch, (spark, sf_dir) = self.store.branch("changed"), (self.spark, self.sf_dir)
        requests = testdata.employee_changes(spark, sf_dir)
        medallion.change_employees(branch, requests, testdata.AS_OF, "changes")
        medallion.record_reviews(branch, testdata.new_reviews(self.bronze.review), testdata.AS_OF, "reviews")
        medallion.remove_employees(branch, testdata.departures(spark, sf_dir), "departures")
        done, message = medallion.warehouse_refresh(branch)
        if not done:
            raise RuntimeError(message)
        return branch

    def scaled(self, name: str, df: Callable[[], DataFrame]) -> DataFrame:
        """A step of the scale-up that later steps go on from, stored like the job stores it."""
        if name not in self.store.tables("scaled"):
            wanted = df()
            with self.store.load("scaled") as load:
                load.put(name, wanted)
        return self.store.read("scaled", name)


def _bronze(spark, sf_dir) -> Bronze:
    return Layers.of(spark, sf_dir).bronze


def _silver(spark, sf_dir) -> Silver:
    return Layers.of(spark, sf_dir).silver


def _warehouse(spark, sf_dir) -> Warehouse:
    return Layers.of(spark, sf_dir).warehouse


# -- A: loading --------------------------------------------------------------------------------


@register
def bronze_load(spark, sf_dir):
    folder = scratch_path(spark, "staging")
    landing.write_staging(_bronze(spark, sf_dir).tables(), folder)
    return landing.row_counts(landing.read_staging(spark, folder).tables())


@register
def raw_hr_ingest(spark, sf_dir):
    path = scratch_path(spark, "raw_hr") + ".csv"
    testdata.raw_hr(spark, sf_dir).write.option("header", True).csv(path)
    return landing.raw_hr_ingest(spark, path)


@register
def warehouse_refresh(spark, sf_dir):
    return kpi.refresh_summary(build_gold(_silver(spark, sf_dir), _bronze(spark, sf_dir)))


@register
def csv_round_trip(spark, sf_dir):
    """Texts with quotes and line ends inside, written as CSV and read back in blocks."""
    path = scratch_path(spark, "texts") + ".csv"
    texts = testdata.table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    texts.write.options(**records.CSV).csv(path)
    back = records.read_csv(spark, path, texts.schema)
    return back.select("doc_id", "source", F.md5(F.col("text").cast("binary")).alias("text_md5"),
                       F.length("text").alias("n_chars"))


@register
def load_times(spark, sf_dir):
    """Staged rows without a load time, and whether there are several load times, per table."""
    folder = scratch_path(spark, "staging")
    landing.write_staging(_bronze(spark, sf_dir).tables(), folder)
    tables = landing.read_staging(spark, folder).tables()
    moment = F.col("_loaded_at")
    return reduce(DataFrame.unionByName, [
        df.agg(F.count_if(moment.isNull()).alias("without"), (F.count_distinct(moment) > 1).alias("several")).select(
            F.lit(name).alias("table_name"), "without", "several")
        for name, df in tables.items()])


# -- B: cleaning -------------------------------------------------------------------------------


@register
def clean_departments(spark, sf_dir):
    return silver.clean_departments(_bronze(spark, sf_dir).employee)


@register
def latest_employee(spark, sf_dir):
    return silver.latest_employee(_bronze(spark, sf_dir).employee)


@register
def clean_employees(spark, sf_dir):
    lookup = silver.department_lookup(_silver(spark, sf_dir).departments)
    return silver.clean_employees(_bronze(spark, sf_dir).employee, lookup)


@register
def clean_projects(spark, sf_dir):
    lookup = silver.department_lookup(_silver(spark, sf_dir).departments)
    return silver.clean_projects(_bronze(spark, sf_dir).project, lookup)


@register
def dim_date(spark, sf_dir):
    return dims.dim_date(_silver(spark, sf_dir).reviews)


@register
def valid_history(spark, sf_dir):
    return scd2.valid_history(_bronze(spark, sf_dir).employee_history).drop("_loaded_at")


@register
def history_timeline(spark, sf_dir):
    return roster.history_timeline(_warehouse(spark, sf_dir).employee_history(), testdata.AS_OF)


# -- C: joins ----------------------------------------------------------------------------------


@register
def fact_point_in_time(spark, sf_dir):
    w = _warehouse(spark, sf_dir)
    return link_reviews(w.silver.reviews, w.gold.dim_employee, w.gold.dim_project)


@register
def fk_filtered_assignments(spark, sf_dir):
    s = _silver(spark, sf_dir)
    return silver.fk_filtered_assignments(_bronze(spark, sf_dir).assignment, s.employees, s.projects, from_store=True)


@register
def fk_filtered_reviews(spark, sf_dir):
    s = _silver(spark, sf_dir)
    return silver.fk_filtered_reviews(_bronze(spark, sf_dir).review, s.employees, s.projects, from_store=True)


@register
def employee_projects(spark, sf_dir):
    return roster.employee_projects(_silver(spark, sf_dir))


# -- D: aggregations ---------------------------------------------------------------------------


@register
def kpi_card(spark, sf_dir):
    return _warehouse(spark, sf_dir).kpi_card()


@register
def overallocated_employees(spark, sf_dir):
    return kpi.overallocated_employees(_silver(spark, sf_dir).assignments)


@register
def yoy_overall(spark, sf_dir):
    return _warehouse(spark, sf_dir).yoy_overall()


@register
def attrition_performance(spark, sf_dir):
    return _warehouse(spark, sf_dir).performance


@register
def attrition_by_department(spark, sf_dir):
    return _warehouse(spark, sf_dir).attrition_by_department()


@register
def project_workload(spark, sf_dir):
    return _warehouse(spark, sf_dir).workload


@register
def project_status_counts(spark, sf_dir):
    return _warehouse(spark, sf_dir).project_status_counts()


@register
def project_bottlenecks(spark, sf_dir):
    return _warehouse(spark, sf_dir).project_bottlenecks()


@register
def flagged_projects(spark, sf_dir):
    return kpi.flagged_projects(_warehouse(spark, sf_dir).project_bottlenecks())


@register
def bottleneck_points(spark, sf_dir):
    return kpi.bottleneck_points(_warehouse(spark, sf_dir).project_bottlenecks())


@register
def risk_level_counts(spark, sf_dir):
    return _warehouse(spark, sf_dir).risk_level_counts(50)


@register
def flag_counts(spark, sf_dir):
    return _warehouse(spark, sf_dir).flag_counts()


@register
def years(spark, sf_dir):
    return _warehouse(spark, sf_dir).years()


@register
def department_names(spark, sf_dir):
    return _warehouse(spark, sf_dir).department_names()


@register
def departments(spark, sf_dir):
    return roster.departments(_silver(spark, sf_dir))


@register
def dept_roles(spark, sf_dir):
    return scale.dept_roles(_bronze(spark, sf_dir).employee).select(
        "department", F.concat_ws(",", "roles").alias("roles")
    )


# -- E: windows --------------------------------------------------------------------------------


@register
def yoy_performance(spark, sf_dir):
    """From the raw tables to the answer; of what lies between, only department names and numbered
    rows are stored."""
    return Warehouse.derive(testdata.bronze(spark, sf_dir)).yoy_performance()


@register
def yoy_stored(spark, sf_dir):
    """The same question asked of the stored star schema."""
    return _warehouse(spark, sf_dir).yoy_performance()


@register
def top_employees(spark, sf_dir):
    return _warehouse(spark, sf_dir).top_employees()


# -- F: versions and upserts -------------------------------------------------------------------


def _second_load(spark, sf_dir):
    """Versions after the first load, and what the sources describe at the second."""
    w = _warehouse(spark, sf_dir)
    employees = testdata.changed_snapshot(w.silver.employees)
    history = _bronze(spark, sf_dir).employee_history
    return w.gold.dim_employee, (employees, history, w.silver.departments, w.gold.dim_department)


@register
def scd2_incoming(spark, sf_dir):
    _, sources = _second_load(spark, sf_dir)
    return scd2.scd2_incoming(*sources).drop("_source")


@register
def scd2_close(spark, sf_dir):
    versions, sources = _second_load(spark, sf_dir)
    return scd2.scd2_close(versions, scd2.scd2_incoming(*sources))


@register
def scd2_insert(spark, sf_dir):
    versions, sources = _second_load(spark, sf_dir)
    incoming = scd2.scd2_incoming(*sources)
    return scd2.scd2_insert(scd2.scd2_close(versions, incoming), incoming)


@register
def scd2_apply(spark, sf_dir):
    versions, sources = _second_load(spark, sf_dir)
    return scd2.scd2_apply(versions, *sources)


@register
def dim_department_upsert(spark, sf_dir):
    """Known: the departments a project of 1994 belongs to, upper-cased; incoming: all."""
    s = _silver(spark, sf_dir)
    early = s.projects.filter(F.col("planned_end_date") < "1994-06-01").select("department_id")
    before = s.departments.join(early, "department_id", "left_semi").withColumn(
        "department_name", F.upper("department_name")
    )
    return dims.dim_department_upsert(dims.dim_department_upsert(None, before), s.departments)


@register
def dim_project_upsert(spark, sf_dir):
    """Known: the projects planned to end before 1996, all Planned; incoming: those not Completed."""
    w = _warehouse(spark, sf_dir)
    projects, departments = w.silver.projects, w.gold.dim_department
    before = projects.filter(F.col("planned_end_date") < "1996-01-01").withColumn(
        "status", F.lit("Planned")
    )
    known = dims.dim_project_upsert(None, before, departments)
    return dims.dim_project_upsert(
        known, projects.filter(F.col("status") != "Completed"), departments
    )


@register
def dim_date_upsert(spark, sf_dir):
    """Known: the days of the reviews rated 1; a second load brings all the others."""
    reviews = _silver(spark, sf_dir).reviews
    known = dims.dim_date(reviews.filter("performance_rating = 1"))
    return dims.dim_date(reviews.filter("performance_rating > 1"), known)


@register
def silver_reload(spark, sf_dir):
    """Departments after a second full load: they keep their ids."""
    layers = Layers.of(spark, sf_dir)
    assert layers.silver
    branch = layers.store.branch(f"reload-{uuid.uuid4().hex}")
    return medallion.load_silver(branch, layers.bronze).departments


@register
def refreshed_versions(spark, sf_dir):
    """Employee versions after a batch of changes and one of departures, made bucket by bucket."""
    return medallion.stored_gold(Layers.of(spark, sf_dir).changed).dim_employee


@register
def refreshed_fact(spark, sf_dir):
    """Facts after batches of changes, reviews and departures, linked anew where these touched them."""
    return medallion.stored_gold(Layers.of(spark, sf_dir).changed).fact_performance_reviews


@register
def yoy_refreshed(spark, sf_dir):
    """Year over year after the refresh, from sums of which only touched buckets were made again."""
    return medallion.yoy_performance(Layers.of(spark, sf_dir).changed)


# -- G: lists ----------------------------------------------------------------------------------


@register
def attrition_risk(spark, sf_dir):
    return _warehouse(spark, sf_dir).attrition_risk()


@register
def list_employees(spark, sf_dir):
    return roster.list_employees(_silver(spark, sf_dir), search="CA.")


@register
def list_projects(spark, sf_dir):
    return roster.list_projects(_silver(spark, sf_dir), search="Ring")


@register
def list_assignments(spark, sf_dir):
    return roster.list_assignments(_silver(spark, sf_dir))


@register
def list_reviews(spark, sf_dir):
    return roster.list_reviews(_silver(spark, sf_dir))


@register
def employee_history(spark, sf_dir):
    return _warehouse(spark, sf_dir).employee_history()


# -- the same questions with arguments ---------------------------------------------------------

EMPLOYEE, PROJECT = 43, 42


@register
def employee_by_id(spark, sf_dir):
    """One person, read from one bucket of the stored table."""
    assert _silver(spark, sf_dir)
    return medallion.find_employee(Layers.of(spark, sf_dir).store, EMPLOYEE)


@register
def gold_rules(spark, sf_dir):
    return quality.gold_rules(_warehouse(spark, sf_dir).gold)


@register
def project_statuses(spark, sf_dir):
    return roster.statuses(_silver(spark, sf_dir))


@register
def manual_accounts(spark, sf_dir):
    """Requests made from the account requests: an odd role for some, no password for others."""
    requests = testdata.account_requests(spark, sf_dir).select(
        "seq", F.col("email").alias("username"),
        F.expr("CASE WHEN seq % 7 = 0 THEN 0 ELSE 12 END").alias("password_length"),
        F.expr("CASE WHEN seq % 5 = 0 THEN 'Owner' WHEN seq % 2 = 0 THEN 'Admin' ELSE 'Viewer' END").alias("role"))
    return changes.manual_accounts(requests, testdata.existing_accounts(spark, sf_dir))


@register
def yoy_of_department(spark, sf_dir):
    return _warehouse(spark, sf_dir).yoy_performance("EUROPE")


@register
def top_of_department_and_year(spark, sf_dir):
    return _warehouse(spark, sf_dir).top_employees(year=1995, department="asia", top_n=3)


@register
def list_projects_by_id(spark, sf_dir):
    return roster.list_projects(_silver(spark, sf_dir), search=str(PROJECT))


@register
def list_projects_of_employee(spark, sf_dir):
    return roster.list_projects(_silver(spark, sf_dir), employee_id=EMPLOYEE)


@register
def projects_of_employee(spark, sf_dir):
    return roster.employee_projects(_silver(spark, sf_dir), EMPLOYEE)


@register
def assignments_of_project(spark, sf_dir):
    return roster.list_assignments(_silver(spark, sf_dir), project_id=PROJECT)


@register
def reviews_of_employee(spark, sf_dir):
    return roster.list_reviews(_silver(spark, sf_dir), employee_id=EMPLOYEE)


@register
def history_of_employee(spark, sf_dir):
    return _warehouse(spark, sf_dir).employee_history(EMPLOYEE)


@register
def staged_by_parameter(spark, sf_dir):
    """A question in SQL with named parameters."""
    return landing.read(
        spark, "SELECT * FROM {projects} WHERE budget > :least AND status = :status",
        {"projects": _silver(spark, sf_dir).projects}, least=950000, status="Active")


# -- W: change requests ------------------------------------------------------------------------


@register
def validate_employees(spark, sf_dir):
    requests = testdata.new_employees(spark, sf_dir)
    return changes.validate_employees(requests, testdata.AS_OF).select("seq", "reason")


@register
def validate_projects(spark, sf_dir):
    return changes.validate_projects(testdata.new_projects(spark, sf_dir)).select("seq", "reason")


@register
def validate_reviews(spark, sf_dir):
    requests = testdata.new_reviews(_bronze(spark, sf_dir).review)
    return changes.validate_reviews(requests, testdata.AS_OF).select("seq", "reason")


@register
def add_employees(spark, sf_dir):
    requests = testdata.new_employees(spark, sf_dir)
    snapshot = _silver(spark, sf_dir)
    return changes.add_employees(requests, snapshot, testdata.AS_OF).requests


@register
def add_projects(spark, sf_dir):
    requests = testdata.new_projects(spark, sf_dir)
    return changes.add_projects(requests, _silver(spark, sf_dir)).requests


@register
def add_reviews(spark, sf_dir):
    snapshot = _silver(spark, sf_dir)
    requests = testdata.new_reviews(_bronze(spark, sf_dir).review)
    return changes.add_reviews(requests, snapshot, testdata.AS_OF).requests.select(
        "seq", "review_id", "accepted", "message"
    )


@register
def apply_employee_changes(spark, sf_dir):
    requests = testdata.employee_changes(spark, sf_dir)
    snapshot = _silver(spark, sf_dir)
    return changes.apply_employee_changes(requests, snapshot, testdata.AS_OF).requests


@register
def changed_employees(spark, sf_dir):
    """The employee table after the accepted changes."""
    requests = testdata.employee_changes(spark, sf_dir)
    snapshot = _silver(spark, sf_dir)
    return changes.apply_employee_changes(requests, snapshot, testdata.AS_OF).silver.employees


@register
def update_project_status(spark, sf_dir):
    requests = testdata.status_changes(_bronze(spark, sf_dir).review)
    return changes.update_project_status(requests, _silver(spark, sf_dir)).requests


@register
def assign_employees(spark, sf_dir):
    requests = testdata.assignment_requests(_bronze(spark, sf_dir).review)
    snapshot = _silver(spark, sf_dir)
    return changes.assign_employees(requests, snapshot, testdata.AS_OF).requests


@register
def delete_employees(spark, sf_dir):
    snapshot = _silver(spark, sf_dir)
    return changes.delete_employees(testdata.departures(spark, sf_dir), snapshot).requests


@register
def remaining_rows(spark, sf_dir):
    """Rows of the Silver tables after the departures."""
    snapshot = _silver(spark, sf_dir)
    after = changes.delete_employees(testdata.departures(spark, sf_dir), snapshot).silver
    return landing.row_counts(after.tables())


@register
def account_roles(spark, sf_dir):
    return changes.account_roles(
        testdata.users(spark, sf_dir), _silver(spark, sf_dir), testdata.ROLE_BY_REGION
    )


@register
def account_eligibility(spark, sf_dir):
    return changes.account_eligibility(
        testdata.account_requests(spark, sf_dir),
        _silver(spark, sf_dir),
        testdata.existing_accounts(spark, sf_dir),
        testdata.ROLE_BY_REGION,
    )


@register
def data_quality(spark, sf_dir):
    w = _warehouse(spark, sf_dir)
    return quality.data_quality(
        _bronze(spark, sf_dir), w.silver, w.gold.dim_employee, testdata.users(spark, sf_dir), w.gold
    )


# -- S: scale-up -------------------------------------------------------------------------------

GROWTH = 2


def _base(spark, sf_dir):
    def ingest():
        raw = testdata.raw_hr(spark, sf_dir)
        named = raw.toDF(*[landing.snake_case(c) for c in raw.columns])
        return named.drop("employee_count", "over18", "standard_hours")

    return Layers.of(spark, sf_dir).scaled("base", ingest)


def _rows(spark, sf_dir):
    target = GROWTH * testdata.table(spark, sf_dir, "customer").count()
    return scale.upsample_rows(_base(spark, sf_dir), target, "employee_number")


def _hired(spark, sf_dir):
    return Layers.of(spark, sf_dir).scaled(
        "hired",
        lambda: scale.derive_email_hire(
            scale.with_names(scale.jitter_and_cap(_rows(spark, sf_dir)))
        ),
    )


def _sampled(spark, sf_dir):
    return Layers.of(spark, sf_dir).scaled(
        "sampled", lambda: scale.sample_history(_hired(spark, sf_dir))
    )


def _projects(spark, sf_dir):
    def make():
        n_projects = testdata.table(spark, sf_dir, "part").count()
        return scale.make_projects(spark, n_projects, _base(spark, sf_dir))

    return Layers.of(spark, sf_dir).scaled("projects", make)


def _assignments(spark, sf_dir):
    return Layers.of(spark, sf_dir).scaled(
        "assignments",
        lambda: scale.make_assignments(_hired(spark, sf_dir), _projects(spark, sf_dir)),
    )


@register
def upsample_rows(spark, sf_dir):
    return _rows(spark, sf_dir)


@register
def jitter_and_cap(spark, sf_dir):
    return scale.jitter_and_cap(_rows(spark, sf_dir))


@register
def derive_email_hire(spark, sf_dir):
    rows = scale.jitter_and_cap(_rows(spark, sf_dir))
    return scale.derive_email_hire(scale.with_names(rows)).select(
        "employee_id", "first_name", "last_name", "email", "hire_date", "effective_from"
    )


@register
def sample_history(spark, sf_dir):
    return scale.sample_history(_hired(spark, sf_dir))


@register
def prior_version(spark, sf_dir):
    return scale.prior_version(
        _hired(spark, sf_dir), _sampled(spark, sf_dir), _base(spark, sf_dir)
    )


@register
def make_projects(spark, sf_dir):
    n_projects = testdata.table(spark, sf_dir, "part").count()
    return scale.make_projects(spark, n_projects, _base(spark, sf_dir))


@register
def make_assignments(spark, sf_dir):
    return scale.make_assignments(_hired(spark, sf_dir), _projects(spark, sf_dir))


@register
def make_reviews(spark, sf_dir):
    return scale.make_reviews(_hired(spark, sf_dir), _assignments(spark, sf_dir))


@register
def inject_noise(spark, sf_dir):
    return scale.inject_noise(_hired(spark, sf_dir)).select(
        "employee_id", "department", "education_field", "monthly_income"
    )


# -- contract ----------------------------------------------------------------------------------


try:
    import corpus_pipeline
    from crewlens.llm import oracle as llm_oracle
    from crewlens.llm import queries as llm_queries
except ImportError as missing:
    if missing.name not in ("corpus_pipeline", "crewlens.llm"):
        if not isinstance(missing, ModuleNotFoundError):
            raise
        warnings.warn(f"Without the corpus queries: {missing}", stacklevel=1)
    LLM: dict[str, Query] = {}
    LLM_ORACLE: dict[str, str] = {}
else:
    LLM = {**llm_queries.QUERIES, "pipeline": corpus_pipeline.run}
    LLM_ORACLE = dict(llm_oracle.QUERIES)


def entry(spark: SparkSession) -> DataFrame:
    """Year-over-year scores per department, from the raw tables up."""
    return _REGISTRY["yoy_performance"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return {**_REGISTRY, **LLM}


def oracle_sql() -> dict[str, str]:
    return {**ORACLE, **LLM_ORACLE}
