"""Table schemas, layer containers and fixed values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Staging (Bronze): typed, nothing required. Ids are bigint because review ids
# pass the int range long before the data reaches 100 TB.
# --------------------------------------------------------------------------


def _schema(**columns: str) -> T.StructType:
    kinds = {
        "id": T.LongType(),
        "int": T.IntegerType(),
        "text": T.StringType(),
        "date": T.DateType(),
        "money": T.DecimalType(15, 2),
        "score": T.DecimalType(5, 2),
    }
    return T.StructType([T.StructField(name, kinds[kind], True) for name, kind in columns.items()])


STG_EMPLOYEE = _schema(
    employee_id="id", first_name="text", last_name="text", email="text",
    hire_date="date", effective_from="date", age="int", attrition="text",
    business_travel="text", daily_rate="int", department="text", distance_from_home="int",
    education="int", education_field="text", environment_satisfaction="int", gender="text",
    hourly_rate="int", job_involvement="int", job_level="int", job_role="text",
    job_satisfaction="int", marital_status="text", monthly_income="int", monthly_rate="int",
    num_companies_worked="int", over_time="text", percent_salary_hike="int",
    performance_rating="int", relationship_satisfaction="int", stock_option_level="int",
    total_working_years="int", training_times_last_year="int", work_life_balance="int",
    years_at_company="int", years_in_current_role="int", years_since_last_promotion="int",
    years_with_curr_manager="int",
)
STG_EMPLOYEE_HISTORY = _schema(
    history_id="id", employee_id="id", department="text", job_role="text", job_level="int",
    monthly_income="int", valid_from="date", valid_to="date", change_reason="text",
)
STG_PROJECT = _schema(
    project_id="id", project_name="text", department="text", start_date="date",
    planned_end_date="date", status="text", budget="money",
)
STG_ASSIGNMENT = _schema(
    assignment_id="id", employee_id="id", project_id="id", assigned_date="date",
    role_on_project="text", allocation_pct="int",
)
STG_REVIEW = _schema(
    review_id="id", employee_id="id", project_id="id", review_date="date",
    performance_rating="int", review_score="score", job_satisfaction="int",
    work_life_balance="int", environment_satisfaction="int",
)

# Load order of the staging tables.
STAGING = {
    "stg_employee": STG_EMPLOYEE,
    "stg_employee_history": STG_EMPLOYEE_HISTORY,
    "stg_project": STG_PROJECT,
    "stg_assignment": STG_ASSIGNMENT,
    "stg_review": STG_REVIEW,
}

# Silver columns, in table order.
EMPLOYEE_COLUMNS = [
    "employee_id", "first_name", "last_name", "email", "department_id", "job_role",
    "job_level", "hire_date", "effective_from", "age", "gender", "marital_status",
    "monthly_income", "attrition",
]
PROJECT_COLUMNS = [
    "project_id", "project_name", "department_id", "start_date", "planned_end_date",
    "status", "budget",
]
ASSIGNMENT_COLUMNS = STG_ASSIGNMENT.names
REVIEW_COLUMNS = STG_REVIEW.names

# Gold columns, in table order.
EMPLOYEE_VERSION_COLUMNS = [
    "employee_key", "employee_id", "first_name", "last_name", "email", "department_key",
    "job_role", "job_level", "monthly_income", "age", "gender", "marital_status", "attrition",
    "start_date", "end_date", "is_current", "change_reason",
]
DIM_PROJECT_COLUMNS = [
    "project_key", "project_id", "project_name", "department_key", "project_start_date",
    "planned_end_date", "status", "budget",
]
FACT_COLUMNS = [
    "performance_review_key", "review_id", "employee_key", "project_key", "date_key",
    "department_key", "performance_rating", "review_score", "job_satisfaction",
    "work_life_balance", "environment_satisfaction", "review_count",
]

# --------------------------------------------------------------------------
# Fixed values the results depend on.
# --------------------------------------------------------------------------
OPEN_END = "9999-12-31"
PROJECT_STATUSES = ["Planned", "Active", "Completed", "On Hold"]
ACCOUNT_ROLES = ["Admin", "Viewer"]
ROLE_BY_DEPARTMENT = {
    "human resources": "Admin",
    "sales": "Viewer",
    "research & development": "Viewer",
}
RISK_LEVELS = ["High", "Medium", "Low"]
PROJECT_FLAGS = ["Critical", "Busy", "Low scores", "OK"]


@dataclass(frozen=True)
class Bronze:
    employee: DataFrame
    employee_history: DataFrame
    project: DataFrame
    assignment: DataFrame
    review: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {
            "stg_employee": self.employee,
            "stg_employee_history": self.employee_history,
            "stg_project": self.project,
            "stg_assignment": self.assignment,
            "stg_review": self.review,
        }


@dataclass(frozen=True)
class Silver:
    departments: DataFrame
    employees: DataFrame
    projects: DataFrame
    assignments: DataFrame
    reviews: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return dict(vars(self))


@dataclass(frozen=True)
class Gold:
    dim_department: DataFrame
    dim_project: DataFrame
    dim_date: DataFrame
    dim_employee: DataFrame
    fact_performance_reviews: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return dict(vars(self))
