"""The whole warehouse as lazy DataFrames, and the reads a dashboard makes of it."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from crewlens.model import Bronze, Gold, Silver
from crewlens.operators import kpi, roster
from crewlens.operators.fact import build_gold
from crewlens.operators.silver import build_silver


@dataclass(frozen=True)
class Warehouse:
    """Silver and Gold of one snapshot, derived on demand or read from a store."""

    silver: Silver
    gold: Gold

    @classmethod
    def derive(cls, bronze: Bronze) -> Warehouse:
        """First load, unmaterialised: Catalyst prunes whatever a question does not need."""
        silver = build_silver(bronze)
        return cls(silver, build_gold(silver, bronze))

    @cached_property
    def performance(self) -> DataFrame:
        g = self.gold
        return kpi.attrition_performance(
            g.dim_employee, g.dim_department, g.fact_performance_reviews
        )

    @cached_property
    def workload(self) -> DataFrame:
        g = self.gold
        return kpi.project_workload(
            g.dim_project, g.dim_department, self.silver.assignments, g.fact_performance_reviews
        )

    def kpi_card(self) -> DataFrame:
        g = self.gold
        return kpi.kpi_card(
            g.dim_employee, g.fact_performance_reviews, g.dim_project, self.silver.assignments
        )

    def years(self) -> DataFrame:
        return kpi.years(self.gold.dim_date)

    def department_names(self) -> DataFrame:
        return kpi.department_names(self.gold.dim_department)

    def yoy_performance(self, department: str | None = None) -> DataFrame:
        g = self.gold
        return kpi.yoy_performance(g.fact_performance_reviews, g.dim_department, department)

    def yoy_overall(self) -> DataFrame:
        return kpi.yoy_overall(self.gold.fact_performance_reviews)

    def top_employees(
        self, year: int | None = None, department: str | None = None, top_n: int = 10
    ) -> DataFrame:
        g = self.gold
        return kpi.top_employees(
            g.fact_performance_reviews, g.dim_employee, g.dim_department, year, department, top_n
        )

    def attrition_by_department(self) -> DataFrame:
        return kpi.attrition_by_department(self.performance)

    def attrition_risk(self, top_n: int = 25) -> DataFrame:
        return kpi.attrition_risk(self.performance, top_n)

    def risk_level_counts(self, top_n: int = 25) -> DataFrame:
        return kpi.risk_level_counts(self.attrition_risk(top_n))

    def project_bottlenecks(self) -> DataFrame:
        return kpi.project_bottlenecks(self.workload)

    def flag_counts(self) -> DataFrame:
        return kpi.flag_counts(self.project_bottlenecks())

    def project_status_counts(self) -> DataFrame:
        return kpi.project_status_counts(self.gold.dim_project)

    def employee_history(self, employee_id: int | None = None) -> DataFrame:
        return roster.employee_history(
            self.gold.dim_employee, self.gold.dim_department, employee_id
        )
