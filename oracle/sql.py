"""The SQL each registered query is checked with, written for DuckDB over the raw test tables.

A chain of common table expressions rebuilds staging, Silver and Gold; every check takes the part
of the chain it needs. Averages and ratios are rounded in whole numbers, so no result depends on
how an engine rounds binary fractions.
"""

from __future__ import annotations

import re

TODAY = "DATE '2000-01-01'"


def h(salt: str, key: str) -> str:
    """The draw both engines share: first eight hex digits of md5('salt|key')."""
    return f"(('0x' || substr(md5('{salt}|' || ({key})), 1, 8))::BIGINT)"


def unit(salt: str, key: str) -> str:
    return f"({h(salt, key)} / 4294967296.0::DOUBLE)"


def letters(key: str) -> str:
    return f"translate(CAST({key} AS VARCHAR), '0123456789', 'abcdefghij')"


def choose(draw: str, values: list[str | None]) -> str:
    branches = " ".join(
        f"WHEN {i} THEN " + ("NULL" if v is None else "'" + v.replace("'", "''") + "'")
        for i, v in enumerate(values)
    )
    return f"(CASE {draw} % {len(values)} {branches} END)"


def avg6(cents: str, n: str) -> str:
    """Mean of a two-decimal column in millionths, half away from zero (values are not negative)."""
    return f"((2 * {cents} * 10000 + {n}) // (2 * {n}))"


def avg4(total: str, n: str) -> str:
    """Mean of a whole-number column in ten-thousandths."""
    return f"((2 * {total} * 10000 + {n}) // (2 * {n}))"


def two6(micro: str) -> str:
    return f"(CAST(({micro} + 5000) // 10000 AS DOUBLE) / 100)"


def two4(tenk: str) -> str:
    return f"(CAST(({tenk} + 50) // 100 AS DOUBLE) / 100)"


def ratio2(top: str, bottom: str) -> str:
    """top / bottom, two decimals."""
    return f"(CAST((200 * {top} + {bottom}) // (2 * {bottom}) AS DOUBLE) / 100)"


def text(date: str) -> str:
    return f"CAST(CAST({date} AS DATE) AS VARCHAR)"


STATUSES = ["Planned", "Active", "Completed", "On Hold"]

CTES: dict[str, str] = {}

# -- staging -----------------------------------------------------------------------------------

CTES["people"] = f"""
SELECT c_custkey, c_nationkey, c_mktsegment, c_acctbal, r_name, r_regionkey,
       c_custkey + 1 AS employee_id,
       DATE '1992-01-01' + CAST({h('hire', 'c_custkey')} % 1825 AS INTEGER) AS hire_date,
       {h('hist', 'c_custkey')} % 100 < 30 AS changed,
       {h('lvl', 'c_custkey')} % 5 + 1 AS job_level,
       CAST(floor(abs(c_acctbal)) AS BIGINT) + 1000 AS monthly_income,
       {choose(h('gen', 'c_custkey'), ['Male', 'Female'])} AS gender,
       {h('age', 'c_custkey')} % 53 + 18 AS age,
       CASE WHEN {h('attr', 'c_custkey')} % 100 < 16 THEN 'Yes' ELSE 'No' END AS attrition,
       CASE WHEN {h('hist', 'c_custkey')} % 100 < 30
            THEN DATE '1992-01-01' + CAST({h('hire', 'c_custkey')} % 1825 AS INTEGER)
                 + CAST({h('chg', 'c_custkey')} % 900 + 180 AS INTEGER)
            ELSE DATE '1992-01-01' + CAST({h('hire', 'c_custkey')} % 1825 AS INTEGER)
       END AS effective_from
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
"""
CTES["staged_people"] = f"""
SELECT employee_id, ' N' || {letters('c_custkey')} AS first_name,
       'S' || {letters('c_nationkey')} || ' ' AS last_name,
       'N' || {letters('c_custkey')} || '.' || employee_id || '@Company.com' AS email,
       hire_date, effective_from, age, attrition,
       CASE WHEN {h('case', 'c_custkey')} % 100 < 2 THEN lower(r_name) ELSE r_name END AS department,
       gender, job_level, c_mktsegment AS job_role,
       {choose(h('mar', 'c_custkey'), ['Single', 'Married', 'Divorced', None])} AS marital_status,
       monthly_income, changed AND {h('dup', 'c_custkey')} % 100 < 1 AS repeated
FROM people
"""
CTES["stg_employee"] = """
SELECT * EXCLUDE (repeated) FROM staged_people
UNION ALL
SELECT * EXCLUDE (repeated) REPLACE (hire_date AS effective_from, monthly_income - 1 AS monthly_income)
FROM staged_people WHERE repeated
"""
CTES["stg_employee_history"] = f"""
SELECT p.employee_id AS history_id, p.employee_id, r.r_name AS department,
       ' ' || c_mktsegment || ' ' AS job_role, greatest(job_level - 1, 1) AS job_level,
       monthly_income * 9 // 10 AS monthly_income, hire_date AS valid_from,
       CASE WHEN {h('bad', 'c_custkey')} % 100 < 2 THEN hire_date - 1 ELSE effective_from - 1 END
           AS valid_to,
       ' PROMOTION ' AS change_reason
FROM people p JOIN region r ON r.r_regionkey = {h('od', 'c_custkey')} % 5
WHERE changed
"""
CTES["stg_project"] = f"""
SELECT p_partkey + 1 AS project_id, ' ' || p_name || ' ' || p_partkey AS project_name,
       r_name AS department,
       DATE '1994-01-01' + CAST({h('ps', 'p_partkey')} % 365 AS INTEGER) AS start_date,
       DATE '1994-01-01' + CAST({h('ps', 'p_partkey')} % 365 AS INTEGER) + 30 * p_size
           AS planned_end_date,
       {choose(h('st', 'p_partkey'), STATUSES)} AS status,
       CAST(p_retailprice * 1000 AS DECIMAL(15, 2)) AS budget
FROM part JOIN region ON r_regionkey = p_partkey % 5
"""
CTES["lines"] = """
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity, l_discount) = 1
"""
CTES["stg_review"] = f"""
SELECT review_id, employee_id, project_id, review_date, performance_rating, score_cents,
       nullif({h('js', 'review_id')} % 5, 0) AS job_satisfaction,
       nullif({h('wl', 'review_id')} % 5, 0) AS work_life_balance,
       nullif({h('es', 'review_id')} % 5, 0) AS environment_satisfaction
FROM (
    SELECT l_orderkey * 10 + l_linenumber AS review_id, o_custkey + 1 AS employee_id,
           l_partkey + 1 AS project_id, CAST(l_shipdate AS DATE) AS review_date,
           CAST(round(l_discount * 100) AS BIGINT) % 4 + 1 AS performance_rating,
           CAST(round(l_quantity * 200) AS BIGINT) AS score_cents
    FROM lines JOIN orders ON o_orderkey = l_orderkey
)
"""
CTES["stg_assignment"] = f"""
SELECT *, 'Developer ' AS role_on_project,
       10 + 10 * ({h('al', 'assignment_id')} % 3) AS allocation_pct
FROM (
    SELECT employee_id, project_id, min(review_id) AS assignment_id, min(review_date) AS assigned_date
    FROM stg_review WHERE review_id % 10 = 1 GROUP BY employee_id, project_id
)
"""

# -- Silver ------------------------------------------------------------------------------------

CTES["departments"] = """
SELECT row_number() OVER (ORDER BY department_name) AS department_id, department_name
FROM (
    SELECT DISTINCT upper(left(trim(department), 1)) || lower(substr(trim(department), 2))
        AS department_name
    FROM stg_employee WHERE trim(department) <> ''
)
"""
CTES["latest"] = """
SELECT employee_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
       lower(trim(email)) AS email, lower(trim(department)) AS department,
       trim(job_role) AS job_role, job_level, hire_date, effective_from, age, gender,
       coalesce(marital_status, 'Single') AS marital_status, monthly_income, attrition
FROM stg_employee
WHERE employee_id IS NOT NULL AND trim(department) <> ''
QUALIFY row_number() OVER (PARTITION BY employee_id
    ORDER BY coalesce(effective_from, hire_date) DESC, hire_date DESC) = 1
"""
CTES["employees"] = """
SELECT employee_id, first_name, last_name, email, department_id, job_role, job_level, hire_date,
       effective_from, age, gender, marital_status, monthly_income, attrition
FROM latest JOIN departments ON lower(department_name) = department
"""
CTES["projects"] = """
SELECT DISTINCT project_id, trim(project_name) AS project_name, department_id, start_date,
       planned_end_date, status, budget
FROM stg_project JOIN departments ON lower(department_name) = lower(trim(department))
WHERE project_id IS NOT NULL
"""
CTES["assignments"] = """
SELECT DISTINCT assignment_id, a.employee_id, a.project_id, assigned_date,
       trim(role_on_project) AS role_on_project, allocation_pct
FROM stg_assignment a JOIN employees USING (employee_id) JOIN projects USING (project_id)
"""
CTES["reviews"] = """
SELECT DISTINCT r.* FROM stg_review r
WHERE r.employee_id IN (SELECT employee_id FROM employees)
  AND r.project_id IN (SELECT project_id FROM projects)
"""

# -- Gold --------------------------------------------------------------------------------------

CTES["dim_department"] = """
SELECT row_number() OVER (ORDER BY department_id) AS department_key, department_id, department_name
FROM departments
"""
CTES["dim_project"] = """
SELECT row_number() OVER (ORDER BY project_id) AS project_key, project_id, project_name,
       department_key, start_date AS project_start_date, planned_end_date, status, budget
FROM projects JOIN dim_department USING (department_id)
"""
CTES["past_versions"] = """
SELECT h.employee_id, e.first_name, e.last_name, e.email, department_key,
       trim(h.job_role) AS job_role, h.job_level, h.monthly_income, e.age, e.gender,
       e.marital_status, e.attrition, valid_from AS start_date, valid_to AS end_date,
       FALSE AS is_current, trim(change_reason) AS change_reason, history_id AS source
FROM stg_employee_history h
JOIN dim_department d ON lower(trim(h.department)) = lower(d.department_name)
JOIN employees e USING (employee_id)
WHERE valid_from <= valid_to
"""


def incoming(employees: str, past: str) -> str:
    return f"""
SELECT employee_id, first_name, last_name, email, department_key, job_role, job_level,
       monthly_income, age, gender, marital_status, attrition,
       coalesce(effective_from, hire_date) AS start_date, DATE '9999-12-31' AS end_date,
       TRUE AS is_current, CAST(NULL AS VARCHAR) AS change_reason, 2 ** 42 + employee_id AS source
FROM {employees} JOIN dim_department USING (department_id)
UNION ALL
SELECT * FROM {past}
"""


CTES["incoming1"] = incoming("employees", "past_versions")
CTES["dim_employee"] = """
SELECT CAST(2 ** 43 + source AS BIGINT) AS employee_key, * EXCLUDE (source) FROM incoming1
"""
CTES["fact"] = """
SELECT r.review_id AS performance_review_key, r.review_id, employee_key, project_key,
       CAST(strftime(review_date, '%Y%m%d') AS BIGINT) AS date_key, e.department_key,
       performance_rating, score_cents, job_satisfaction, work_life_balance,
       environment_satisfaction, CAST(1 AS BIGINT) AS review_count, year(review_date) AS review_year
FROM reviews r
JOIN dim_employee e ON e.employee_id = r.employee_id
    AND r.review_date BETWEEN e.start_date AND e.end_date
JOIN dim_project p ON p.project_id = r.project_id
QUALIFY row_number() OVER (PARTITION BY r.review_id
    ORDER BY e.start_date DESC, e.employee_key DESC) = 1
"""
CTES["snapshot2"] = f"""
SELECT * EXCLUDE (roll) REPLACE (
    CASE WHEN roll < 10 THEN 'ANALYST' ELSE job_role END AS job_role,
    CASE WHEN roll >= 10 AND roll < 15 THEN monthly_income + 500 ELSE monthly_income END
        AS monthly_income,
    CASE WHEN roll >= 15 AND roll < 20 THEN 'new.' || email ELSE email END AS email,
    CASE WHEN roll >= 25 AND roll < 30 THEN department_id % 5 + 1 ELSE department_id END
        AS department_id,
    CASE WHEN roll < 10 THEN effective_from + 200
         WHEN roll >= 20 AND roll < 25 THEN effective_from - 30
         WHEN roll >= 25 AND roll < 30 THEN effective_from + 100
         ELSE effective_from END AS effective_from)
FROM (SELECT *, {h('snap', 'employee_id')} % 100 AS roll FROM employees) WHERE roll < 97
"""
CTES["past_versions2"] = CTES["past_versions"].replace("JOIN employees e", "JOIN snapshot2 e")
CTES["incoming2"] = incoming("snapshot2", "past_versions2")
CTES["closed"] = """
SELECT * EXCLUDE (closes, new_start) REPLACE (
    CASE WHEN closes THEN new_start - 1 ELSE end_date END AS end_date,
    is_current AND NOT closes AS is_current)
FROM (
    SELECT d.*, i.start_date AS new_start,
           d.is_current AND i.employee_id IS NOT NULL AND (
               d.start_date <> i.start_date OR d.department_key <> i.department_key
               OR lower(d.job_role) <> lower(i.job_role) OR d.job_level <> i.job_level
               OR d.monthly_income <> i.monthly_income) AS closes
    FROM dim_employee d
    LEFT JOIN (SELECT * FROM incoming2 WHERE is_current) i USING (employee_id)
) d
"""
CTES["inserted"] = """
SELECT CAST(2 * 2 ** 43 + source AS BIGINT) AS employee_key, * EXCLUDE (source)
FROM incoming2 i
WHERE NOT EXISTS (
    SELECT 1 FROM closed c
    WHERE c.employee_id = i.employee_id AND c.start_date = i.start_date
      AND c.end_date = i.end_date AND c.department_key = i.department_key
      AND lower(c.job_role) = lower(i.job_role) AND c.job_level = i.job_level
      AND c.monthly_income = i.monthly_income AND c.is_current = i.is_current)
"""

# -- views -------------------------------------------------------------------------------------

CTES["yoy"] = f"""
SELECT review_year, department_key, department_name, review_count, micro, rating,
       micro - lag(micro) OVER (PARTITION BY department_key ORDER BY review_year) AS change
FROM (
    SELECT review_year, department_key, department_name, count(DISTINCT review_id) AS review_count,
           {avg6('sum(score_cents)', 'count(*)')} AS micro,
           {avg4('sum(performance_rating)', 'count(*)')} AS rating
    FROM fact JOIN dim_department USING (department_key)
    GROUP BY ALL
)
"""
CTES["performance"] = f"""
SELECT e.employee_id, e.first_name || ' ' || e.last_name AS employee_name, department_name,
       e.job_role, e.attrition, count(DISTINCT review_id) AS review_count,
       CASE WHEN count(score_cents) > 0 THEN
           ({avg6('sum(score_cents)', 'count(score_cents)')} + 5000) // 10000 END AS score,
       CASE WHEN count(job_satisfaction) > 0 THEN
           ({avg4('sum(job_satisfaction)', 'count(job_satisfaction)')} + 50) // 100 END AS job,
       CASE WHEN count(work_life_balance) > 0 THEN
           ({avg4('sum(work_life_balance)', 'count(work_life_balance)')} + 50) // 100 END AS life
FROM dim_employee e JOIN dim_department USING (department_key)
LEFT JOIN fact f ON f.employee_key = e.employee_key
WHERE e.is_current
GROUP BY e.employee_id, e.first_name, e.last_name, department_name, e.job_role, e.attrition
"""
CTES["risk"] = """
SELECT employee_id, employee_name, department_name, job_role, score, job, life,
       800 - job - life AS risk
FROM performance
WHERE lower(attrition) = 'no' AND review_count > 0 AND job IS NOT NULL AND life IS NOT NULL
"""


def top_risk(n: int) -> str:
    return f"SELECT * FROM risk ORDER BY risk DESC, employee_id LIMIT {n}"


RISK_LEVEL = "CASE WHEN risk >= 400 THEN 'High' WHEN risk >= 300 THEN 'Medium' ELSE 'Low' END"

CTES["workload"] = f"""
SELECT p.project_id, p.project_name, department_name, p.status, p.budget,
       coalesce(people, 0) AS people, coalesce(allocation, 0) AS allocation,
       coalesce(review_count, 0) AS review_count, score
FROM dim_project p JOIN dim_department USING (department_key)
LEFT JOIN (
    SELECT project_id, count(DISTINCT employee_id) AS people, sum(allocation_pct) AS allocation
    FROM assignments GROUP BY project_id
) a ON a.project_id = p.project_id
LEFT JOIN (
    SELECT project_key, count(*) AS review_count,
           ({avg6('sum(score_cents)', 'count(*)')} + 5000) // 10000 AS score
    FROM fact GROUP BY project_key
) r ON r.project_key = p.project_key
"""
CTES["bottlenecks"] = f"""
SELECT *, CASE WHEN busy AND weak THEN 'Critical' WHEN weak THEN 'Low scores'
               WHEN busy THEN 'Busy' ELSE 'OK' END AS flag
FROM (
    SELECT *, coalesce(average >= (SELECT quantile_cont(average, 0.75) FROM averaged), FALSE) AS busy,
           coalesce(CAST(score AS DOUBLE) / 100
               <= (SELECT quantile_cont(CAST(score AS DOUBLE) / 100, 0.25) FROM averaged), FALSE)
               AS weak
    FROM averaged
)
"""
CTES["averaged"] = f"""
SELECT *, CASE WHEN people > 0 THEN {ratio2('allocation', 'people')} END AS average FROM workload
"""

# -- change requests ---------------------------------------------------------------------------

NAME = "[A-Za-z]+(?:[ ''-][A-Za-z]+)*"
ROLE = "[A-Za-z]+(?:[ ''&/-][A-Za-z]+)*"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z]{2,})"
PROJECT = "[A-Za-z0-9][A-Za-z0-9 ''&/_().-]*"

flaw20 = h("flaw", "c_custkey") + " % 20"
CTES["new_employees"] = f"""
SELECT employee_id AS seq,
       CASE flaw WHEN 0 THEN ' ' WHEN 1 THEN 'R2' ELSE ' N' || {letters('c_custkey')} END
           AS first_name,
       CASE flaw WHEN 2 THEN '9' ELSE 'O''S' || {letters('c_nationkey')} END AS last_name,
       CASE flaw WHEN 3 THEN 'invalid'
                 WHEN 4 THEN 'team.' || {letters('c_nationkey')} || '@company.com'
                 WHEN 5 THEN 'N' || {letters('c_custkey')} || '.' || employee_id || '@Company.com'
                 ELSE ' New.' || {letters('c_custkey')} || '@Company.com ' END AS email,
       {h('dep', 'c_custkey')} % 5 + CASE flaw WHEN 6 THEN 6 ELSE 1 END AS department_id,
       CASE flaw WHEN 7 THEN '' WHEN 8 THEN 'Dev 2' ELSE 'Research & Sales-Lead' END AS job_role,
       job_level + CASE flaw WHEN 9 THEN 5 ELSE 0 END AS job_level,
       hire_date + CAST({h('join', 'c_custkey')} % 2000 AS INTEGER) AS hire_date,
       age + CASE flaw WHEN 10 THEN 60 ELSE 0 END AS age,
       monthly_income * CASE flaw WHEN 11 THEN 0 ELSE 1 END AS monthly_income, gender
FROM (SELECT *, {flaw20} AS flaw FROM people)
"""
CTES["judged_employees"] = f"""
SELECT *, CASE
    WHEN trim(first_name) = '' OR trim(last_name) = '' THEN 'First name and last name are required.'
    WHEN NOT regexp_full_match(trim(first_name), '{NAME}') THEN 'First name must contain letters only.'
    WHEN NOT regexp_full_match(trim(last_name), '{NAME}') THEN 'Last name must contain letters only.'
    WHEN NOT regexp_full_match(trim(email), '{EMAIL}') THEN 'Please enter a valid email address.'
    WHEN trim(job_role) = '' THEN 'Job role is required.'
    WHEN NOT regexp_full_match(trim(job_role), '{ROLE}') THEN 'Job role must contain letters only.'
    WHEN age NOT BETWEEN 18 AND 70 THEN 'Age must be between 18 and 70.'
    WHEN job_level NOT BETWEEN 1 AND 5 THEN 'Job level must be between 1 and 5.'
    WHEN monthly_income <= 0 THEN 'Monthly income must be greater than 0.'
    WHEN hire_date > {TODAY} THEN 'Hire date cannot be in the future.' END AS reason
FROM new_employees
"""
CTES["new_projects"] = f"""
SELECT p_partkey + 1 AS seq,
       CASE flaw WHEN 0 THEN ' ' WHEN 1 THEN '0000' WHEN 2 THEN '* new'
                 ELSE ' ' || p_name || ' (phase 2) ' END AS project_name,
       {h('dep', 'p_partkey')} % 5 + CASE flaw WHEN 3 THEN 6 ELSE 1 END AS department_id,
       start AS start_date, start + CASE flaw WHEN 4 THEN 0 ELSE p_size * 7 END AS planned_end_date,
       'Planned' AS status,
       CAST(p_retailprice * CASE flaw WHEN 5 THEN -1 ELSE 100 END AS DECIMAL(15, 2)) AS budget
FROM (SELECT *, {h('flaw', 'p_partkey')} % 20 AS flaw,
             DATE '2000-01-01' + CAST({h('ps', 'p_partkey')} % 365 AS INTEGER) AS start FROM part)
"""
CTES["judged_projects"] = f"""
SELECT *, CASE
    WHEN trim(project_name) = '' THEN 'Project name is required.'
    WHEN NOT regexp_full_match(trim(project_name), '{PROJECT}')
      OR NOT regexp_matches(project_name, '[A-Za-z]')
        THEN 'Project name is invalid. Please include at least one letter.'
    WHEN planned_end_date <= start_date THEN 'Planned end date must be after the start date.'
    WHEN budget < 0 THEN 'Budget cannot be negative.' END AS reason
FROM new_projects
"""
CTES["new_reviews"] = f"""
SELECT review_id AS seq, employee_id * CASE flaw WHEN 0 THEN -1 ELSE 1 END AS employee_id,
       project_id * CASE flaw WHEN 1 THEN -1 ELSE 1 END AS project_id,
       review_date + CAST({h('late', 'review_id')} % 400 AS INTEGER) AS review_date,
       performance_rating + CASE flaw WHEN 2 THEN 4 ELSE 0 END AS performance_rating,
       score_cents + CASE flaw WHEN 3 THEN 10000 ELSE 0 END AS score_cents,
       job_satisfaction + CASE flaw WHEN 4 THEN 4 ELSE 0 END AS job_satisfaction,
       work_life_balance, environment_satisfaction
FROM (SELECT *, {h('flaw', 'review_id')} % 20 AS flaw FROM stg_review)
"""
CTES["judged_reviews"] = f"""
SELECT *, CASE
    WHEN performance_rating NOT IN (1, 2, 3, 4) THEN 'Performance rating must be 1, 2, 3 or 4.'
    WHEN score_cents NOT BETWEEN 0 AND 10000 THEN 'Review score must be between 0 and 100.'
    WHEN coalesce(job_satisfaction, 1) NOT BETWEEN 1 AND 4
      OR coalesce(work_life_balance, 1) NOT BETWEEN 1 AND 4
      OR coalesce(environment_satisfaction, 1) NOT BETWEEN 1 AND 4
        THEN 'Satisfaction values must be 1 to 4.'
    WHEN review_date > {TODAY} THEN 'Review date cannot be in the future.' END AS reason
FROM new_reviews
"""
CTES["hired"] = """
SELECT * REPLACE (trim(first_name) AS first_name, trim(last_name) AS last_name,
                  lower(trim(email)) AS email, trim(job_role) AS job_role,
    coalesce(reason, CASE WHEN NOT fits OR place > 1 THEN
        'Could not save: that email already exists or the department is invalid.' END) AS reason)
FROM (
    SELECT *, row_number() OVER (PARTITION BY lower(trim(email)), fits ORDER BY seq) AS place
    FROM (
        SELECT *, reason IS NULL
               AND lower(trim(email)) NOT IN (SELECT email FROM employees)
               AND department_id IN (SELECT department_id FROM departments) AS fits
        FROM judged_employees
    )
)
"""
CTES["employee_changes"] = f"""
SELECT o_orderkey + 1 AS seq, o_custkey + CASE flaw WHEN 0 THEN 100000000 ELSE 1 END AS employee_id,
       CASE WHEN same THEN r_regionkey + 1 ELSE {h('dep', 'o_orderkey')} % 6 + 1 END AS department_id,
       trim(' ' || c_mktsegment || ' ') AS job_role,
       CASE WHEN same THEN job_level ELSE {h('lvl', 'o_orderkey')} % 6 + 1 END AS job_level,
       CASE WHEN same THEN monthly_income ELSE {h('inc', 'o_orderkey')} % 9000 END AS monthly_income,
       CASE flaw WHEN 1 THEN 'Maybe' ELSE attrition END AS attrition
FROM (SELECT *, {h('same', 'o_orderkey')} % 4 = 0 AS same, {h('flaw', 'o_orderkey')} % 20 AS flaw
      FROM orders) JOIN people ON c_custkey = o_custkey
"""
CTES["first_look"] = f"""
SELECT c.*, e.employee_id IS NOT NULL AS found, CASE
    WHEN e.employee_id IS NULL THEN 'Employee ' || c.employee_id || ' not found.'
    WHEN e.department_id = c.department_id AND e.job_role = c.job_role
     AND e.job_level = c.job_level AND e.monthly_income = c.monthly_income
     AND e.attrition = c.attrition THEN 'Nothing changed - no new history record needed.'
    WHEN e.effective_from >= {TODAY}
        THEN 'This employee was already changed today. Try again tomorrow.'
    WHEN c.job_level NOT BETWEEN 1 AND 5 OR c.monthly_income <= 0
        THEN 'Job level must be 1-5 and income must be above 0.'
    WHEN c.attrition NOT IN ('Yes', 'No') THEN 'Attrition status must be ''Yes'' or ''No''.'
    WHEN c.department_id NOT IN (SELECT department_id FROM departments)
        THEN 'Invalid department selected.' END AS reason
FROM employee_changes c LEFT JOIN employees e USING (employee_id)
"""
CTES["day_change"] = """
SELECT * FROM first_look WHERE reason IS NULL
QUALIFY row_number() OVER (PARTITION BY employee_id ORDER BY seq) = 1
"""
CTES["status_changes"] = f"""
SELECT review_id AS seq,
       project_id + CASE WHEN {h('gone', 'review_id')} % 50 = 0 THEN 100000000 ELSE 0 END AS project_id,
       trim({choose(h('status', 'review_id'), STATUSES + [' Active ', 'Cancelled'])}) AS status
FROM stg_review
"""
CTES["assignment_requests"] = f"""
SELECT review_id AS seq, employee_id * CASE flaw WHEN 0 THEN -1 ELSE 1 END AS employee_id,
       project_id * CASE flaw WHEN 1 THEN -1 ELSE 1 END AS project_id,
       CASE flaw WHEN 2 THEN '  ' ELSE ' Tester ' END AS role_on_project,
       {h('share', 'review_id')} % 30 AS allocation_pct
FROM (SELECT *, {h('flaw', 'review_id')} % 40 AS flaw FROM stg_review)
"""
# One queue per person, handled request by request.
CTES["queues"] = """
SELECT r.employee_id, coalesce(any_value(used), 0) AS used,
       coalesce(any_value(taken), CAST([] AS BIGINT[])) AS taken,
       list({'seq': seq, 'project': r.project_id, 'role': trim(role_on_project),
             'pct': allocation_pct, 'known': e.employee_id IS NOT NULL AND p.project_id IS NOT NULL}
            ORDER BY seq) AS queue
FROM assignment_requests r
LEFT JOIN employees e ON e.employee_id = r.employee_id
LEFT JOIN projects p ON p.project_id = r.project_id
LEFT JOIN (
    SELECT employee_id, CAST(sum(allocation_pct) AS BIGINT) AS used,
           CAST(list(DISTINCT project_id) AS BIGINT[]) AS taken
    FROM assignments GROUP BY employee_id
) a ON a.employee_id = r.employee_id
GROUP BY r.employee_id
"""
CTES["handled"] = """
SELECT employee_id, unnest(done.out) AS one FROM (
    SELECT employee_id, list_reduce(queue, lambda s, q:
        CASE
        WHEN q.role = '' THEN {'used': s.used, 'taken': s.taken,
            'out': list_append(s.out, {'seq': q.seq, 'reason': 'Role on project is required.'})}
        WHEN q.pct < 1 OR q.pct > 100 THEN {'used': s.used, 'taken': s.taken,
            'out': list_append(s.out, {'seq': q.seq,
                                       'reason': 'Allocation must be between 1 and 100.'})}
        WHEN list_contains(s.taken, q.project) THEN {'used': s.used, 'taken': s.taken,
            'out': list_append(s.out, {'seq': q.seq,
                                       'reason': 'This employee is already on this project.'})}
        WHEN s.used + q.pct > 100 THEN {'used': s.used, 'taken': s.taken,
            'out': list_append(s.out, {'seq': q.seq, 'reason': 'Employee already has ' || s.used
                || '% allocated. Adding ' || q.pct || '% goes over 100%.'})}
        WHEN NOT q.known THEN {'used': s.used, 'taken': s.taken,
            'out': list_append(s.out, {'seq': q.seq,
                                       'reason': 'Employee id or project id does not exist.'})}
        ELSE {'used': s.used + q.pct, 'taken': list_append(s.taken, q.project),
              'out': list_append(s.out, {'seq': q.seq, 'reason': CAST(NULL AS VARCHAR)})}
        END,
        {'used': CAST(used AS BIGINT), 'taken': taken,
         'out': CAST([] AS STRUCT(seq BIGINT, reason VARCHAR)[])}) AS done
    FROM queues
)
"""
CTES["departures"] = """
SELECT c_custkey + 1 AS seq,
       c_custkey + CASE WHEN c_acctbal > 9900 THEN 100000000 ELSE 1 END AS employee_id
FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9900
"""
CTES["users"] = f"""
SELECT CASE WHEN {h('user', 'c_custkey')} % 4 = 0 THEN 'user-' || {letters('c_custkey')}
            ELSE 'n' || {letters('c_custkey')} || '.' || (c_custkey + 1) || '@COMPANY.com' END
           AS username,
       {choose(h('role', 'c_custkey'), ['Admin', 'Viewer'])} AS role,
       {h('active', 'c_custkey')} % 10 <> 0 AS is_active
FROM customer
"""
CTES["account_requests"] = f"""
SELECT o_orderkey + 1 AS seq,
       CASE {h('flaw', 'o_orderkey')} % 20 WHEN 0 THEN ' ' WHEN 1 THEN 'stranger@company.com'
            ELSE ' N' || {letters('o_custkey')} || '.' || (o_custkey + 1) || '@company.com ' END
           AS email
FROM orders
"""
CTES["staff"] = """
SELECT lower(trim(email)) AS email, employee_id, department_name FROM employees
JOIN departments USING (department_id)
"""
ROLE_OF = """CASE lower(trim(department_name)) WHEN 'africa' THEN 'Admin' WHEN 'america' THEN 'Viewer'
    WHEN 'asia' THEN 'Viewer' END"""

# -- scale-up ----------------------------------------------------------------------------------


def between(salt: str, low: int, high: int, key: str = "c_custkey") -> str:
    return f"({h(salt, key)} % {high - low} + {low})"


CTES["raw_hr"] = f"""
SELECT age, attrition, {between('dr', 100, 1500)} AS daily_rate, r_name AS department,
       {choose(h('ef', 'c_custkey'), ['Life Sciences', 'Medical', 'Marketing', 'Other'])}
           AS education_field,
       employee_id AS employee_number, {between('es', 1, 5)} AS environment_satisfaction, gender,
       {between('hr', 30, 101)} AS hourly_rate, job_level, c_mktsegment AS job_role,
       {between('js', 1, 5)} AS job_satisfaction, monthly_income,
       {between('mr', 2000, 27000)} AS monthly_rate, {between('pr', 3, 5)} AS performance_rating,
       {between('tw', 0, 41)} AS total_working_years, {between('wl', 1, 5)} AS work_life_balance,
       {between('yc', 0, 21)} AS years_at_company, {between('yr', 0, 15)} AS years_in_current_role,
       {between('yp', 0, 12)} AS years_since_last_promotion,
       {between('ym', 0, 15)} AS years_with_curr_manager
FROM people
"""
CTES["base"] = """
SELECT row_number() OVER (ORDER BY employee_number) AS place, * EXCLUDE (employee_number) FROM raw_hr
"""
CTES["upsampled"] = f"""
SELECT employee_id, employee_id > n AS is_extra, b.* EXCLUDE (place)
FROM (
    SELECT i AS employee_id, n,
           CASE WHEN i <= n THEN i ELSE {h('pick', 'i')} % n + 1 END AS place
    FROM (SELECT count(*) AS n FROM raw_hr), generate_series(1, 2 * n) AS g(i)
) JOIN base b USING (place)
"""
CTES["aged"] = f"""
SELECT * REPLACE (
    CASE WHEN is_extra THEN greatest(18, least(60, age + {between('age', -3, 4, 'employee_id')}))
         ELSE age END AS age)
FROM upsampled
"""
CTES["worked"] = """
SELECT * REPLACE (CASE WHEN is_extra THEN least(total_working_years, greatest(age - 18, 0))
                       ELSE total_working_years END AS total_working_years) FROM aged
"""
CTES["served"] = """
SELECT * REPLACE (CASE WHEN is_extra THEN least(years_at_company, total_working_years)
                       ELSE years_at_company END AS years_at_company) FROM worked
"""


def jitter(column: str) -> str:
    factor = f"(CAST(0.9 AS DOUBLE) + CAST(0.2 AS DOUBLE) * {unit(column, 'employee_id')})"
    return (
        f"CASE WHEN is_extra THEN CAST(round({column} * {factor}) AS BIGINT) ELSE {column} END AS {column}"
    )


def capped(column: str) -> str:
    return f"CASE WHEN is_extra THEN least({column}, years_at_company) ELSE {column} END AS {column}"


CTES["jittered"] = f"""
SELECT * REPLACE ({capped('years_in_current_role')}, {capped('years_with_curr_manager')},
    {capped('years_since_last_promotion')}, {jitter('monthly_income')}, {jitter('hourly_rate')},
    {jitter('daily_rate')}, {jitter('monthly_rate')})
FROM served
"""
CTES["named"] = f"""
SELECT *, 'N' || {letters('employee_id')} AS first_name,
       'S' || {letters(h('last', 'employee_id') + ' % 2000')} AS last_name,
       DATE '2025-12-31' - CAST(years_at_company * 365 + {h('hire', 'employee_id')} % 330 AS INTEGER)
           AS hire_date
FROM jittered
"""
CTES["sampled"] = f"""
SELECT employee_id, hire_date
       + CAST(180 + {h('change', 'employee_id')} % (DATE '2025-12-31' - hire_date - 240) AS INTEGER)
       AS change_date
FROM (
    SELECT employee_id, hire_date,
           row_number() OVER (ORDER BY {h('history', 'employee_id')}, employee_id) AS nth
    FROM named WHERE years_at_company >= 2
)
WHERE nth <= (SELECT floor(count(*) * CAST(0.05 AS DOUBLE)) FROM named)
"""
CTES["dept_list"] = """
SELECT row_number() OVER (ORDER BY department) AS place, department, roles FROM (
    SELECT department, list_sort(list(DISTINCT job_role)) AS roles FROM raw_hr GROUP BY department
)
"""
roll = h("kind", "employee_id") + " % 100"
CTES["undone"] = f"""
SELECT e.*, change_date, o.department AS other_department, o.roles AS other_roles,
       CASE WHEN {roll} < 35 THEN 'DEPARTMENT_CHANGE'
            WHEN {roll} < 60 AND job_level > 1 THEN 'PROMOTION' ELSE 'SALARY_HIKE' END AS kind
FROM named e JOIN sampled USING (employee_id) JOIN dept_list d ON d.department = e.department
LEFT JOIN dept_list o ON o.place = (
    {h('department', 'employee_id')} % ((SELECT count(*) FROM dept_list) - 1) + 1
    + CASE WHEN {h('department', 'employee_id')} % ((SELECT count(*) FROM dept_list) - 1) + 1
                >= d.place THEN 1 ELSE 0 END)
"""


def divided(low: str, width: str) -> str:
    return (
        f"CAST(round(monthly_income / (CAST({low} AS DOUBLE) + CAST({width} AS DOUBLE) * "
        f"{unit('raise', 'employee_id')})) AS BIGINT)"
    )


CTES["made_projects"] = f"""
SELECT project_id, 'PRJ-' || lpad(CAST(project_id AS VARCHAR),
           CAST(greatest(4, length(CAST(project_id AS VARCHAR))) AS INTEGER), '0') AS project_name,
       department, start_date,
       CASE WHEN active THEN DATE '2025-12-31' + CAST({between('end', 30, 800, 'project_id')} AS INTEGER)
            ELSE least(start_date + CAST({between('end', 365, 1500, 'project_id')} AS INTEGER),
                       DATE '2025-12-30') END AS planned_end_date,
       CASE WHEN active THEN 'Active' ELSE 'Completed' END AS status,
       CAST({between('budget', 50000, 5000000, 'project_id')} AS DOUBLE) AS budget
FROM (
    SELECT i AS project_id, DATE '2016-01-01'
               + CAST({h('start', 'i')} % (DATE '2023-06-30' - DATE '2016-01-01') AS INTEGER)
               AS start_date,
           {unit('active', 'i')} < 0.75 AS active,
           {h('dept', 'i')} % (SELECT count(*) FROM dept_list) + 1 AS place
    FROM (SELECT count(*) AS n FROM part), generate_series(1, n) AS g(i)
) JOIN dept_list USING (place)
"""
CTES["pool"] = """
SELECT department, project_id, start_date AS project_start,
       row_number() OVER (PARTITION BY department ORDER BY project_id) AS nth,
       count(*) OVER (PARTITION BY department) AS size
FROM made_projects WHERE status = 'Active'
"""
CTES["made_assignments"] = f"""
SELECT employee_id AS assignment_id, employee_id, project_id,
       greatest(hire_date, project_start) AS assigned_date,
       {choose(h('work', 'employee_id'), ['Developer', 'Analyst', 'Lead', 'Tester', 'Coordinator'])}
           AS role_on_project,
       CASE WHEN {h('allocation', 'employee_id')} % 100 < 40 THEN CAST(50 AS BIGINT)
            WHEN {h('allocation', 'employee_id')} % 100 < 70 THEN 75 ELSE 100 END AS allocation_pct
FROM named e JOIN (SELECT DISTINCT department, size FROM pool) s USING (department)
JOIN pool p ON p.department = e.department AND p.nth = {h('project', 'employee_id')} % s.size + 1
"""
shift = h("shift", "k") + " % 100"
normal = (
    f"sqrt(-2 * ln(({h('score1', 'k')} + CAST(0.5 AS DOUBLE)) / 4294967296.0::DOUBLE))"
    f" * cos(2 * pi() * {unit('score2', 'k')}) * 6"
)


def mood(column: str) -> str:
    return f"greatest(1, least(4, {column} + {h(column, 'k')} % 3 - 1)) AS {column}"


CTES["made_reviews"] = f"""
SELECT row_number() OVER (ORDER BY year, employee_id) AS review_id, employee_id, project_id,
       make_date(year, 12, 15) AS review_date, rating AS performance_rating,
       round(greatest(0, least(100, rating * 20 + {normal})), 1) AS review_score,
       {mood('job_satisfaction')}, {mood('work_life_balance')}, {mood('environment_satisfaction')}
FROM (
    SELECT *, greatest(1, least(5, performance_rating + CASE
            WHEN {shift} < CASE year WHEN 2023 THEN 20 WHEN 2024 THEN 15 ELSE 10 END THEN -1
            WHEN {shift} < CASE year WHEN 2023 THEN 80 WHEN 2024 THEN 75 ELSE 65 END THEN 0
            ELSE 1 END)) AS rating
    FROM (
        SELECT e.*, y.year, e.employee_id || '|' || y.year AS k
        FROM named e, (VALUES (2023), (2024), (2025)) y(year)
        WHERE hire_date <= make_date(y.year, 12, 15) - 90
    )
) JOIN (SELECT employee_id, min_by(project_id, assignment_id) AS project_id
        FROM made_assignments GROUP BY employee_id) USING (employee_id)
"""
CTES["noisy"] = f"""
SELECT employee_id,
       CASE WHEN {unit('case', 'employee_id')} < 0.02 THEN lower(department) ELSE department END
           AS department,
       CASE WHEN {unit('gap', 'employee_id')} >= 0.01 THEN education_field END AS education_field,
       monthly_income
FROM named
"""
CTES["copied"] = f"""
SELECT {h('copy', 'i')} % n + 1 AS employee_id
FROM (SELECT count(*) AS n FROM named), generate_series(0, n // 100 - 1) AS g(i)
"""

QUERIES: dict[str, str] = {}


def _needed(sql: str) -> list[str]:
    """Names of the expressions a statement uses, each after those it depends on."""
    found: list[str] = []
    seen: set[str] = set()

    def visit(body: str) -> None:
        for word in dict.fromkeys(re.findall(r"[a-z_0-9]+", body)):
            if word in CTES and word not in seen:
                seen.add(word)
                visit(CTES[word])
                found.append(word)

    visit(sql)
    return found


def query(name: str, sql: str) -> None:
    chain = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in _needed(sql))
    QUERIES[name] = (f"WITH {chain}\n" if chain else "") + sql.strip()


def counts(**tables: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}"
        for name, source in tables.items()
    )


# -- A -----------------------------------------------------------------------------------------

query("bronze_load", counts(
    stg_employee="stg_employee", stg_employee_history="stg_employee_history",
    stg_project="stg_project", stg_assignment="stg_assignment", stg_review="stg_review",
))
query("raw_hr_ingest", """
SELECT age, attrition, daily_rate, department, education_field, environment_satisfaction, gender,
       hourly_rate, job_level, job_role, job_satisfaction, monthly_income, monthly_rate,
       performance_rating, total_working_years, work_life_balance, years_at_company,
       years_in_current_role, years_since_last_promotion, years_with_curr_manager
FROM raw_hr
""")
query("warehouse_refresh", counts(
    dim_department="dim_department", dim_project="dim_project",
    dim_date="(SELECT DISTINCT review_date FROM reviews)", dim_employee="dim_employee",
    fact_performance_reviews="fact",
))

# -- B -----------------------------------------------------------------------------------------

query("clean_departments", "SELECT department_id, department_name FROM departments")
query("latest_employee", f"""
SELECT employee_id, first_name, last_name, email, department, job_role, job_level,
       {text('hire_date')} AS hire_date, {text('effective_from')} AS effective_from, age, gender,
       marital_status, monthly_income, attrition FROM latest
""")
EMPLOYEES = f"""
SELECT employee_id, first_name, last_name, email, department_id, job_role, job_level,
       {text('hire_date')} AS hire_date, {text('effective_from')} AS effective_from, age, gender,
       marital_status, monthly_income, attrition
"""
query("clean_employees", EMPLOYEES + "FROM employees")
query("clean_projects", f"""
SELECT project_id, project_name, department_id, {text('start_date')} AS start_date,
       {text('planned_end_date')} AS planned_end_date, status, CAST(budget AS DOUBLE) AS budget
FROM projects
""")
query("dim_date", """
SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, CAST(d AS VARCHAR) AS full_date,
       day(d) AS day_of_month, month(d) AS month_number, monthname(d) AS month_name,
       quarter(d) AS quarter_number, year(d) AS year_number, weekofyear(d) AS week_number,
       dayname(d) AS day_name
FROM (SELECT DISTINCT review_date AS d FROM reviews)
""")
query("valid_history", f"""
SELECT history_id, employee_id, department, trim(job_role) AS job_role, job_level, monthly_income,
       {text('valid_from')} AS valid_from, {text('valid_to')} AS valid_to,
       trim(change_reason) AS change_reason
FROM stg_employee_history WHERE valid_from <= valid_to
""")
query("history_timeline", f"""
SELECT employee_id, 'Employee ' || employee_id AS employee,
       department_name || ' / ' || job_role AS version, job_level, monthly_income,
       {text('start_date')} AS start_plot,
       CASE WHEN is_current THEN '2000-01-01' ELSE {text('end_date')} END AS end_plot,
       CASE WHEN is_current THEN 'current' ELSE {text('end_date')} END AS end_label
FROM dim_employee JOIN dim_department USING (department_key)
""")

# -- C -----------------------------------------------------------------------------------------

query("fact_point_in_time", """
SELECT performance_review_key, review_id, employee_key, project_key, date_key, department_key,
       performance_rating, CAST(score_cents AS DOUBLE) / 100 AS review_score, job_satisfaction,
       work_life_balance, environment_satisfaction, review_count
FROM fact
""")
query("fk_filtered_assignments", f"""
SELECT assignment_id, employee_id, project_id, {text('assigned_date')} AS assigned_date,
       role_on_project, allocation_pct FROM assignments
""")
query("fk_filtered_reviews", f"""
SELECT review_id, employee_id, project_id, {text('review_date')} AS review_date,
       performance_rating, CAST(score_cents AS DOUBLE) / 100 AS review_score, job_satisfaction,
       work_life_balance, environment_satisfaction FROM reviews
""")
query("employee_projects", f"""
SELECT DISTINCT a.employee_id, p.project_id, project_name, department_name,
       {text('start_date')} AS start_date, {text('planned_end_date')} AS planned_end_date, status,
       CAST(budget AS DOUBLE) AS budget
FROM assignments a JOIN projects p USING (project_id) JOIN departments USING (department_id)
""")

# -- D -----------------------------------------------------------------------------------------

query("kpi_card", f"""
SELECT total_employees, attrition_rate_pct, total_reviews, avg_review_score,
       avg_performance_rating, avg_job_satisfaction, avg_work_life_balance, total_projects,
       total_project_budget, overallocated_employees
FROM (
    SELECT count(*) AS total_employees,
           {ratio2("(100 * count(*) FILTER (WHERE lower(attrition) = 'yes'))", 'count(*)')}
               AS attrition_rate_pct
    FROM dim_employee WHERE is_current
), (
    SELECT count(*) AS total_reviews, {two6(avg6('sum(score_cents)', 'count(*)'))} AS avg_review_score,
           {two4(avg4('sum(performance_rating)', 'count(*)'))} AS avg_performance_rating,
           {two4(avg4('sum(job_satisfaction)', 'count(job_satisfaction)'))} AS avg_job_satisfaction,
           {two4(avg4('sum(work_life_balance)', 'count(work_life_balance)'))} AS avg_work_life_balance
    FROM fact
), (
    SELECT count(*) AS total_projects, CAST(sum(budget) AS DOUBLE) AS total_project_budget
    FROM dim_project
), (
    SELECT count(*) AS overallocated_employees FROM (
        SELECT employee_id FROM assignments GROUP BY employee_id HAVING sum(allocation_pct) > 100)
)
""")
query("overallocated_employees", """
SELECT employee_id, CAST(sum(allocation_pct) AS BIGINT) AS total_allocation_pct
FROM assignments GROUP BY employee_id HAVING sum(allocation_pct) > 100
""")
query("yoy_overall", f"""
SELECT review_year, count(*) AS review_count,
       {two6(avg6('sum(score_cents)', 'count(*)'))} AS average_review_score
FROM fact GROUP BY review_year
""")
query("attrition_performance", """
SELECT employee_id, employee_name, department_name, job_role, attrition, review_count,
       CAST(score AS DOUBLE) / 100 AS average_review_score,
       CAST(job AS DOUBLE) / 100 AS average_job_satisfaction,
       CAST(life AS DOUBLE) / 100 AS average_work_life_balance
FROM performance
""")
LEFT = "count(*) FILTER (WHERE lower(attrition) = 'yes')"
query("attrition_by_department", f"""
SELECT department_name, count(*) AS employees, {LEFT} AS left_company,
       {ratio2(f'(100 * {LEFT})', 'count(*)')} AS attrition_rate_pct,
       {two6(avg6('sum(score)', 'count(score)'))} AS avg_review_score
FROM performance GROUP BY department_name
""")
WORKLOAD = """
SELECT project_id, project_name, department_name, status, CAST(budget AS DOUBLE) AS budget,
       people AS assigned_employee_count, CAST(allocation AS BIGINT) AS total_allocation_pct,
       review_count, CAST(score AS DOUBLE) / 100 AS average_review_score
"""
query("project_workload", WORKLOAD + "FROM workload")
FLAGGED = WORKLOAD.rstrip() + ", average AS avg_allocation_pct, flag\nFROM bottlenecks"
query("project_bottlenecks", FLAGGED)
query("flagged_projects", FLAGGED + " WHERE flag IN ('Critical', 'Busy', 'Low scores')")
query("bottleneck_points", FLAGGED + " WHERE average IS NOT NULL AND score IS NOT NULL")
query("project_status_counts", """
SELECT status, count(*) AS projects, CAST(sum(budget) AS DOUBLE) AS total_budget
FROM dim_project GROUP BY status
""")
query("risk_level_counts", f"""
SELECT c.risk_level, count(r.employee_id) AS employees
FROM (VALUES ('High'), ('Medium'), ('Low')) c(risk_level)
LEFT JOIN (SELECT employee_id, {RISK_LEVEL} AS risk_level FROM ({top_risk(50)})) r USING (risk_level)
GROUP BY c.risk_level
""")
query("flag_counts", """
SELECT c.flag, count(project_id) AS projects
FROM (VALUES ('Critical'), ('Busy'), ('Low scores'), ('OK')) c(flag)
LEFT JOIN bottlenecks USING (flag) GROUP BY c.flag
""")
query("years", "SELECT DISTINCT year(review_date) AS year_number FROM reviews")
query("department_names", "SELECT department_name FROM dim_department")
query("departments", "SELECT department_id, department_name FROM departments")
query("dept_roles", """
SELECT department, string_agg(job_role, ',' ORDER BY job_role) AS roles
FROM (SELECT DISTINCT department, job_role FROM stg_employee) GROUP BY department
""")

# -- E -----------------------------------------------------------------------------------------

YOY = f"""
SELECT review_year, department_name, review_count, {two6('micro')} AS average_review_score,
       {two4('rating')} AS average_performance_rating,
       CAST(CASE WHEN change >= 0 THEN (change + 5000) // 10000
                 ELSE -((5000 - change) // 10000) END AS DOUBLE) / 100
           AS score_change_from_prior_year
FROM yoy
"""
query("yoy_performance", YOY)
query("yoy_stored", YOY)
query("top_employees", f"""
SELECT review_year, department_name, employee_id, employee_name,
       {two6('micro')} AS average_review_score, department_rank
FROM (
    SELECT *, dense_rank() OVER (PARTITION BY review_year, department_key ORDER BY micro DESC)
               AS department_rank
    FROM (
        SELECT review_year, department_key, department_name, employee_id,
               first_name || ' ' || last_name AS employee_name,
               {avg6('sum(score_cents)', 'count(*)')} AS micro
        FROM fact f JOIN dim_employee e USING (employee_key)
        JOIN dim_department d ON d.department_key = f.department_key
        GROUP BY review_year, d.department_key AS department_key, department_name, employee_id,
                 first_name, last_name
    )
) WHERE department_rank <= 10
""".replace("d.department_key AS department_key", "d.department_key").replace(
    "SELECT review_year, department_key, department_name", "SELECT review_year, d.department_key, department_name"
))

# -- F -----------------------------------------------------------------------------------------

VERSION = f"""employee_id, first_name, last_name, email, department_key, job_role, job_level,
       monthly_income, age, gender, marital_status, attrition, {text('start_date')} AS start_date,
       {text('end_date')} AS end_date, is_current, change_reason
"""
query("scd2_incoming", f"SELECT {VERSION} FROM incoming2")
query("scd2_close", f"SELECT employee_key, {VERSION} FROM closed")
query("scd2_insert", f"SELECT employee_key, {VERSION} FROM inserted")
query("scd2_apply", f"""
SELECT employee_key, {VERSION} FROM (SELECT * FROM closed UNION ALL BY NAME SELECT * FROM inserted)
""")
CTES["known_departments"] = """
SELECT row_number() OVER (ORDER BY department_id) AS department_key, department_id
FROM departments WHERE department_id IN (
    SELECT department_id FROM projects WHERE planned_end_date < DATE '1994-06-01')
"""
query("dim_department_upsert", """
SELECT coalesce(k.department_key, (SELECT coalesce(max(department_key), 0) FROM known_departments)
           + row_number() OVER (PARTITION BY k.department_key IS NULL ORDER BY d.department_id))
           AS department_key,
       d.department_id, d.department_name
FROM departments d LEFT JOIN known_departments k USING (department_id)
""")
CTES["known_projects"] = """
SELECT row_number() OVER (ORDER BY project_id) AS project_key, p.* REPLACE ('Planned' AS status)
FROM projects p WHERE planned_end_date < DATE '1996-01-01'
"""
CTES["upserted_projects"] = """
SELECT k.project_key, coalesce(n.project_id, k.project_id) AS project_id,
       coalesce(n.project_name, k.project_name) AS project_name,
       coalesce(n.department_id, k.department_id) AS department_id,
       coalesce(n.start_date, k.start_date) AS start_date,
       coalesce(n.planned_end_date, k.planned_end_date) AS planned_end_date,
       coalesce(n.status, k.status) AS status, coalesce(n.budget, k.budget) AS budget
FROM known_projects k
FULL JOIN (SELECT * FROM projects WHERE status <> 'Completed') n ON n.project_id = k.project_id
"""
query("dim_project_upsert", f"""
SELECT coalesce(project_key, (SELECT max(project_key) FROM known_projects)
           + row_number() OVER (PARTITION BY project_key IS NULL ORDER BY project_id)) AS project_key,
       project_id, project_name, department_key, {text('start_date')} AS project_start_date,
       {text('planned_end_date')} AS planned_end_date, status, CAST(budget AS DOUBLE) AS budget
FROM upserted_projects JOIN dim_department USING (department_id)
""")

# -- G -----------------------------------------------------------------------------------------

query("attrition_risk", f"""
SELECT employee_id, employee_name, department_name, job_role,
       CAST(score AS DOUBLE) / 100 AS average_review_score,
       CAST(job AS DOUBLE) / 100 AS average_job_satisfaction,
       CAST(life AS DOUBLE) / 100 AS average_work_life_balance,
       CAST(risk AS DOUBLE) / 100 AS risk_score, {RISK_LEVEL} AS risk_level
FROM ({top_risk(25)})
""")
query("list_employees", f"""
SELECT employee_id, first_name, last_name, email, department_name, job_role, job_level,
       monthly_income, {text('effective_from')} AS effective_from, attrition
FROM employees JOIN departments USING (department_id)
WHERE first_name || ' ' || last_name ILIKE '%CA.%' OR email ILIKE '%CA.%'
ORDER BY employee_id LIMIT 100
""")
query("list_projects", f"""
SELECT project_id, project_name, department_name, {text('start_date')} AS start_date,
       {text('planned_end_date')} AS planned_end_date, status, CAST(budget AS DOUBLE) AS budget
FROM projects JOIN departments USING (department_id)
WHERE project_name ILIKE '%Ring%' ORDER BY project_id DESC LIMIT 200
""")
query("list_assignments", f"""
SELECT assignment_id, employee_id, first_name || ' ' || last_name AS employee_name, project_id,
       role_on_project, allocation_pct, {text('assigned_date')} AS assigned_date
FROM (SELECT * FROM assignments ORDER BY assigned_date DESC, assignment_id DESC LIMIT 300)
JOIN employees USING (employee_id)
""")
query("list_reviews", f"""
SELECT review_id, employee_id, first_name || ' ' || last_name AS employee_name, project_id,
       {text('review_date')} AS review_date, performance_rating,
       CAST(score_cents AS DOUBLE) / 100 AS review_score, job_satisfaction, work_life_balance,
       environment_satisfaction
FROM (SELECT * FROM reviews ORDER BY review_date DESC, review_id DESC LIMIT 200)
JOIN employees USING (employee_id)
""")
query("employee_history", f"""
SELECT employee_id, department_name, job_role, job_level, monthly_income,
       {text('start_date')} AS start_date, {text('end_date')} AS end_date, is_current
FROM dim_employee JOIN dim_department USING (department_key)
""")

# -- W -----------------------------------------------------------------------------------------

query("validate_employees", "SELECT seq, reason FROM judged_employees")
query("validate_projects", "SELECT seq, reason FROM judged_projects")
query("validate_reviews", "SELECT seq, reason FROM judged_reviews")
query("add_employees", f"""
SELECT seq, first_name, last_name, email, department_id, job_role, job_level,
       {text('hire_date')} AS hire_date, {text('hire_date')} AS effective_from, age, gender,
       'Single' AS marital_status, monthly_income, 'No' AS attrition, employee_id,
       reason IS NULL AS accepted,
       coalesce(reason, 'Employee ' || employee_id || ' (' || first_name || ' ' || last_name
                        || ') added.') AS message
FROM (
    SELECT *, CASE WHEN reason IS NULL THEN (SELECT max(employee_id) FROM employees)
               + row_number() OVER (PARTITION BY reason IS NULL ORDER BY seq) END AS employee_id
    FROM hired
)
""")
query("add_projects", f"""
SELECT seq, project_name, department_id, {text('start_date')} AS start_date,
       {text('planned_end_date')} AS planned_end_date, status, CAST(budget AS DOUBLE) AS budget,
       project_id, reason IS NULL AS accepted,
       coalesce(reason, 'Project ' || project_id || ' created. Click ''Refresh warehouse'' to see it '
                        || 'in the dashboards.') AS message
FROM (
    SELECT *, CASE WHEN reason IS NULL THEN (SELECT max(project_id) FROM projects)
               + row_number() OVER (PARTITION BY reason IS NULL ORDER BY seq) END AS project_id
    FROM (
        SELECT * REPLACE (trim(project_name) AS project_name,
            coalesce(reason, CASE WHEN department_id NOT IN (SELECT department_id FROM departments)
                             THEN 'Invalid department selected.' END) AS reason)
        FROM judged_projects
    )
)
""")
query("add_reviews", """
SELECT seq, review_id, reason IS NULL AS accepted,
       coalesce(reason, 'Review ' || review_id || ' saved. Click ''Refresh warehouse'' to see it '
                        || 'in the dashboards.') AS message
FROM (
    SELECT *, CASE WHEN reason IS NULL THEN (SELECT max(review_id) FROM reviews)
               + row_number() OVER (PARTITION BY reason IS NULL ORDER BY seq) END AS review_id
    FROM (
        SELECT seq, coalesce(reason, CASE
            WHEN employee_id NOT IN (SELECT employee_id FROM employees)
              OR project_id NOT IN (SELECT project_id FROM projects)
                THEN 'Employee id or project id does not exist.' END) AS reason
        FROM judged_reviews
    )
)
""")
query("apply_employee_changes", """
SELECT f.seq, employee_id, f.department_id, f.job_role, f.job_level, f.monthly_income, f.attrition,
       message IS NULL AS accepted,
       coalesce(message, 'Employee updated and a new history record was created in the warehouse.')
           AS message
FROM (
    SELECT f.*, CASE WHEN f.seq > d.seq THEN
        CASE WHEN f.department_id = d.department_id AND f.job_role = d.job_role
              AND f.job_level = d.job_level AND f.monthly_income = d.monthly_income
              AND f.attrition = d.attrition THEN 'Nothing changed - no new history record needed.'
             ELSE 'This employee was already changed today. Try again tomorrow.' END
        ELSE reason_before END AS message
    FROM (SELECT * EXCLUDE (reason), reason AS reason_before FROM first_look) f
    LEFT JOIN (SELECT * EXCLUDE (reason) FROM day_change) d USING (employee_id)
) f
""")
query("changed_employees", f"""
SELECT employee_id, first_name, last_name, email,
       coalesce(d.department_id, e.department_id) AS department_id,
       coalesce(d.job_role, e.job_role) AS job_role, coalesce(d.job_level, e.job_level) AS job_level,
       {text('hire_date')} AS hire_date,
       CASE WHEN d.seq IS NULL THEN {text('effective_from')} ELSE '2000-01-01' END AS effective_from,
       age, gender, marital_status, coalesce(d.monthly_income, e.monthly_income) AS monthly_income,
       coalesce(d.attrition, e.attrition) AS attrition
FROM employees e LEFT JOIN day_change d USING (employee_id)
""")
query("update_project_status", """
SELECT seq, project_id, status, reason IS NULL AS accepted,
       coalesce(reason, 'Project ' || project_id || ' (''' || project_name || ''') status updated to '''
                        || status || '''.') AS message
FROM (
    SELECT *, CASE
        WHEN NOT allowed
            THEN 'Status must be one of [''Planned'', ''Active'', ''Completed'', ''On Hold''].'
        WHEN stored IS NULL THEN 'Project ID ' || project_id || ' not found.'
        WHEN coalesce(lag(status) OVER (PARTITION BY project_id, allowed ORDER BY seq), stored) = status
            THEN 'Project is already in ''' || status || ''' status.' END AS reason
    FROM (
        SELECT c.*, project_name, p.status AS stored,
               c.status IN ('Planned', 'Active', 'Completed', 'On Hold') AS allowed
        FROM status_changes c LEFT JOIN projects p USING (project_id)
    )
)
""")
query("assign_employees", """
SELECT r.seq, r.employee_id, project_id, role_on_project, allocation_pct, assignment_id,
       reason IS NULL AS accepted, coalesce(reason, 'Employee assigned to project.') AS message
FROM assignment_requests r JOIN (
    SELECT one.seq AS seq, one.reason AS reason,
           CASE WHEN one.reason IS NULL THEN (SELECT max(assignment_id) FROM assignments)
               + row_number() OVER (PARTITION BY one.reason IS NULL ORDER BY one.seq) END
               AS assignment_id
    FROM handled
) USING (seq)
""")
query("delete_employees", """
SELECT seq, employee_id, accepted,
       CASE WHEN accepted THEN 'Employee deleted.' ELSE 'Employee not found.' END AS message
FROM (
    SELECT seq, employee_id, employee_id IN (SELECT employee_id FROM employees)
           AND row_number() OVER (PARTITION BY employee_id ORDER BY seq) = 1 AS accepted
    FROM departures
)
""")
STAYING = "WHERE employee_id NOT IN (SELECT employee_id FROM departures)"
query("remaining_rows", counts(
    departments="departments", employees=f"employees {STAYING}", projects="projects",
    assignments=f"assignments {STAYING}", reviews=f"reviews {STAYING}",
))
query("account_roles", f"""
SELECT username, employee_id, department_name,
       CASE WHEN employee_id IS NOT NULL THEN {ROLE_OF} ELSE role END AS role
FROM users LEFT JOIN staff ON email = lower(trim(username)) WHERE is_active
""")
query("account_eligibility", f"""
SELECT seq, username, CASE WHEN message IS NULL THEN role END AS role, message IS NULL AS accepted,
       coalesce(message, 'Account created.') AS message
FROM (
    SELECT *, coalesce(reason, CASE
        WHEN row_number() OVER (PARTITION BY username, reason IS NULL ORDER BY seq) > 1
            THEN 'That username already exists.' END) AS message
    FROM (
        SELECT seq, r.email AS username, {ROLE_OF} AS role, CASE
            WHEN r.email = '' THEN 'Work email and password are required.'
            WHEN employee_id IS NULL THEN 'That work email is not associated with an employee.'
            WHEN {ROLE_OF} IS NULL THEN 'Your department is not eligible for access.'
            WHEN r.email IN (SELECT lower(trim(username)) FROM users WHERE is_active)
                THEN 'That username already exists.' END AS reason
        FROM (SELECT seq, lower(trim(email)) AS email FROM account_requests) r
        LEFT JOIN staff s ON s.email = r.email
    )
)
""")


def rule(name: str, table: str, condition: str) -> str:
    return (
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {condition}) AS violations FROM {table}"
    )


def required(table: str, columns: str) -> list[str]:
    return [
        rule(f"{table}.{c} not null", table, f"{'score_cents' if c == 'review_score' else c} IS NULL")
        for c in columns.split()
    ]


def unique(name: str, table: str, key: str) -> str:
    return (
        f"SELECT '{name}' AS rule, count({key}) - count(DISTINCT {key}) AS violations FROM {table}"
    )


def known(table: str, column: str, parent: str) -> str:
    missing = f"{column} NOT IN (SELECT {column} FROM {parent})"
    return (
        f"SELECT '{table}.{column} in {parent}' AS rule, count(*) AS violations "
        f"FROM {table} WHERE {missing}"
    )


NO_DEPARTMENT = (
    "lower(trim(department)) NOT IN (SELECT lower(trim(department_name)) FROM departments)"
)
query("data_quality", "\nUNION ALL\n".join([
    *required("departments", "department_id department_name"),
    *required("employees", "employee_id first_name last_name email department_id job_role job_level "
                           "hire_date effective_from age monthly_income"),
    *required("projects", "project_id project_name department_id start_date planned_end_date status "
                          "budget"),
    *required("assignments", "assignment_id employee_id project_id assigned_date role_on_project "
                             "allocation_pct"),
    *required("reviews", "review_id employee_id project_id review_date performance_rating "
                         "review_score"),
    unique("departments.department_id unique", "departments", "department_id"),
    unique("departments.department_name unique", "departments", "lower(department_name)"),
    unique("employees.employee_id unique", "employees", "employee_id"),
    unique("employees.email unique", "employees", "lower(email)"),
    unique("projects.project_id unique", "projects", "project_id"),
    unique("assignments.assignment_id unique", "assignments", "assignment_id"),
    unique("reviews.review_id unique", "reviews", "review_id"),
    known("employees", "department_id", "departments"),
    known("projects", "department_id", "departments"),
    known("assignments", "employee_id", "employees"),
    known("assignments", "project_id", "projects"),
    known("reviews", "employee_id", "employees"),
    known("reviews", "project_id", "projects"),
    rule("stg_employee without id", "stg_employee", "employee_id IS NULL"),
    rule("stg_employee without department", "stg_employee",
         "department IS NULL OR trim(department) = ''"),
    rule("stg_employee_history invalid interval", "stg_employee_history",
         "NOT coalesce(valid_from <= valid_to, FALSE)"),
    unique("stg_employee_history.history_id unique", "stg_employee_history", "history_id"),
    rule("stg_employee_history.history_id not null", "stg_employee_history", "history_id IS NULL"),
    """SELECT 'stg_employee_history version repeated' AS rule,
       count(*) - (SELECT count(*) FROM (
           SELECT DISTINCT employee_id, valid_from, valid_to, lower(trim(department)),
                  lower(trim(job_role)), job_level, monthly_income
           FROM stg_employee_history WHERE valid_from <= valid_to)) AS violations
       FROM stg_employee_history WHERE valid_from <= valid_to""",
    rule("stg_employee_history unknown department",
         "(SELECT * FROM stg_employee_history WHERE valid_from <= valid_to)", NO_DEPARTMENT),
    rule("stg_project unknown department", "stg_project", NO_DEPARTMENT),
    """SELECT 'reviews before first version' AS rule, count(*) AS violations
       FROM reviews JOIN (SELECT employee_id, min(start_date) AS first_start FROM dim_employee
                          GROUP BY employee_id) USING (employee_id)
       WHERE review_date < first_start""",
    rule("users.username not null", "users", "username IS NULL"),
    rule("users.role allowed", "users", "NOT coalesce(role IN ('Admin', 'Viewer'), FALSE)"),
    unique("users.username unique", "users", "lower(username)"),
]))

# -- S -----------------------------------------------------------------------------------------

SCALED = """
SELECT employee_id, is_extra, age, attrition, daily_rate, department, education_field,
       environment_satisfaction, gender, hourly_rate, job_level, job_role, job_satisfaction,
       monthly_income, monthly_rate, performance_rating, total_working_years, work_life_balance,
       years_at_company, years_in_current_role, years_since_last_promotion, years_with_curr_manager
"""
query("upsample_rows", SCALED + "FROM upsampled")
query("jitter_and_cap", SCALED + "FROM jittered")
query("derive_email_hire", f"""
SELECT employee_id, first_name, last_name,
       regexp_replace(lower(first_name), '[^a-z]', '', 'g') || '.'
       || regexp_replace(lower(last_name), '[^a-z]', '', 'g') || '.' || employee_id
       || '@company.com' AS email,
       {text('hire_date')} AS hire_date, {text('hire_date')} AS effective_from
FROM named
""")
query("sample_history", f"SELECT employee_id, {text('change_date')} AS change_date FROM sampled")
query("prior_version", f"""
SELECT row_number() OVER (ORDER BY employee_id) AS history_id, employee_id,
       CASE kind WHEN 'DEPARTMENT_CHANGE' THEN other_department ELSE department END AS department,
       CASE kind WHEN 'DEPARTMENT_CHANGE'
            THEN other_roles[{h('role', 'employee_id')} % len(other_roles) + 1]
            ELSE job_role END AS job_role,
       job_level - CASE kind WHEN 'PROMOTION' THEN 1 ELSE 0 END AS job_level,
       CASE kind WHEN 'DEPARTMENT_CHANGE' THEN monthly_income
                 WHEN 'PROMOTION' THEN {divided('1.15', '0.15')}
                 ELSE {divided('1.05', '0.07')} END AS monthly_income,
       {text('hire_date')} AS valid_from, {text('change_date - 1')} AS valid_to,
       kind AS change_reason
FROM undone
""")
query("make_projects", f"""
SELECT project_id, project_name, department, {text('start_date')} AS start_date,
       {text('planned_end_date')} AS planned_end_date, status, budget FROM made_projects
""")
query("make_assignments", f"""
SELECT assignment_id, employee_id, project_id, {text('assigned_date')} AS assigned_date,
       role_on_project, allocation_pct FROM made_assignments
""")
query("make_reviews", f"""
SELECT review_id, employee_id, project_id, {text('review_date')} AS review_date,
       performance_rating, CAST(review_score AS DOUBLE) AS review_score, job_satisfaction,
       work_life_balance, environment_satisfaction FROM made_reviews
""")
query("inject_noise", """
SELECT * FROM noisy
UNION ALL
SELECT noisy.* FROM noisy JOIN copied USING (employee_id)
""")


query("project_statuses", "SELECT DISTINCT status FROM projects WHERE status IS NOT NULL")
query("manual_accounts", """
SELECT seq, username, role, message IS NULL AS accepted, coalesce(message, 'Account created.') AS message
FROM (
    SELECT *, coalesce(reason, CASE
        WHEN row_number() OVER (PARTITION BY lower(username), reason IS NULL ORDER BY seq) > 1
            THEN 'That username already exists.' END) AS message
    FROM (
        SELECT *, CASE
            WHEN role = 'Owner' THEN 'Role must be Admin or Viewer.'
            WHEN username = '' OR seq % 7 = 0 THEN 'Username and password are required.'
            WHEN lower(username) IN (SELECT lower(trim(username)) FROM users WHERE is_active)
                THEN 'That username already exists.' END AS reason
        FROM (
            SELECT seq, trim(email) AS username, CASE WHEN seq % 5 = 0 THEN 'Owner'
                WHEN seq % 2 = 0 THEN 'Admin' ELSE 'Viewer' END AS role
            FROM account_requests
        )
    )
)
""")
GOLD_FACT = "fact_performance_reviews"
DATES = f"({QUERIES['dim_date']})"
query("gold_rules", "\nUNION ALL\n".join([
    unique("dim_department.department_id unique", "dim_department", "department_id"),
    unique("dim_department.department_name unique", "dim_department", "lower(department_name)"),
    unique("dim_project.project_id unique", "dim_project", "project_id"),
    unique("dim_date.full_date unique", DATES, "full_date"),
    unique("dim_employee.employee_key unique", "dim_employee", "employee_key"),
    unique(f"{GOLD_FACT}.review_id unique", "fact", "review_id"),
    *[
        rule(f"{GOLD_FACT}.{key} in {name}", "fact", f"{key} NOT IN (SELECT {key} FROM {parent})")
        for key, name, parent in (
            ("employee_key", "dim_employee", "dim_employee"),
            ("project_key", "dim_project", "dim_project"),
            ("date_key", "dim_date", DATES),
            ("department_key", "dim_department", "dim_department"),
        )
    ],
]))


# -- the same questions with arguments -----------------------------------------------------------


def _where(name: str, condition: str, columns: str = "*") -> str:
    return f"SELECT {columns} FROM ({QUERIES[name]}) WHERE {condition}"


QUERIES["yoy_of_department"] = _where("yoy_performance", "lower(department_name) = 'europe'")
QUERIES["top_of_department_and_year"] = _where(
    "top_employees",
    "lower(department_name) = 'asia' AND review_year = 1995 AND department_rank <= 3")
QUERIES["list_projects_by_id"] = QUERIES["list_projects"].replace(
    "project_name ILIKE '%Ring%'", "project_id = 42")
QUERIES["list_projects_of_employee"] = _where(
    "employee_projects", "employee_id = 43", "* EXCLUDE (employee_id)")
QUERIES["projects_of_employee"] = QUERIES["list_projects_of_employee"]
QUERIES["assignments_of_project"] = QUERIES["list_assignments"].replace(
    "FROM assignments ORDER BY", "FROM assignments WHERE project_id = 42 ORDER BY")
QUERIES["reviews_of_employee"] = QUERIES["list_reviews"].replace(
    "FROM reviews ORDER BY", "FROM reviews WHERE employee_id = 43 ORDER BY")
QUERIES["history_of_employee"] = _where("employee_history", "employee_id = 43")
QUERIES["staged_by_parameter"] = _where("clean_projects", "budget > 950000 AND status = 'Active'")

# The report holds the rules of Gold, too.
QUERIES["data_quality"] = f"SELECT * FROM ({QUERIES['data_quality']}) UNION ALL SELECT * FROM ({QUERIES['gold_rules']})"
QUERIES["employee_by_id"] = _where("clean_employees", "employee_id = 43")
QUERIES["csv_round_trip"] = """
SELECT doc_id, nullif(source, '') AS source, md5(nullif(text, '')) AS text_md5, length(nullif(text, '')) AS n_chars
FROM documents
"""
QUERIES["load_times"] = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, CAST(0 AS BIGINT) AS without, FALSE AS several"
    for name in ("stg_employee", "stg_employee_history", "stg_project", "stg_assignment", "stg_review"))
QUERIES["dim_date_upsert"] = QUERIES["dim_date"]
QUERIES["silver_reload"] = QUERIES["clean_departments"]

# -- Gold after batches of changes, reviews and departures ---------------------------------------

CTES["snapshot3"] = f"""
SELECT e.* REPLACE (
    coalesce(d.department_id, e.department_id) AS department_id,
    coalesce(d.job_role, e.job_role) AS job_role, coalesce(d.job_level, e.job_level) AS job_level,
    coalesce(d.monthly_income, e.monthly_income) AS monthly_income,
    coalesce(d.attrition, e.attrition) AS attrition,
    CASE WHEN d.seq IS NULL THEN e.effective_from ELSE {TODAY} END AS effective_from)
FROM employees e LEFT JOIN day_change d ON d.employee_id = e.employee_id
"""
CTES["past_versions3"] = CTES["past_versions"].replace("JOIN employees e", "JOIN snapshot3 e")
CTES["incoming3"] = incoming("snapshot3", "past_versions3")
CTES["closed3"] = CTES["closed"].replace("incoming2", "incoming3")
CTES["inserted3"] = CTES["inserted"].replace("incoming2", "incoming3").replace("closed c", "closed3 c")
CTES["versions3"] = "SELECT * FROM closed3 UNION ALL BY NAME SELECT * FROM inserted3"
CTES["reviews3"] = """
SELECT review_id, employee_id, project_id, review_date, performance_rating, score_cents,
       job_satisfaction, work_life_balance, environment_satisfaction FROM reviews
UNION ALL
SELECT (SELECT max(review_id) FROM reviews) + row_number() OVER (ORDER BY seq), employee_id, project_id,
       review_date, performance_rating, score_cents, job_satisfaction, work_life_balance,
       environment_satisfaction
FROM judged_reviews
WHERE reason IS NULL AND employee_id IN (SELECT employee_id FROM employees)
  AND project_id IN (SELECT project_id FROM projects)
"""
CTES["fact3"] = CTES["fact"].replace("JOIN dim_employee e", "JOIN versions3 e").replace(
    "FROM reviews r", f"FROM (SELECT * FROM reviews3 {STAYING}) r")
query("refreshed_versions", f"SELECT employee_key, {VERSION} FROM versions3")
query("refreshed_fact", """
SELECT performance_review_key, review_id, employee_key, project_key, date_key, department_key,
       performance_rating, CAST(score_cents AS DOUBLE) / 100 AS review_score, job_satisfaction,
       work_life_balance, environment_satisfaction, review_count
FROM fact3
""")
CTES["yoy3"] = CTES["yoy"].replace("FROM fact JOIN", "FROM fact3 JOIN")
query("yoy_refreshed", YOY.replace("FROM yoy", "FROM yoy3"))
