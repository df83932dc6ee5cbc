"""Views, integrity, missing references, change detection."""

from __future__ import annotations

from ticketlake.functions import columns as C
from ticketlake.operators import integrity, normalize, sync, views
from ticketlake_queries.registry import hash_sql, query
from ticketlake_queries.shapes import Data
from ticketlake_queries.shaping import SUMMARY

# The columns of a user and of a company as the views show them.
USER_COLUMNS = "sys_id, user_name, name, first_name, last_name, email, phone, active, department, title, last_login, sys_created_on, etl_updated_at"
COMPANY_COLUMNS = "sys_id, name, active, customer, vendor, phone, website, city, state, country, sys_created_on, etl_updated_at"

# A user works for the one company that has the user's company id.
WITH_COMPANY = f"""
SELECT * FROM (
  SELECT {USER_COLUMNS}, company AS company_id,
         (SELECT max(name) FROM company WHERE company.sys_id = usr.company) AS company_name
  FROM usr) AS person
"""


@query("users_with_company", WITH_COMPANY)
def users_with_company(d: Data):
    return views.users_with_company(d.usr, d.company)


@query("active_users_with_company", WITH_COMPANY + "WHERE active = 1")
def active_users_with_company(d: Data):
    return views.active_users_with_company(d.usr, d.company)


# How many users name a company is counted before companies are looked at.
STATS = f"""
WITH staff AS (SELECT company AS employer, count(*) AS heads FROM usr WHERE company IS NOT NULL GROUP BY employer)
SELECT {COMPANY_COLUMNS},
       coalesce((SELECT heads FROM staff WHERE employer = company.sys_id), 0) AS user_count
FROM company
"""


@query("companies_with_stats", STATS)
def companies_with_stats(d: Data):
    return views.companies_with_stats(d.company, d.usr)


@query("customer_companies", f"SELECT * FROM ({STATS}) AS s WHERE customer = 1")
def customer_companies(d: Data):
    return views.customer_companies(d.company, d.usr)


@query("top_companies", f"SELECT * FROM ({STATS}) AS s ORDER BY user_count DESC, sys_id LIMIT 10")
def top_companies(d: Data):
    return views.top_companies(d.company, d.usr, 10)


# Each id column of an incident with the reference table it points to and the prefix of what is looked up (fixed values).
ROLES = {"resolved_by": "resolved_by", "opened_by": "opened_by", "caller_id": "caller"}
PLACE = ["name", "phone", "city", "state", "country"]
PERSON = {"user_name": "username", "name": "name", "email": "email"}


def looked_up(table: str, column: str, key: str, name: str) -> str:
    return f"(SELECT max({column}) FROM {table} WHERE {table}.sys_id = incident.{key}) AS {name}"


ENRICHED = "SELECT *, {} FROM incident ".format(
    ", ".join(
        [looked_up("company", c, "company", f"company_{c}") for c in PLACE]
        + [looked_up("usr", c, key, f"{role}_{shown}") for key, role in ROLES.items() for c, shown in PERSON.items()]
    )
)


@query("incident_enriched", ENRICHED)
def incident_enriched(d: Data):
    return views.incident_enriched(d.incident, d.company, d.usr)


@query("top_enriched", ENRICHED + "ORDER BY sys_id LIMIT 10")
def top_enriched(d: Data):
    return views.top_enriched(d.incident, d.company, d.usr, 10)


@query("incident_summary", SUMMARY)
def incident_summary(d: Data):
    return views.incident_summary(d.incident, d.company, d.usr)


# The user names a company, and no company answers to that name.
ORPHAN_USERS = """
SELECT sys_id, user_name, name, company FROM usr
WHERE company IS NOT NULL AND NOT EXISTS (FROM company WHERE company.sys_id = usr.company)
"""


@query("orphan_users", ORPHAN_USERS)
def orphan_users(d: Data):
    return integrity.orphan_users(d.usr, d.company)


@query(
    "orphan_incidents",
    "SELECT count(*) AS orphan_count FROM incident "
    "WHERE company IS NOT NULL AND company NOT IN (SELECT sys_id FROM company WHERE sys_id IS NOT NULL)",
)
def orphan_incidents(d: Data):
    return integrity.orphan_incidents(d.incident, d.company)


CHILDLESS = """
SELECT sys_id, name, CAST(0 AS BIGINT) AS user_count FROM company
WHERE NOT EXISTS (FROM usr WHERE usr.company = company.sys_id)
"""


@query("childless_companies", CHILDLESS)
def childless_companies(d: Data):
    return integrity.childless_companies(d.company, d.usr)


@query(
    "reference_integrity",
    f"""
    SELECT 'users without a valid company' AS issue, sys_id, user_name, name, company, CAST(NULL AS BIGINT) AS user_count
    FROM ({ORPHAN_USERS}) AS a
    UNION ALL
    SELECT 'companies without users', sys_id, NULL, name, NULL, user_count FROM ({CHILDLESS}) AS b
    """,
)
def reference_integrity(d: Data):
    return integrity.reference_integrity(d.usr, d.company)


@query("distinct_ids", "SELECT DISTINCT company AS company_id FROM incident WHERE company IS NOT NULL")
def distinct_ids(d: Data):
    return integrity.distinct_ids(d.incident, ["company"], "company_id")


ALL_IDS = """
SELECT resolved_by AS user_id FROM incident WHERE resolved_by IS NOT NULL
UNION SELECT opened_by FROM incident WHERE opened_by IS NOT NULL
UNION SELECT caller_id FROM incident WHERE caller_id IS NOT NULL
"""


@query("union_distinct_ids", ALL_IDS)
def union_distinct_ids(d: Data):
    return integrity.distinct_ids(d.incident, ["resolved_by", "opened_by", "caller_id"], "user_id")


MISSING_COMPANIES = """
SELECT DISTINCT company AS company_id FROM incident WHERE company IS NOT NULL AND company NOT IN (SELECT sys_id FROM company)
"""


@query("missing_company_ids", MISSING_COMPANIES)
def missing_company_ids(d: Data):
    return integrity.missing_company_ids(d.incident, d.company)


@query("missing_user_ids", f"SELECT user_id FROM ({ALL_IDS}) AS a WHERE user_id NOT IN (SELECT sys_id FROM usr)")
def missing_user_ids(d: Data):
    return integrity.missing_user_ids(d.incident, d.usr)


@query(
    "sync_missing",
    """
    WITH loaded AS (SELECT sys_id FROM usr WHERE department <> 'MACHINERY')
    SELECT sys_id, user_name, name, department FROM usr WHERE sys_id IN (
      SELECT user_id FROM (SELECT resolved_by AS user_id FROM incident UNION SELECT opened_by FROM incident
                           UNION SELECT caller_id FROM incident) AS a WHERE user_id IS NOT NULL)
    AND sys_id NOT IN (SELECT sys_id FROM loaded)
    """,
)
def sync_missing(d: Data):
    source = d.usr  # the resource; one department has not been loaded yet
    missing = integrity.missing_user_ids(d.incident, source.where("department <> 'MACHINERY'"))
    return sync.reference_by_ids(source, missing).select("sys_id", "user_name", "name", "department")


_TRACKED = ["sys_id", "name", "department"]


@query(
    "changed_rows",
    f"""
    WITH incoming AS (
      SELECT sys_id, name, department, seq, {hash_sql(_TRACKED)} AS etl_hash FROM user_changes
    ), stored AS (SELECT sys_id, {hash_sql(_TRACKED)} AS etl_hash FROM usr)
    SELECT i.sys_id, i.name, i.department, i.seq, i.etl_hash, CASE WHEN s.sys_id IS NULL THEN 'new' ELSE 'modified' END AS change_type
    FROM incoming AS i LEFT JOIN stored AS s ON i.sys_id = s.sys_id
    WHERE s.sys_id IS NULL OR s.etl_hash <> i.etl_hash
    """,
)
def changed_rows(d: Data):
    changes = d.user_changes
    incoming = changes.withColumn("etl_hash", C.row_hash(_TRACKED))
    stored = normalize.add_row_hash(d.usr.select(*_TRACKED))
    return sync.changed_rows(incoming, stored)
