"""Enriched views over the synchronised tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.functions.columns import is_set
from ticketlake.operators.lookups import lookup_join, resolve_roles

# Id column of an incident -> prefix of the columns looked up for it.
ROLES = {"resolved_by": "resolved_by", "opened_by": "opened_by", "caller_id": "caller"}


def users_with_company(user: DataFrame, company: DataFrame) -> DataFrame:
    names = company.select(F.col("sys_id").alias("_company_id"), F.col("name").alias("company_name"))
    joined = lookup_join(user, names, "company", "_company_id", "left", spread_by=["sys_id"])
    return joined.select(
        "sys_id", "user_name", "name", "first_name", "last_name", "email", "phone", "active",
        F.col("company").alias("company_id"), "company_name",
        "department", "title", "last_login", "sys_created_on", "etl_updated_at",
    )


def companies_with_stats(company: DataFrame, user: DataFrame) -> DataFrame:
    """User count per company; users are counted before the join."""
    counts = (
        user.where(F.col("company").isNotNull() & F.col("sys_id").isNotNull())
        .groupBy(F.col("company").alias("_company_id"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return company.join(counts, F.col("sys_id") == F.col("_company_id"), "left").select(
        "sys_id", "name", "active", "customer", "vendor", "phone", "website", "city", "state", "country",
        F.coalesce("_n", F.lit(0)).alias("user_count"),
        "sys_created_on", "etl_updated_at",
    )


def incident_enriched(incident: DataFrame, company: DataFrame, user: DataFrame, **kw) -> DataFrame:
    """All incident columns plus company and user details."""
    details = company.select(
        F.col("sys_id").alias("_company_id"),
        *[F.col(c).alias(f"company_{c}") for c in ("name", "phone", "city", "state", "country")],
    )
    placed = lookup_join(incident, details, "company", "_company_id", "left", spread_by=["sys_id"])
    attributes = {"user_name": "username", "name": "name", "email": "email"}
    return resolve_roles(placed, user, ROLES, attributes, **kw)


def incident_summary(incident: DataFrame, company: DataFrame, user: DataFrame, **kw) -> DataFrame:
    """Nine incident columns plus names."""
    names = company.select(F.col("sys_id").alias("_company_id"), F.col("name").alias("company_name"))
    columns = [
        "sys_id", "number", "short_description", "state", "priority", "urgency", "impact", "opened_at", "closed_at",
    ]
    rows = incident.select(*columns, "company", *ROLES)
    placed = lookup_join(rows, names, "company", "_company_id", "left", spread_by=["sys_id"])
    out = resolve_roles(placed, user, ROLES, {"name": "name"}, **kw)
    return out.select(*columns, "company_name", "resolved_by_name", "opened_by_name", "caller_name")


def active_users_with_company(user: DataFrame, company: DataFrame) -> DataFrame:
    return users_with_company(user.where(is_set(user, "active")), company)


def customer_companies(company: DataFrame, user: DataFrame) -> DataFrame:
    return companies_with_stats(company.where(is_set(company, "customer")), user)


def top_companies(company: DataFrame, user: DataFrame, n: int = 10) -> DataFrame:
    return companies_with_stats(company, user).orderBy(F.desc("user_count"), "sys_id").limit(n)


def top_enriched(incident: DataFrame, company: DataFrame, user: DataFrame, n: int = 10) -> DataFrame:
    """The first n enriched incidents by id.

    The lookups neither drop nor repeat incidents (reference ids are unique), so
    the n rows are chosen first and only those are looked up.
    """
    return incident_enriched(incident.orderBy("sys_id").limit(n), company, user).orderBy("sys_id")


def incidents_by_company(incident: DataFrame) -> DataFrame:
    return incident.groupBy("company").agg(F.count(F.lit(1)).alias("incident_count"))


def incident_count(incident: DataFrame) -> DataFrame:
    return incident.agg(F.count(F.lit(1)).alias("incident_count"))


def in_state(summary: DataFrame, state: str = "6") -> DataFrame:
    return summary.where(F.col("state") == state)


def resolved_for_company(incident: DataFrame, company_id: str) -> DataFrame:
    return incident.where((F.col("company") == company_id) & F.col("resolved_by").isNotNull())
