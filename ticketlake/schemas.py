"""Entities: field lists, typed schemas, defaults and references between them."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Field lists of the source resources, in source order.
# ---------------------------------------------------------------------------
INCIDENT_FIELDS = [
    "sys_id", "number",
    "state", "incident_state", "active", "resolved_at", "closed_at",
    "priority", "urgency", "impact", "severity",
    "category", "subcategory", "u_subcategory_detail",
    "company", "assignment_group", "assigned_to", "caller_id",
    "resolved_by", "opened_by", "closed_by",
    "short_description", "description", "close_notes", "resolution_notes",
    "location",
    "cmdb_ci", "business_service",
    "business_stc", "calendar_stc", "resolve_time",
    "reopen_count", "reopened_time",
    "parent_incident", "problem_id", "change_request",
    "sys_created_on", "sys_created_by", "sys_updated_on", "sys_updated_by",
    "opened_at", "time_worked",
]

USER_FIELDS = [
    "sys_id", "user_name", "name", "first_name", "last_name", "middle_name",
    "email", "phone", "mobile_phone",
    "company", "department", "location", "manager", "title",
    "active", "locked_out", "web_service_access_only",
    "last_login", "last_login_time", "failed_attempts",
    "time_zone", "date_format", "time_format",
    "sys_created_on", "sys_created_by", "sys_updated_on", "sys_updated_by",
]

COMPANY_FIELDS = [
    "sys_id", "name", "parent",
    "customer", "vendor", "manufacturer",
    "phone", "fax", "website",
    "street", "city", "state", "zip", "country",
    "federal_tax_id",
    "active",
    "sys_created_on", "sys_created_by", "sys_updated_on", "sys_updated_by",
]

# Lineage columns, company flags, and the reference columns of an incident.
LINEAGE_FIELDS = ["etl_created_at", "etl_updated_at", "etl_hash"]
COMPANY_FLAGS = ["customer", "vendor", "manufacturer", "active"]
COMPANY_TYPES = ["customer", "vendor", "manufacturer"]
REFERENCE_ID_FIELDS = ["company", "resolved_by", "opened_by", "caller_id"]
USER_ROLE_FIELDS = ["resolved_by", "opened_by", "caller_id"]

# Tracked-column rule of the change hash: these never count as a change.
HASH_IGNORED_FIELDS = ["sys_created_on", "sys_updated_on"]
HASH_IGNORED_PREFIX = "etl_"

DERIVED_PREFIX = "dv_"
PAGE_LIMIT = 10_000
# ---------------------------------------------------------------------------


def strings(fields: list[str]) -> T.StructType:
    """All-string landing schema."""
    return T.StructType([T.StructField(f, T.StringType()) for f in fields])


INCIDENT = strings(INCIDENT_FIELDS)
USER = strings(USER_FIELDS)
COMPANY = strings(COMPANY_FIELDS)


def _table(ddl: list[tuple[str, T.DataType, int | None, bool, str | None]]) -> list["TypedField"]:
    return [TypedField(*row) for row in ddl]


class TypedField:
    """One column of a typed table: type, longest text, required, default (SQL text)."""

    def __init__(self, name, dtype, max_length=None, required=False, default=None):
        self.name, self.dtype, self.max_length = name, dtype, max_length
        self.required, self.default = required, default


_S, _B, _I, _D, _TS = T.StringType(), T.BooleanType(), T.IntegerType(), T.DateType(), T.TimestampNTZType()
NOW = "as_of"  # default marker: the run's as-of timestamp

_AUDIT = [
    ("sys_created_on", _TS, None, False, None),
    ("sys_created_by", _S, 40, False, None),
    ("sys_updated_on", _TS, None, False, None),
    ("sys_updated_by", _S, 40, False, None),
    ("etl_created_at", _TS, None, False, NOW),
    ("etl_updated_at", _TS, None, False, NOW),
    ("etl_hash", _S, 64, False, None),
]

# Types, lengths and defaults of the typed tables.
TYPED_TABLES: dict[str, list[TypedField]] = {
    "company": _table([
        ("sys_id", _S, 32, True, None),
        ("name", _S, 255, True, None),
        ("parent", _S, 32, False, None),
        ("customer", _B, None, False, "false"),
        ("vendor", _B, None, False, "false"),
        ("manufacturer", _B, None, False, "false"),
        ("phone", _S, 40, False, None),
        ("fax", _S, 40, False, None),
        ("website", _S, 1024, False, None),
        ("street", _S, 255, False, None),
        ("city", _S, 40, False, None),
        ("state", _S, 40, False, None),
        ("zip", _S, 40, False, None),
        ("country", _S, 40, False, None),
        ("federal_tax_id", _S, 40, False, None),
        ("active", _B, None, False, "true"),
        *_AUDIT,
    ]),
    "user": _table([
        ("sys_id", _S, 32, True, None),
        ("user_name", _S, 40, True, None),
        ("name", _S, 100, False, None),
        ("first_name", _S, 40, False, None),
        ("last_name", _S, 40, False, None),
        ("middle_name", _S, 40, False, None),
        ("email", _S, 100, False, None),
        ("phone", _S, 40, False, None),
        ("mobile_phone", _S, 40, False, None),
        ("company", _S, 32, False, None),
        ("department", _S, 32, False, None),
        ("location", _S, 32, False, None),
        ("manager", _S, 32, False, None),
        ("title", _S, 40, False, None),
        ("active", _B, None, False, "true"),
        ("locked_out", _B, None, False, "false"),
        ("web_service_access_only", _B, None, False, "false"),
        ("last_login", _TS, None, False, None),
        ("last_login_time", _TS, None, False, None),
        ("failed_attempts", _I, None, False, "0"),
        ("time_zone", _S, 40, False, None),
        ("date_format", _S, 40, False, None),
        ("time_format", _S, 40, False, None),
        *_AUDIT,
    ]),
    "department": _table([
        ("sys_id", _S, 32, True, None),
        ("name", _S, 40, True, None),
        ("parent", _S, 32, False, None),
        ("company", _S, 32, False, None),
        ("dept_head", _S, 32, False, None),
        ("description", _S, 1000, False, None),
        ("active", _B, None, False, "true"),
        *_AUDIT,
    ]),
    "archive_entry": _table([
        ("id", T.LongType(), None, True, None),
        ("data_extraction", _D, None, True, None),
        ("extraction_type", _S, 50, True, None),
        ("start_date", _D, None, False, None),
        ("end_date", _D, None, False, None),
        ("record_count", _I, None, True, "0"),
        ("json_size_kb", T.DecimalType(10, 2), None, True, "0"),
        ("compressed_size_kb", T.DecimalType(10, 2), None, False, None),
        ("compression_ratio", T.DecimalType(5, 2), None, False, None),
        ("extraction_duration_seconds", T.DecimalType(8, 2), None, False, None),
        ("api_requests_count", _I, None, False, None),
        ("created_at", _TS, None, True, NOW),
        ("updated_at", _TS, None, False, None),
    ]),
    "run_log": _table([
        ("execution_id", _S, 36, False, None),
        ("execution_type", _S, 20, True, None),
        ("start_date", _D, None, False, None),
        ("end_date", _D, None, False, None),
        ("started_at", _TS, None, False, NOW),
        ("ended_at", _TS, None, False, None),
        ("duration_seconds", T.DecimalType(10, 2), None, False, None),
        ("status", _S, 20, True, None),
        ("json_storage_enabled", _B, None, False, "false"),
        ("total_api_requests", _I, None, False, "0"),
        ("failed_api_requests", _I, None, False, "0"),
        ("total_api_time_seconds", T.DecimalType(18, 2), None, False, "0"),  # over all requests of a run: 8 places are too few
        ("api_success_rate", T.DecimalType(5, 2), None, False, "0"),
        ("total_db_transactions", _I, None, False, "0"),
        ("total_records_processed", _I, None, False, "0"),
        ("db_time_seconds", T.DecimalType(10, 2), None, False, "0"),
        ("json_size_kb", T.DecimalType(12, 2), None, False, None),
        ("compressed_size_kb", T.DecimalType(12, 2), None, False, None),
        ("compression_ratio", T.DecimalType(5, 2), None, False, None),
        ("tables_processed", _S, 500, False, None),
        ("error_message", _S, None, False, None),
        ("records_by_table", _S, None, False, None),
        ("hostname", _S, 100, False, None),
        ("username", _S, 100, False, None),
        ("created_at", _TS, None, False, NOW),
    ]),
}


TYPED_STORAGE = ("user", "company")  # tables that runs store typed


def typed_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dtype) for f in TYPED_TABLES[table]])


RUN_LOG = typed_schema("run_log")
REQUEST_LOG = T.StructType([
    T.StructField("extractor", T.StringType()),
    T.StructField("page", T.LongType()),
    T.StructField("elapsed_seconds", T.DoubleType()),
    T.StructField("failed", T.IntegerType()),
])
