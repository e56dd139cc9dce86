"""Source schemas and value domains of the six bronze tables."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, TS = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampNTZType()


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    """Every source column is nullable on read: missing keys are what the
    ``not_null`` checks report, so the reader must not reject them.  The flag
    records whether the source system declares the column required."""
    return T.StructType([T.StructField(n, t, True, {"required": not nullable})
                         for n, t, nullable in fields])


CUSTOMERS = _struct(
    ("customer_id", S, False), ("email", S, True), ("first_name", S, True),
    ("last_name", S, True), ("phone_number", S, True), ("country", S, True),
    ("city", S, True), ("registration_date", TS, True),
    ("last_login_date", TS, True), ("status", S, True),
)
MERCHANTS = _struct(
    ("merchant_id", S, False), ("merchant_name", S, True), ("category", S, True),
    ("country", S, True), ("integration_type", S, True),
    ("onboarding_date", TS, True), ("status", S, True),
)
TRANSACTIONS = _struct(
    ("transaction_id", S, False), ("customer_id", S, True), ("merchant_id", S, True),
    ("transaction_date", TS, True), ("amount", D, True), ("currency", S, True),
    ("payment_method", S, True), ("status", S, True),
)
PAYMENT_PLANS = _struct(
    ("plan_id", S, False), ("transaction_id", S, True), ("customer_id", S, True),
    ("merchant_id", S, True), ("plan_date", TS, True), ("total_amount", D, True),
    ("installment_count", L, True), ("first_installment_amount", D, True),
    ("status", S, True),
)
INSTALLMENTS = _struct(
    ("installment_id", S, False), ("plan_id", S, True),
    ("installment_number", L, True), ("amount", D, True), ("due_date", TS, True),
    ("paid_date", TS, True), ("status", S, True),
)
USER_EVENTS = _struct(
    ("event_id", S, False), ("event_timestamp", TS, True), ("customer_id", S, True),
    ("event_type", S, True), ("platform", S, True), ("merchant_id", S, True),
    ("session_id", S, True), ("device_type", S, True), ("country", S, True),
)

SOURCE_SCHEMAS: dict[str, T.StructType] = {
    "customers": CUSTOMERS,
    "merchants": MERCHANTS,
    "transactions": TRANSACTIONS,
    "payment_plans": PAYMENT_PLANS,
    "installments": INSTALLMENTS,
    "user_events": USER_EVENTS,
}

# Lineage columns added at bronze load.
ETL_EXTRACTED_AT = "_etl_extracted_at"
ETL_SOURCE = "_etl_source"

# Value domains of the source system.
COUNTRIES = ["UAE", "KSA", "Egypt", "Kuwait"]
CUSTOMER_STATUSES = ["active", "inactive", "suspended"]
MERCHANT_CATEGORIES = ["Fashion", "Electronics", "Home & Garden", "Beauty",
                       "Sports", "Grocery", "Restaurants", "Travel"]
INTEGRATION_TYPES = ["direct", "marketplace", "platform"]
MERCHANT_STATUSES = ["active", "inactive", "pending"]
CURRENCIES = ["AED", "SAR", "EGP", "KWD"]
PAYMENT_METHODS = ["credit_card", "debit_card", "bank_transfer"]
TRANSACTION_STATUSES = ["completed", "pending", "failed", "cancelled", "refunded"]
INSTALLMENT_COUNTS = [3, 6, 12]
PLAN_STATUSES = ["active", "completed", "defaulted"]
INSTALLMENT_STATUSES = ["scheduled", "paid", "paid_late", "defaulted"]
EVENT_TYPES = ["app_open", "product_view", "search", "add_to_cart", "checkout", "purchase"]
PLATFORMS = ["android", "ios", "web"]
DEVICE_TYPES = ["mobile", "tablet", "desktop"]
