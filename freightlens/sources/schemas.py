"""Typed schemas of the five core tables and the three exported views."""

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)


def _s(*fields):
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


PROVIDERS = _s(
    ("provider_id", IntegerType(), False),
    ("provider_name", StringType(), False),
    ("country_hq", StringType(), True),
    ("provider_type", StringType(), True),
    ("founded_year", IntegerType(), True),
    ("eu_presence", BooleanType(), True),
    ("sla_threshold", DecimalType(5, 2), True),
    ("notes", StringType(), True),
)

ROUTES = _s(
    ("route_id", IntegerType(), False),
    ("origin_city", StringType(), False),
    ("origin_country", StringType(), False),
    ("dest_city", StringType(), False),
    ("dest_country", StringType(), False),
    ("distance_km", IntegerType(), True),
    ("route_type", StringType(), True),
    ("avg_lead_days", DecimalType(4, 1), True),
)

QUOTES = _s(
    ("quote_id", IntegerType(), False),
    ("provider_id", IntegerType(), True),
    ("route_id", IntegerType(), True),
    ("weight_band_kg", StringType(), True),
    ("base_rate_eur_per_kg", DecimalType(8, 4), True),
    ("fuel_surcharge_pct", DecimalType(5, 2), True),
    ("volume_discount_pct", DecimalType(5, 2), True),
    ("min_shipment_kg", DecimalType(8, 2), True),
    ("effective_date", DateType(), True),
    ("expiry_date", DateType(), True),
    ("quote_source", StringType(), True),
)

SHIPMENTS = _s(
    ("shipment_id", IntegerType(), False),
    ("provider_id", IntegerType(), True),
    ("route_id", IntegerType(), True),
    ("shipment_date", DateType(), False),
    ("weight_kg", DecimalType(10, 2), True),
    ("volume_cbm", DecimalType(8, 3), True),
    ("commodity_type", StringType(), True),
    ("promised_delivery", DateType(), True),
    ("actual_delivery", DateType(), True),
    ("freight_cost_eur", DecimalType(10, 2), True),
    ("fuel_surcharge_eur", DecimalType(8, 2), True),
    ("total_cost_eur", DecimalType(10, 2), True),
    ("status", StringType(), True),
    ("delay_reason", StringType(), True),
    ("customer_complaint", BooleanType(), True),
)

PERFORMANCE_HISTORY = _s(
    ("perf_id", IntegerType(), False),
    ("provider_id", IntegerType(), True),
    ("route_id", IntegerType(), True),
    ("month_year", DateType(), True),
    ("total_shipments", IntegerType(), True),
    ("on_time_count", IntegerType(), True),
    ("delayed_count", IntegerType(), True),
    ("damaged_count", IntegerType(), True),
    ("avg_lead_time_days", DecimalType(5, 2), True),
    ("avg_cost_per_kg", DecimalType(8, 4), True),
    ("total_revenue_eur", DecimalType(12, 2), True),
    ("sla_breached", BooleanType(), True),
)

TABLES = {
    "providers": PROVIDERS,
    "routes": ROUTES,
    "quotes": QUOTES,
    "shipments": SHIPMENTS,
    "performance_history": PERFORMANCE_HISTORY,
}

# Column defaults declared by the reference schema.
DEFAULTS = {
    "providers": {"eu_presence": True},
    "shipments": {"customer_complaint": False},
    "performance_history": {"sla_breached": False},
}

# Read schemas of the three CSV extracts.  ``month`` is text and booleans
# arrive as 0/1, so they are read as int and cast afterwards.
V_SCORECARD_CSV = _s(
    ("provider_name", StringType(), True),
    ("lane", StringType(), True),
    ("avg_cost_per_kg", DecimalType(8, 4), True),
    ("avg_on_time_pct", DecimalType(6, 2), True),
    ("avg_lead_time_days", DecimalType(6, 2), True),
    ("total_shipments_ytd", IntegerType(), True),
    ("total_spend_eur", DecimalType(14, 2), True),
    ("sla_breach_months", IntegerType(), True),
)

V_TREND_CSV = _s(
    ("month", StringType(), True),
    ("month_year", DateType(), True),
    ("provider_name", StringType(), True),
    ("lane", StringType(), True),
    ("on_time_pct", DecimalType(9, 5), True),
    ("avg_cost_per_kg", DecimalType(8, 4), True),
    ("avg_lead_time_days", DecimalType(5, 2), True),
    ("total_revenue_eur", DecimalType(12, 2), True),
)

V_DETAIL_CSV = _s(
    ("shipment_id", IntegerType(), True),
    ("shipment_date", DateType(), True),
    ("provider_name", StringType(), True),
    ("lane", StringType(), True),
    ("weight_kg", DecimalType(10, 2), True),
    ("commodity_type", StringType(), True),
    ("promised_delivery", DateType(), True),
    ("actual_delivery", DateType(), True),
    ("delay_days", IntegerType(), True),
    ("total_cost_eur", DecimalType(10, 2), True),
    ("actual_cost_per_kg", DecimalType(14, 4), True),
    ("status", StringType(), True),
    ("delay_reason", StringType(), True),
    ("customer_complaint", IntegerType(), True),
)

VIEW_CSV = {"v_scorecard": V_SCORECARD_CSV, "v_trend": V_TREND_CSV, "v_detail": V_DETAIL_CSV}
BOOLEAN_AS_INT = {"v_detail": ["customer_complaint"]}
