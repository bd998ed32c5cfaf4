"""Text labels shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These strings must equal the reference's output labels.
# ---------------------------------------------------------------------------
LANE_ARROW = " → "
SLA_MET = "✅ SLA Met"
SLA_BREACHED = "🚨 SLA Breached"
ALERT_BREACH = "🚨 SLA BREACH — Immediate Review Required"
ALERT_AT_RISK = "⚠️  AT RISK — Monitor Closely"
ALERT_OK = "✅ Performing Within SLA"
ACTION_BREACH = (
    "Escalate to account manager. Issue formal performance notice. "
    "Consider partial lane reallocation."
)
ACTION_AT_RISK = "Schedule monthly review. Request improvement plan within 30 days."
ACTION_OK = "Continue monitoring. Review at next quarterly business review."
NO_DELAY = "No Delay"
RAG_GOOD = "🟢 Good"
RAG_AT_RISK = "🟡 At Risk"
RAG_BREACH = "🔴 Breach"
SCORE_CATEGORIES = ("Cost Score", "Reliability Score", "Lead Time Score")
# Default weights of the scorecard (cost, reliability, lead time) and the
# DAX volume assumption for the max-min saving.
DEFAULT_WEIGHTS = (0.40, 0.35, 0.25)
DEFAULT_ANNUAL_VOLUME_KG = 2_400_000
# Shipment-size scenarios of the volume model, its band boundary and the two
# bands it selects (at or below the boundary, above it).
DEFAULT_SCENARIOS = ((500, "500kg scenario"), (2000, "2000kg scenario"))
DEFAULT_BAND_BOUNDARY = 2000
DEFAULT_BANDS = ("500-2000", "2000+")
# RAG bounds of the SLA status flag and the SLA-alert margin.
RAG_DEFAULT_GOOD, RAG_DEFAULT_AT_RISK = 95.0, 90.0
ALERT_MARGIN = 3.0
# ---------------------------------------------------------------------------


def lane_label(origin="origin_city", dest="dest_city") -> Column:
    """``origin || ' → ' || dest``; NULL if either side is NULL (like SQL ``||``)."""
    o = F.col(origin) if isinstance(origin, str) else origin
    d = F.col(dest) if isinstance(dest, str) else dest
    return F.concat(o, F.lit(LANE_ARROW), d)


def month_label(d="month_year") -> Column:
    """``YYYY-MM`` month label (calendar year, not week year)."""
    c = F.col(d) if isinstance(d, str) else d
    return F.date_format(c, "yyyy-MM")
