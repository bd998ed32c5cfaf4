from freightlens.operators import history_store  # noqa: F401
from freightlens.operators.alerts import rolling_on_time, sla_alerts  # noqa: F401
from freightlens.operators.measures import (  # noqa: F401
    kpis,
    lane_savings,
    lane_savings_total,
    mom_change,
    potential_saving,
    rag,
    rag_status,
    rolling_calendar,
)
from freightlens.operators.rates import landed_rate, quote_spread, ranked_quotes, volume_scenarios  # noqa: F401
from freightlens.operators.reports import (  # noqa: F401
    complaints_by_provider,
    status_by_provider,
    complaints,
    dim_values,
    drill_through,
    integrity_report,
    lane_overview,
    missed_months,
    report_radar,
    report_summary,
    report_trend,
    shipment_log,
    slice_by,
    status_breakdown,
)
from freightlens.operators.scoring import measure_scores, scorecard, sensitivity  # noqa: F401
from freightlens.operators.service import delay_pareto, monthly_trend, on_time_rate, roll_up_history  # noqa: F401
from freightlens.operators.views import (  # noqa: F401
    register_sql_surface,
    register_views,
    v_detail,
    v_scorecard,
    v_trend,
)
