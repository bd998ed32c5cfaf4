from freightlens.functions.numeric import (  # noqa: F401
    dax_divide,
    from_units,
    sum_units,
    div_half_up,
    mean_exact,
    mean_half_up,
    mean_parts,
    pct,
    pct_decimal,
    pct_half_up,
    pct_units,
    round_half_up,
    safe_div,
)
from freightlens.functions.labels import lane_label, month_label  # noqa: F401
