from quarry.functions.money import (  # noqa: F401
    exact_mean,
    exact_state,
    exact_sum,
    exact_total,
    mean_from_parts,
    mean_parts,
    merged_state,
    round_half_up,
    share_pct,
    state_order,
    state_rounded,
    state_sum,
    state_text,
)
from quarry.functions.dates import (  # noqa: F401
    ISO_DAY,
    MONTH_NAME_DAY,
    day_of,
    format_date,
    month_of,
    parse_date,
    year_of,
)
from quarry.functions.text import join_name, normalized, part, split_literal, tokens  # noqa: F401
