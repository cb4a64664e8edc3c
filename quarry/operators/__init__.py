from quarry.operators.relational import (  # noqa: F401
    count_rows,
    facts_of_top_n,
    in_list,
    never_matched,
    never_matched_outer,
    rows_at_extreme,
    share_where,
    top_n,
    without_value,
)
from quarry.operators.conform import composite_id, conform, unite  # noqa: F401
from quarry.operators.replicate import midpoint, replicate  # noqa: F401
from quarry.operators.wordcount import word_count  # noqa: F401
from quarry.operators.parallelism import spread  # noqa: F401
