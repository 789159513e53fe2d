from tempora.functions.exprs import (  # noqa: F401
    exact_avg, exact_sum, month_start, ntz, round_half_up, safe_pct_change, year_month,
)
