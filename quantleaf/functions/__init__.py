from quantleaf.functions.exprs import (  # noqa: F401
    compound_pct, correlation_label, dbl, in_trailing_window, pct_change,
    quarter_end, safe_div, to_dec, try_dec, tsql_week, tsql_weekday, years_back,
)
