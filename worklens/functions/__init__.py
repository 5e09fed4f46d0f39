from worklens.functions.columns import (  # noqa: F401
    abbreviate, age_days, array_length, category_in, category_rank, fiscal_year,
    fixed_bins, format_week, is_current_fy, is_given_fy, parse_date, row_sum,
    sorted_list_text, to_date, trim, truncate_ellipsis, usd, wall_clock_as_utc,
    week_start_sunday,
)
