from worklens.operators.core import (  # noqa: F401
    attach_group_total, bucket_counts, checked_dimension, dimension_stats, keep_first,
    running_total, zip_single_rows,
    null_safe_full_join, sum_strict, union_all, unpivot_counts, with_totals,
)
