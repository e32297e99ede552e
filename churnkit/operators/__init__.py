from churnkit.operators.clean import (
    cap_two_sided,
    cap_upper,
    clamp_negative,
    coerce_numbers,
    drop_exact_duplicates,
    impute_constants,
    impute_median,
    impute_mode,
    keep_labels,
    normalize_text,
    one_row_per_key,
    outlier_columns,
    outlier_shares,
)
from churnkit.operators.features import quantile_bins, risk_level
from churnkit.operators.joins import inner_join, key_set_diff, left_chain, lookup, same_keys
from churnkit.operators.latest import first_per_key, latest_per_key
from churnkit.operators.order import continue_ids, dense_key, place_in_order
from churnkit.operators.project import (
    add_run_columns,
    append_rows,
    distinct_union,
    keep_columns,
    rename_snake_case,
)
from churnkit.operators.ranks import column_sketches, exact_quantiles, quantiles, sketch_quantiles
from churnkit.operators.stats import (
    column_modes,
    conditional_rate,
    event_rate,
    has_values,
    means_by_key,
    missing_counts,
    outside_share,
    profile,
    require_rows,
    row_counts,
    topic_counts,
    value_counts,
)

__all__ = [name for name in dir() if not name.startswith("_")]
