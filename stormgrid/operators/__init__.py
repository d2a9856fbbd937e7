from stormgrid.operators.aggregate import (
    bounds, count_by, count_distinct_by, count_distinct_whole, crosstab, crosstab_map,
    distinct_sorted, mean_by, null_counts, rate_by, sentinel_counts, shape, top_k, totals, value_counts, value_share,
)
from stormgrid.operators.clean import (
    distinct_by, drop_null, keep_bbox, keep_nonempty, keep_values, mask_sentinel, numbers,
    zero_fill_int,
)
from stormgrid.operators.columns import (
    any_positive, clean_names, difference, ensure_columns, present, product, rename,
    require_columns, row_sum, weighted_sum,
)
from stormgrid.operators.cube import (
    date_range, dim_region, dim_time, fact_risk, ranked, region_features, slice_by_date,
    typed_metrics,
)
from stormgrid.operators.joins import attach, fold_values, keep_known, left_zero, style
from stormgrid.operators.metrics import (
    best_threshold, binary_metrics, class_report, confusion, evaluate_scores, roc_auc, score_counts,
)
from stormgrid.operators.model import (
    class_weights, fit, positive_probability, risk_class, scaling, score, select_features,
    standardize,
)
from stormgrid.operators.newton import fit_newton
from stormgrid.operators.scale import lookup_join, salted_join
from stormgrid.operators.series import fill, history, in_first_part, lag, rolling_sum, time_split
from stormgrid.operators.spatial import (
    covers, region_cells, region_tree, spatial_join, spatial_join_adaptive,
)

__all__ = [
    "any_positive", "attach", "best_threshold", "binary_metrics", "bounds", "class_report",
    "class_weights", "clean_names", "confusion", "count_by", "count_distinct_by",
    "count_distinct_whole", "covers", "crosstab", "crosstab_map", "date_range", "difference", "dim_region", "dim_time", "distinct_by",
    "distinct_sorted", "drop_null", "ensure_columns", "evaluate_scores", "fact_risk", "fill", "fit",
    "fit_newton", "fold_values", "history",
    "in_first_part", "keep_bbox", "keep_known", "keep_nonempty", "keep_values", "lag",
    "left_zero", "lookup_join", "mask_sentinel", "mean_by", "null_counts", "numbers",
    "positive_probability", "present", "product", "ranked", "rate_by", "region_cells",
    "region_features", "region_tree", "rename", "require_columns", "risk_class", "roc_auc", "rolling_sum",
    "row_sum", "salted_join", "scaling", "score", "score_counts", "select_features", "sentinel_counts", "shape",
    "slice_by_date", "spatial_join", "spatial_join_adaptive", "standardize", "style", "time_split", "top_k", "totals",
    "typed_metrics", "value_counts", "value_share", "weighted_sum", "zero_fill_int",
]
