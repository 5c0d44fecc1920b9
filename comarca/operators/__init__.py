from comarca.operators.analyze import (
    count_by,
    count_matrix,
    distinct_values,
    top_k,
    value_pairs,
    value_sets,
    value_sets_up_to,
)
from comarca.operators.bloom import bloom_filter, cannot_have, may_have
from comarca.operators.clean import canonicalise, drop_sentinel
from comarca.operators.enrich import (
    derive_dimension,
    fill_from_lookup,
    hot_keys,
    join_spread,
    rate_per,
    unique_lookup,
)
from comarca.operators.order import starts_before
from comarca.operators.quality import (
    audit,
    audit_filters,
    dedup,
    find_dupes,
    find_long_dupes,
    has_no_nulls,
    null_counts,
    profile,
    profile_sketch,
    stats,
)
from comarca.operators.reshape import (
    attributes_long,
    attributes_wide,
    bucket_sums,
    explode_delimited,
    explode_elements,
    pivot_first,
)
from comarca.operators.trace import Traced

__all__ = [
    "Traced",
    "attributes_long",
    "attributes_wide",
    "audit",
    "audit_filters",
    "bloom_filter",
    "bucket_sums",
    "cannot_have",
    "canonicalise",
    "count_by",
    "count_matrix",
    "dedup",
    "derive_dimension",
    "distinct_values",
    "drop_sentinel",
    "explode_delimited",
    "explode_elements",
    "fill_from_lookup",
    "find_dupes",
    "find_long_dupes",
    "has_no_nulls",
    "hot_keys",
    "join_spread",
    "may_have",
    "null_counts",
    "pivot_first",
    "profile",
    "profile_sketch",
    "rate_per",
    "starts_before",
    "stats",
    "top_k",
    "unique_lookup",
    "value_pairs",
    "value_sets",
    "value_sets_up_to",
]
