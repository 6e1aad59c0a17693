"""Column-level building blocks (pure ``Column -> Column`` helpers)."""

from sievekit.functions.columns import (  # noqa: F401
    ANI_BUCKETS,
    EXCLUDED_VERSION_STATUS,
    EXCLUDED_WARNINGS,
    TAXONOMY_RANKS,
    bucket_label,
    compose_key,
    excluded_assembly,
    flag,
    list_overlap,
    pair_key,
    pairs_in_group,
    row_min,
    split_list,
    split_taxonomy,
    split_to_columns,
    strip_prefix,
    text_key,
)
from sievekit.functions.sizing import broadcast_if_small, dealt_out, estimated_bytes, is_small  # noqa: F401
