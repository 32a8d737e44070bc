"""Relational helpers (P*, J*, R*, W1, U3)."""

from tamarind.operators.columns import (  # noqa: F401
    blank_strings_to_null, col_or, lower_columns, pack_flags, rename, suffix_columns, unpack_flag, with_audit,
)
from tamarind.operators.joins import (  # noqa: F401
    PLACE, estimated_bytes, fanout_join, lookup_join, maybe_broadcast, placed_join, split_join, streamed_join,
)
from tamarind.operators.reshape import unpivot, unpivot_groups  # noqa: F401
from tamarind.operators.windows import last_value_per_key, union_default_row  # noqa: F401
