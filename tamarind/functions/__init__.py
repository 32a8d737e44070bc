"""Column -> Column functions for dirty operational data.  All are native Spark
expressions (no Python UDFs), so they stay inside whole-stage codegen."""

from tamarind.functions.clean import (  # noqa: F401
    blank_to_null, clean_str, clean_token, coalesce_first, norm_bool, strip, to_double, to_long,
    to_long_or_zero, to_text,
)
from tamarind.functions.dates import (  # noqa: F401
    age_years, be_to_ce, date_id_from_parts, date_id_from_text, date_id_from_ts, epoch_to_ts,
    run_clock, to_ts,
)
from tamarind.functions.text import (  # noqa: F401
    first_token, full_name, join_words, phone_pad9, phone_prefix0, zfill,
)
from tamarind.functions.codes import (  # noqa: F401
    corporate_type, disabled_flag, flag_map, gender_label, is_deleted_flag, map_values,
    tri_flag, user_type,
)
