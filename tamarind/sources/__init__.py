"""Lake and warehouse readers."""

from tamarind.sources.lake import (  # noqa: F401
    PART_COLS, empty_frame, latest_per_key, read_history, read_lake, read_source,
)
from tamarind.sources.warehouse import (  # noqa: F401
    latest_address, member_parties, project_with_default, read_warehouse,
)
