"""Column-expression helpers (built-in Spark functions only)."""

from .names import (  # noqa: F401
    NAME_DELIM, STRICT_NAME_DELIM, STOP_EXACT_DEFAULT, STOP_CONTAINS_DEFAULT,
    KNOWN_FALSE_POSITIVES, DEFAULT_LAST_KEY, tab_fields, tab_fields_all, record_key,
    has_names_field, split_names, drop_empty, day_from_stamp, parse_stamp, day_string,
    parse_record_id,
)
from .timefuncs import (  # noqa: F401
    stamp_minute, floor_segment, next_segment, last_full_segment, segment_name,
    segment_key, segment_window, segment_start_from_file,
)
