"""Column expressions: text, parsing, numbers and keys."""

from .keys import row_key  # noqa: F401
from .numeric import (both_present, indicator, round_half_even, sum_or_zero,  # noqa: F401
                      to_double, to_long)
from .parse import (goal_chunks, local_timestamp, norm_time, parse_goal_cell, parse_goal_chunk,
                    parse_kickoff,  # noqa: F401
                    minute_of_parts, parse_minute, period_of_minute, snapshot_date_from_name,
                    split_score, to_date_coerce)
from .text import (canonical_label, canonicalize_with_table, collapse_ws, map_label,  # noqa: F401
                   empty_to_null, flag_and_strip, null_to_empty, rsplit_last,
                   snake_case, snake_name, strip_ws)
