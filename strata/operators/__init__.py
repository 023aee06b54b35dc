"""Relational building blocks composed by the table jobs."""

from .dedup import keep_first, latest_non_null  # noqa: F401
from .joins import (append_missing, fits_broadcast, lookup_join, lookup_side,  # noqa: F401
                    role_playing_join)
from .quality import (ConstraintViolation, assert_constraints, constraint_report,  # noqa: F401
                      fk_orphans, pk_violations)
from .reshape import explode_with_position, role_union, stack_columns, unpivot_tagged  # noqa: F401
from .surrogate import dense_surrogate, sequential_rank  # noqa: F401
