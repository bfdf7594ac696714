"""DataFrame → DataFrame operators."""

from .aggregates import frequency, quality_checks
from .columns import normalise, split_by_tag, stamp
from .dedup import distinct_on, keep_latest, preview
from .joins import (keyed_diff, left_join_split, lookup,
                    mapping_frame, with_scalar)
from .sequence import next_in_sequence

__all__ = [
    "frequency", "quality_checks", "normalise", "split_by_tag",
    "stamp", "distinct_on", "keep_latest", "preview",
    "keyed_diff", "left_join_split", "lookup",
    "mapping_frame", "with_scalar", "next_in_sequence",
]
