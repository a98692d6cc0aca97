"""Column functions shared by the operators and plans."""

from lakevault.functions.keys import hash_key, hashdiff, joined, pseudonym
from lakevault.functions.scalars import (
    EXACT,
    NA_TOKENS,
    activity_category,
    assessment_result,
    blank_na,
    exact_mean,
    one_decimal,
    presentation_start,
    ratio,
    registration_timing,
    round_half_up,
    to_double,
    to_long,
    to_long_or_zero,
    week_number,
)

__all__ = [
    "EXACT", "NA_TOKENS", "activity_category", "assessment_result", "blank_na", "exact_mean",
    "hash_key", "hashdiff", "joined", "one_decimal", "presentation_start", "pseudonym", "ratio",
    "registration_timing", "round_half_up", "to_double", "to_long", "to_long_or_zero",
    "week_number",
]
