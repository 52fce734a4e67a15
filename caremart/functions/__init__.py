"""Column functions: every one is a native Spark expression."""

from caremart.functions.dates import (
    date_key,
    parse_date,
    parse_date_or,
    parse_date_strict,
    with_parsed_date,
)
from caremart.functions.numbers import (
    clamp_unit,
    clamp_weight,
    extract_number,
    guarded_ratio,
    mean_of_valid,
    round_half_even,
    to_number,
    truncate_int,
)
from caremart.functions.seeded import seeded_choice, seeded_integer, seeded_uniform
from caremart.functions.text import (
    age_band,
    as_missing,
    caesarean_flag,
    complication_flag,
    prefixed_code,
    pseudonymise,
    severity_class,
    strip,
    stripped,
    title_case,
)

__all__ = [
    "age_band",
    "as_missing",
    "caesarean_flag",
    "clamp_unit",
    "clamp_weight",
    "complication_flag",
    "date_key",
    "extract_number",
    "guarded_ratio",
    "mean_of_valid",
    "parse_date",
    "parse_date_or",
    "parse_date_strict",
    "with_parsed_date",
    "prefixed_code",
    "pseudonymise",
    "round_half_even",
    "seeded_choice",
    "seeded_integer",
    "seeded_uniform",
    "severity_class",
    "strip",
    "stripped",
    "title_case",
    "to_number",
    "truncate_int",
]
