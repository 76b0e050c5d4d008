from .columns import (  # noqa: F401
    age_years, between_rows, clip_bucket, days_between, group_code, least_strict,
    not_sentinel, pad_right, recode_any, recode_first, stay_length, strip_dots, strip_zeros,
    try_number, is_digits,
)
