"""Column rules (built-in expressions only) and their SQL registrations."""

from tableflow.functions.rules import (  # noqa: F401
    DATE_SENTINEL,
    NULL_TOKENS,
    clean_code,
    clean_date,
    clean_date_text,
    clean_int,
    clean_text,
    coerce_timestamp,
    copy_escape,
    is_invalid,
    null_token,
    percent,
    strip,
    typed_value,
    value_kind,
)
