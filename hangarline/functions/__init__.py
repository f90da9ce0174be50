from hangarline.functions.expressions import (
    clean_code,
    clean_text,
    false_if_null,
    micros_between,
    micros_sql,
    month_key,
    ratio,
    round_places,
)

__all__ = [
    "clean_code",
    "clean_text",
    "false_if_null",
    "micros_between",
    "micros_sql",
    "month_key",
    "ratio",
    "round_places",
]
