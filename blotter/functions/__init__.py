"""Column expressions. Everything here is a built-in Spark expression, so it
stays inside whole-stage codegen and needs no Python worker."""

from blotter.functions.columns import (
    bool_from_text,
    clamp,
    hash_uniform,
    hour_of_text,
    label_of,
    text_bar,
    TIMESTAMP_TEXT_FORMAT,
)

__all__ = [
    "bool_from_text",
    "clamp",
    "hash_uniform",
    "hour_of_text",
    "label_of",
    "text_bar",
    "TIMESTAMP_TEXT_FORMAT",
]
