"""Column builders behind the treatments: built-in Spark expressions only."""

from veilframe.functions.columns import free_name, matches, named, require_columns
from veilframe.functions.digest import hmac_sha256, link_token, sha256_hex
from veilframe.functions.numbers import (
    draw,
    has_numbers,
    is_outlier,
    random_number,
    round_at,
    to_number,
)
from veilframe.functions.spans import part_delete, span_mask
from veilframe.functions.texts import random_text

__all__ = [
    "draw",
    "free_name",
    "has_numbers",
    "hmac_sha256",
    "is_outlier",
    "link_token",
    "matches",
    "named",
    "part_delete",
    "random_number",
    "random_text",
    "require_columns",
    "round_at",
    "sha256_hex",
    "span_mask",
    "to_number",
]
