"""What to link two tables on and which columns to return."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

KEY_MODES = ("columns", "concat")


@dataclass(frozen=True)
class LinkSpec:
    """Key and output columns of the two sides of a link.

    ``key_mode`` says when two composite keys are equal. ``columns`` compares
    them column by column. ``concat`` compares the texts run together, so that
    (``ab``, ``c``) equals (``a``, ``bc``); the two sides may then use
    different numbers of columns. With one key column both are the same.

    A missing key counts as the empty text, and empty texts match each other;
    ``drop_empty_keys`` leaves out rows whose key is empty in every column.

    With a ``secret`` the tokens that are compared are keyed. A side named in
    ``tokens`` (``A``, ``B`` or ``AB``) comes with its tokens made: its one key
    column holds what ``tokenise`` gave its owner, as hexadecimal text or bytes.
    In JSON its key is ``{"token": column}``. A missing token matches nothing.
    """

    keys_a: tuple[str, ...]
    keys_b: tuple[str, ...]
    columns_a: tuple[str, ...]
    columns_b: tuple[str, ...]
    key_mode: str = "columns"
    drop_empty_keys: bool = False
    secret: bytes = field(default=b"", repr=False)
    tokens: str = ""

    def __post_init__(self) -> None:
        for name in ("keys_a", "keys_b", "columns_a", "columns_b"):
            object.__setattr__(self, name, tuple(getattr(self, name)))
        if self.key_mode not in KEY_MODES:
            raise ValueError(f"unknown key mode {self.key_mode!r}, one of {KEY_MODES}")
        if not self.keys_a or not self.keys_b:
            raise ValueError("both sides of a link need at least one key column")
        if not self.columns_a and not self.columns_b:
            raise ValueError("a link returns at least one column")
        if self.tokens not in ("", "A", "B", "AB"):
            raise ValueError(f"tokens names sides, as A, B or AB, not {self.tokens!r}")
        for side, keys in (("A", self.keys_a), ("B", self.keys_b)):
            if side in self.tokens and len(keys) != 1:
                raise ValueError(f"side {side} has its tokens in one column, not in {keys}")
        if not self.tokens and self.key_mode == "columns" and len(self.keys_a) != len(self.keys_b):
            raise ValueError("key lists of different length need key_mode='concat'")

    @classmethod
    def from_dict(cls, spec: Mapping, **options) -> LinkSpec:
        keys, columns = dict(spec["join_key"]), spec["column_list"]
        ready = [side for side in "AB" if isinstance(keys[side], Mapping)]
        for side in ready:
            if set(keys[side]) != {"token"}:
                raise ValueError(f"join_key of {side}: a list of columns or {{'token': column}}, got {keys[side]!r}")
            keys[side] = [keys[side]["token"]]
        options = {"tokens": "".join(ready), **options}
        return cls(keys["A"], keys["B"], columns["A"], columns["B"], **options)

    @classmethod
    def from_json(cls, text: str, **options) -> LinkSpec:
        return cls.from_dict(json.loads(text), **options)
