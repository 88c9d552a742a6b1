"""Per-column treatment policies.

A policy maps a column name to ``[treatment, option, ...]``::

    {"name":   ["Masking", "1:0-:1"],
     "brand":  ["PartDelete", "1:0-:1"],
     "memo":   ["Delete"],
     "id":     ["Encryption"],
     "code":   ["Encryption", "salt=pepper"],
     "phone2": ["Encryption", "key=pepper"],
     "price":  ["Round", "R", 2],
     "income": ["TopBottom"],
     "age":    ["MicroAggregation", "region=north", "sex=F"],
     "phone":  ["Random"]}

A profile request is one more key, ``PROFILE_KEY``, whose first element is a
free label and whose other elements are figures.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import quote

# Fixed values of the policy format.
PROFILE_KEY = "전처리"
FIGURES = ("Avg", "Sd", "Min", "Max")
ROUND_MODES = ("R", "RU", "RD")
TREATMENTS = (
    "Delete",
    "Masking",
    "PartDelete",
    "Round",
    "Encryption",
    "TopBottom",
    "MicroAggregation",
    "Random",
)
ALIASES = {"Aggregation": "MicroAggregation"}

# The figures each statistics-driven treatment needs of its column.
NEEDED_FIGURES = {
    "TopBottom": ("Avg", "Sd"),
    "MicroAggregation": ("Avg", "Sd"),
    "Random": ("Min", "Max"),
}


@dataclass(frozen=True)
class Condition:
    """``column=value``: the cell's text equals ``value``."""

    column: str
    value: str

    @classmethod
    def parse(cls, text: str) -> Condition:
        column, equals, value = text.partition("=")
        if not equals or not column:
            raise ValueError(f"a condition is written column=value, got {text!r}")
        return cls(column, value)


@dataclass(frozen=True)
class Treatment:
    """One column's treatment with its options, already typed and checked."""

    column: str
    kind: str
    spec: str = ""
    mode: str = "R"
    digit: int = 0
    conditions: tuple[Condition, ...] = ()
    salt: str = ""
    key: str = field(default="", repr=False)

    @classmethod
    def parse(cls, column: str, entry: Sequence) -> Treatment:
        if isinstance(entry, str) or not entry:
            raise ValueError(f"{column}: expected [treatment, option, ...], got {entry!r}")
        kind = ALIASES.get(str(entry[0]), str(entry[0]))
        options = [str(option) for option in entry[1:]]
        if kind not in TREATMENTS:
            raise ValueError(f"{column}: unknown treatment {kind!r}, one of {TREATMENTS}")

        if kind in ("Masking", "PartDelete"):
            if len(options) != 1:
                raise ValueError(f"{column}: {kind} takes a span spec such as 1:0-:1, got {options}")
            return cls(column, kind, spec=options[0])
        if kind == "Round":
            if len(options) != 2:
                raise ValueError(f"{column}: Round takes a mode and a digit position, got {options}")
            if options[0] not in ROUND_MODES:
                raise ValueError(f"{column}: unknown rounding mode {options[0]!r}, one of {ROUND_MODES}")
            return cls(column, kind, mode=options[0], digit=int(options[1]))
        if kind == "MicroAggregation":
            return cls(column, kind, conditions=tuple(map(Condition.parse, options)))
        if kind == "Encryption" and len(options) == 1 and options[0].startswith("salt="):
            return cls(column, kind, salt=options[0].removeprefix("salt="))
        if kind == "Encryption" and len(options) == 1 and options[0].removeprefix("key=") not in ("", options[0]):
            return cls(column, kind, key=options[0].removeprefix("key="))
        if options:
            raise ValueError(f"{column}: {kind} does not take {options}")
        return cls(column, kind)

    @property
    def numeric(self) -> bool:
        return self.kind == "Round" or bool(self.needed_figures)

    @property
    def condition_text(self) -> str:
        """The conditions in one text without separators of tables, empty for none."""
        return "&".join(f"{quote(c.column)}={quote(c.value)}" for c in self.conditions)

    @property
    def needed_figures(self) -> tuple[str, ...]:
        return NEEDED_FIGURES.get(self.kind, ())


@dataclass(frozen=True)
class Policy:
    treatments: tuple[Treatment, ...]
    figures: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        names = [t.column for t in self.treatments]
        repeated = sorted({name for name in names if names.count(name) > 1})
        if repeated:
            raise ValueError(f"more than one treatment for {repeated}")
        unknown = [figure for figure in self.figures if figure not in FIGURES]
        if unknown:
            raise ValueError(f"unknown figures {unknown}, any of {FIGURES}")

    @classmethod
    def from_dict(cls, entries: Mapping[str, Sequence]) -> Policy:
        request = entries.get(PROFILE_KEY, ())
        if isinstance(request, str):
            raise ValueError(f"{PROFILE_KEY}: expected [label, figure, ...], got {request!r}")
        return cls(
            treatments=tuple(
                Treatment.parse(column, entry)
                for column, entry in entries.items()
                if column != PROFILE_KEY
            ),
            figures=tuple(request[1:]),
        )

    @classmethod
    def from_json(cls, text: str) -> Policy:
        return cls.from_dict(json.loads(text))

    @property
    def measured(self) -> tuple[Treatment, ...]:
        """The treatments that depend on statistics of their column."""
        return tuple(t for t in self.treatments if t.needed_figures)

    @property
    def columns(self) -> list[str]:
        """Every column the policy mentions, conditions included."""
        treated = [t.column for t in self.treatments]
        tested = [c.column for t in self.treatments for c in t.conditions]
        return list(dict.fromkeys(treated + tested))
