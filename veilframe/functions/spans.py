"""Positional masking: keep some spans of a text, mask or remove the rest.

A spec is a list of ``:``-separated tokens, one per position. ``1`` keeps its
character and ``0`` masks it; ``1-`` and ``0-`` do the same and stretch over
the characters that follow. Bare tokens after a stretching one count from the
end of the text. ``1:0-:1`` keeps the first and the last character.

A token takes effect when a left-to-right walk reaches its position; if the
text is too short for that, the walk waits for it in vain and the mode last
set covers the rest. Whether a token is reached depends on the text's length n
alone: every position is a constant or n minus a constant, so each token is
reached for one interval of lengths. The result is one concatenation with a
piece for every change between keeping and masking.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Switch(NamedTuple):
    """A change between keeping and masking, for lengths in [shortest, longest].

    It happens at ``offset``, counted from the end of the text if ``tail``.
    """

    offset: int
    tail: bool
    keep: bool
    shortest: int
    longest: float

    @property
    def plain(self) -> bool:
        """Reached by every text that is long enough to have its position."""
        return not self.tail and self.longest == math.inf

    def position(self, n: Column) -> Column:
        return n + F.lit(self.offset) if self.tail else F.lit(self.offset)

    def reached(self, n: Column) -> Column:
        enough = n >= self.shortest
        return enough if self.longest == math.inf else enough & (n <= self.longest)


def switches(spec: str) -> list[Switch]:
    """The mode changes of a spec; the mode before the first is masking."""
    tokens = spec.split(":")
    while tokens and not tokens[-1]:
        tokens.pop()

    found: list[Switch] = []
    shortest, longest = 1, math.inf
    stretched = keeping = previous_tail = False
    for i, token in enumerate(tokens):
        bare = token in ("0", "1")
        stretched = stretched or not bare
        tail = bare and stretched
        if not tail:
            shortest = max(shortest, i + 1)
            if previous_tail:
                longest = min(longest, len(tokens))
        elif not previous_tail:
            shortest = max(shortest, len(tokens))
        previous_tail = tail
        if shortest > longest:
            break
        keep = token in ("1", "1-")
        if keep != keeping:
            offset = i - len(tokens) if tail else i
            found.append(Switch(offset, tail, keep, shortest, longest))
            keeping = keep
    return found


def _spans(col: Column, spec: str, mark: str, lead: str) -> Column:
    col = col.cast("string")
    n = F.length(col)
    changes = [Switch(0, False, False, 0, math.inf), *switches(spec)]
    # Empty, or NULL for a NULL cell. A CASE around it all would hide from Spark
    # that the length is always needed, and have it counted for every piece.
    pieces = [F.substring(col, 1, 0), F.lit(lead)]
    for change, following in zip(changes, [*changes[1:], None]):
        if not (change.keep or mark):
            continue
        if following is None:
            end = n
        elif following.plain:
            end = F.least(following.position(n), n)
        else:
            end = F.when(following.reached(n), following.position(n)).otherwise(n)
        start = change.position(n)
        # Both functions give empty text for a size below zero.
        if change.keep:
            piece = F.substring(col, start + 1, end - start)
        else:
            piece = F.repeat(F.lit(mark), end - start)
        pieces.append(piece if change.plain else F.when(change.reached(n), piece).otherwise(""))
    return F.concat(*pieces)


def span_mask(col: Column, spec: str, mark: str = "*", lead: str = "*") -> Column:
    """The text with masked characters replaced by ``mark``, behind ``lead``."""
    return _spans(col, spec, mark, lead)


def part_delete(col: Column, spec: str) -> Column:
    """The text without its masked characters."""
    return _spans(col, spec, mark="", lead="")
