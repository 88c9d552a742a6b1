"""Random replacement texts."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilframe.functions.numbers import draw

# The symbols of a random text.
ALPHABET = "ㄱㄴㄷㄹㅁㅂㅅㅇㅈㅊㅋㅌㅍㅎ0123456789"

PAIRS = [first + second for first in ALPHABET for second in ALPHABET]
# One literal to split, which the optimizer folds, instead of one per element.
PAIR_LIST = ",".join(PAIRS)
SHORT = (2, 8, 24)
BLOCK = 24


def random_text(col: Column, seed: int | None = None, identity: Sequence[Column] = ()) -> Column:
    """A random text of the cell's length over ``ALPHABET``.

    Symbols are drawn two at a time, by ``draw``. Cells up to the lengths in
    ``SHORT`` take plain expressions that compile; only longer ones walk an array
    of blocks.

    Every draw has a seed of its own, far from the others: Spark adds the
    partition's index to it, so neighbouring seeds would repeat one position's
    draws at another position of the next partition.
    """
    seeds = random.Random(seed)
    pairs = F.split(F.lit(PAIR_LIST), ",")

    def symbols(count: int, *place: Column) -> Column:
        # Without an identity each draw is new anyway, and the place of a block says nothing.
        of = [*identity, *place] if identity else ()
        return F.concat(
            *[F.get(pairs, (draw(seeds.getrandbits(62), of) * len(PAIRS)).cast("int")) for _ in range(count // 2)]
        )

    n = F.length(col)
    blocks = F.transform(
        F.sequence(F.lit(1), F.ceil(n / BLOCK).cast("int")), lambda i: symbols(BLOCK, i)
    )
    drawn = F.array_join(blocks, "")
    for limit in reversed(SHORT):
        drawn = F.when(n <= limit, symbols(limit)).otherwise(drawn)
    return F.substring(drawn, F.lit(1), n)
