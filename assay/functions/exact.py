"""Sums of doubles that do not depend on the order of addition.

A double is cut into ``LIMBS`` whole numbers of ``LIMB`` bits on a fixed grid
(its remainder modulo a power of two is exact, so nothing rounds).  Whole
numbers add up exactly in any order, over any partitioning, retry or split
into batches; only the last step, which turns their totals into a double,
rounds, always in the same order.  The grid holds every double below 2**68
whose last bit is worth at least 2**-100; others ("far" values, infinities
and NaN among them) are added as doubles, and counted.

All of it is Spark SQL text: it fuses with the other aggregates of a pass.
"""

from __future__ import annotations

#: Limb i holds the bits of a value from 2**(TOP - 24 i) down to 2**(TOP - 24 (i + 1)).  The sums of
#: 2**39 values fit in a long; totals over several states are added as decimals.
TOP, LIMB, LIMBS = 68, 24, 7


def _power(exponent: int) -> str:
    return f"{2.0 ** exponent!r}D"


def on_grid(x: str) -> str:
    """Whether the limbs hold the double ``x`` exactly."""
    return f"(abs({x}) < {_power(TOP)} AND ({x}) % {_power(TOP - LIMB * LIMBS)} = 0)"


def limb(x: str, i: int) -> str:
    """Limb ``i`` of the double ``x`` on the grid, a long with the sign of ``x``."""
    return f"CAST((({x}) % {_power(TOP - LIMB * i)}) * {_power(-(TOP - LIMB * (i + 1)))} AS BIGINT)"


def limb_sums(x: str) -> list[str]:
    """Aggregates over the double ``x``: a sum per limb, then the far values' sum and their number."""
    near = on_grid(x)
    return [f"sum(CASE WHEN {near} THEN {limb(x, i)} END)" for i in range(LIMBS)] + [
        f"sum(CASE WHEN NOT {near} THEN {x} END)", f"count_if(NOT {near})"]


def total(limbs: list[str], far: str) -> str:
    """The double that the limbs' totals (null: none) and the far values' sum add up to."""
    parts = [f"coalesce(CAST({t} AS DOUBLE) * {_power(TOP - LIMB * (i + 1))}, 0D)" for i, t in reversed(list(enumerate(limbs)))]
    return "(" + " + ".join([*parts, f"coalesce({far}, 0D)"]) + ")"


def exact_sum(x: str) -> str:
    """One aggregate expression: the sum of ``x`` (cast to double), the same for every order; null without values."""
    x = f"CAST(({x}) AS DOUBLE)"
    *limbs, far, _ = limb_sums(x)
    return f"CASE WHEN count({x}) > 0 THEN {total(limbs, far)} END"
