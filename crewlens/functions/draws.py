"""Deterministic draws as SQL text: the same key gives the same number in any run or retry.

They are text because whole tables are made of them, and one parsed expression is built many times
faster than the same expression put together call by call.
"""

from __future__ import annotations

from collections.abc import Sequence

_RANGE = "4294967296.0D"


def draw_int(salt: str, key: str) -> str:
    """First eight hex digits of md5('salt|key') as a bigint in [0, 2^32)."""
    digest = f"md5(concat('{salt}|', cast({key} AS string)))"
    return f"cast(conv(substring({digest}, 1, 8), 16, 10) AS bigint)"


def draw_unit(salt: str, key: str) -> str:
    """Uniform in [0, 1)."""
    return f"({draw_int(salt, key)} / {_RANGE})"


def draw_between(salt: str, key: str, low: int, high: int) -> str:
    """Whole number, low <= x < high."""
    return f"({draw_int(salt, key)} % {high - low} + {low})"


def draw_normal(salt: str, key: str, sigma: float) -> str:
    """N(0, sigma) from two uniform draws (Box-Muller)."""
    u = f"(({draw_int(salt + '1', key)} + 0.5D) / {_RANGE})"
    return f"(sqrt(-2.0D * ln({u})) * cos(2.0D * pi() * {draw_unit(salt + '2', key)}) * {sigma}D)"


def literal(value) -> str:
    if value is None:
        return "NULL"
    return str(value) if isinstance(value, (int, float)) else "'" + value.replace("'", r"\'") + "'"


def choose(salt: str, key: str, values: Sequence) -> str:
    """One of `values`, all alike likely."""
    options = ", ".join(map(literal, values))
    return f"element_at(array({options}), cast({draw_int(salt, key)} % {len(values)} + 1 AS int))"


def draw_weighted(salt: str, key: str, values: Sequence, weights: Sequence[float]) -> str:
    """One of `values`, with the given probabilities (in whole per cents)."""
    bound, branches = 0, []
    for value, weight in zip(values[:-1], weights[:-1]):
        bound += round(weight * 100)
        branches.append(f"WHEN {draw_int(salt, key)} % 100 < {bound} THEN {literal(value)}")
    return f"(CASE {' '.join(branches)} ELSE {literal(values[-1])} END)"


def pick(salt: str, key: str, options: str) -> str:
    """An element of an array column; NULL for an empty array."""
    return f"get({options}, cast({draw_int(salt, key)} % greatest(size({options}), 1) AS int))"


def letters(number: str) -> str:
    """Digits written as the letters a to j."""
    return f"translate(cast({number} AS string), '0123456789', 'abcdefghij')"
