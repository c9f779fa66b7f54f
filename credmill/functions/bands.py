"""Threshold ladders as CASE expressions built from data."""

from __future__ import annotations

from collections.abc import Iterable


def literal(value: int | float | str) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


def ladder(value: str, rungs: Iterable[tuple], default: int | float | str) -> str:
    """The result of the first rung whose comparison holds, else ``default``.

    A rung is ``(comparison, bound, result)``.  NULL meets no rung.
    """
    cases = " ".join(
        f"WHEN {value} {comparison} {bound} THEN {literal(result)}"
        for comparison, bound, result in rungs
    )
    return f"CASE {cases} ELSE {literal(default)} END"
