"""Look into physical plans."""

from __future__ import annotations

import contextlib
import io
import re


def explain(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def operators(df) -> list[str]:
    """Operator names of the plan tree, subqueries included."""
    return re.findall(r"^\((\d+)\) (.+?)(?: \[codegen.*)?$", explain(df), re.M)


def count(df, name: str) -> int:
    return sum(1 for _, op in operators(df) if op.startswith(name))
