"""Select lists."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame


def aliased(values: Mapping[str, str]) -> list[str]:
    return [f"{sql} AS `{name}`" for name, sql in values.items()]


def rework(
    df: DataFrame,
    values: Mapping[str, str],
    *,
    columns: Collection[str] | None = None,
    renames: Mapping[str, str] | None = None,
    drops: Collection[str] = (),
) -> DataFrame:
    """Replace, add, rename and drop columns in one projection.

    ``columns`` limits the input columns that are kept and sets their order.
    New columns come last.
    """
    renames = renames or {}
    names = [name for name in (columns or df.columns) if name not in drops]
    names += [name for name in values if name not in names]
    return df.selectExpr(
        *(
            f"{values.get(name, f'`{name}`')} AS `{renames.get(name, name)}`"
            for name in names
        )
    )
