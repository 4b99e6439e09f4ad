"""Names for columns that an operator adds for a while, and columns by their names, whatever is in them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def free(columns: Iterable[str], *names: str) -> list[str]:
    """``names``, each behind as many underscores as set it apart from ``columns`` and the others, whose case doesn't count."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def own(rows: DataFrame) -> list[Column]:
    """The columns of ``rows``, to be selected from what was derived from it."""
    return [col(c) for c in rows.columns]
