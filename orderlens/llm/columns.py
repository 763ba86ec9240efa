"""Other columns carried through an operator untouched, whatever their names."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The one column that holds all others while an operator runs.
_REST = "__other_columns"


def carrying(*own: str) -> Callable:
    """An operator on documents, which returns rows with their columns, sees only the columns ``own``
    (those of them that there are); all others go through it in one struct and come back as they were, so
    none can clash with the operator's own names."""
    def decorate(run: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @functools.wraps(run)
        def wrapped(docs: DataFrame, *args: object, **kwargs: object) -> DataFrame:
            names = docs.columns
            seen = [c for c in names if c in own]
            others = [c for c in names if c not in own]
            given = docs.select(*seen, F.struct(*[docs[_quoted(c)] for c in others]).alias(_REST)) if others else docs
            out = run(given, *args, **kwargs)
            return out.select(*[F.col(c) if c in own else F.col(_REST).getField(c).alias(c) for c in names])

        return wrapped

    return decorate


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
