"""Keep the latest version of each entity.

``ROW_NUMBER() OVER (PARTITION BY key ORDER BY a DESC, b DESC, ...) = 1``
written as an aggregate: ``max_by(struct(row), struct(order))``. The aggregate
is partial (map-side) so each task ships at most one row per key into the
shuffle, and a key holding a third of the table is reduced before it moves;
a window would sort every version of that key in one task.

Descending order puts nulls last, like the SQL form: in struct comparison a
null field is smaller than any value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_version(df: DataFrame, key: str | Sequence[str], order: Sequence[str],
                   columns: Sequence[str] | None = None) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    cols = list(columns or df.columns)
    payload = [c for c in cols if c not in keys]
    ordering = F.struct(*[F.col(c) for c in order])
    best = F.max_by(F.struct(*[F.col(c) for c in payload]), ordering).alias("_v")
    return (df.groupBy(*keys).agg(best)
            .select(*keys, *[F.col("_v." + c).alias(c) for c in payload])
            .select(*cols))
