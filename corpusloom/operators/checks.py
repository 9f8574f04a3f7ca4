"""Plan-time checks and projections that depend on which columns there are."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require(df: DataFrame, *columns: str) -> DataFrame:
    """The same frame, or a ValueError that names the missing columns."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def or_default(df: DataFrame, name: str, default) -> Column:
    """A column, or a constant where the frame has none."""
    return F.col(name) if name in df.columns else F.lit(default)


def project_existing(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])


def add_struct(df: DataFrame, value: Column) -> DataFrame:
    """The fields of a struct as columns, in place of those of the same name.

    The struct goes through a generator of one row. The optimiser neither copies expressions nor pushes filters through a
    generator, so a costly value is computed once however often its columns are used or filtered on; it stays in the JVM.
    """
    with_it = df.withColumn("__fields", value)  # a projection, where common parts of the fields are shared
    fields = with_it.schema["__fields"].dataType.names
    return with_it.select(*[c for c in df.columns if c not in fields], F.inline(F.array("__fields")))


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Columns that are computed once, see ``add_struct``."""
    return add_struct(df, F.struct(*[c.alias(n) for n, c in columns.items()]))


def union_all(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by name; columns that a frame lacks are null."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out
