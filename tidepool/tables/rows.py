"""Row-level semantics of table changes (T2-T4, T6, T12), as pure
DataFrame → DataFrame transforms.

:mod:`tidepool.tables.snapshots` writes their results as table versions; the
query suite applies them to whole tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class SchemaMismatch(ValueError):
    """An append or merge whose columns do not match the table."""


class DuplicateSourceKeys(ValueError):
    """A merge source with more than one row for some key (ambiguous)."""


def _cond(c: Column | str) -> Column:
    return F.expr(c) if isinstance(c, str) else c


def check_schema(table: StructType, incoming: StructType, allow_new_columns: bool = False,
                 allow_missing: bool = False) -> None:
    """Names and types must match the table. T14 (``mergeSchema``) allows
    extra incoming columns, and missing ones, which are null then."""
    have = {f.name: f.dataType for f in table.fields}
    names = {f.name for f in incoming.fields}
    extra = [f.name for f in incoming.fields if f.name not in have]
    missing = [n for n in have if n not in names]
    wrong = [f.name for f in incoming.fields
             if f.name in have and f.dataType != have[f.name]]
    if wrong:
        raise SchemaMismatch(f"column types differ from the table: {wrong}")
    if extra and not allow_new_columns:
        raise SchemaMismatch(f"columns not in the table schema: {extra}")
    if missing and not allow_missing:
        raise SchemaMismatch(f"columns of the table are missing: {missing}")


def updated(df: DataFrame, condition: Column | str, assignments: Mapping[str, Column | str]) -> DataFrame:
    """``UPDATE … SET col = expr WHERE cond``. A NULL condition leaves
    the row unchanged (SQL semantics); column order and types are kept."""
    cond = F.coalesce(_cond(condition), F.lit(False))
    types = dict(df.dtypes)
    out = []
    for c in df.columns:
        if c in assignments:
            new = _cond(assignments[c])
            out.append(F.when(cond, new.cast(types[c])).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    unknown = set(assignments) - set(df.columns)
    if unknown:
        raise SchemaMismatch(f"update of unknown columns {sorted(unknown)}")
    return df.select(*out)


def deleted(df: DataFrame, condition: Column | str) -> DataFrame:
    """T4: ``DELETE WHERE cond``; rows whose condition is NULL are kept."""
    return df.filter(~F.coalesce(_cond(condition), F.lit(False)))


def appended(table: DataFrame, batch: DataFrame) -> DataFrame:
    """T2 with enforcement (T12): the batch must carry the table's columns."""
    check_schema(table.schema, batch.schema)
    return table.unionByName(batch)


def merged(target: DataFrame, source: DataFrame, keys: Sequence[str],
           update: bool = True, insert: bool = True, delete_matched: bool = False,
           order_by: str | None = None) -> DataFrame:
    """``MERGE … WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *``.

    With the source unique on the keys (:func:`check_unique`) and holding every
    column of the target (T12), the result is one left join of the target with
    the source - a matched row takes the source's values, with ``update=False``
    it stays, with ``delete_matched`` it goes - united with the source rows
    whose key is not in the target. With ``order_by`` a matched row is replaced
    only if the source's value of that column is not smaller: an old event that
    arrives late does not overwrite a newer one.

    Left and anti joins, unlike a full outer join, let AQE split a key that
    holds a large share of the target; the joins' strategy is left to AQE, which
    broadcasts a change feed by its measured bytes.
    """
    keys = list(keys)
    check_schema(target.schema, source.schema)
    if delete_matched:
        out = target.join(source.select(*keys), keys, "left_anti")
    elif update:
        new = source.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                            F.struct(*target.columns).alias("__new"))
        same = [F.col(k) == F.col(f"__k{i}") for i, k in enumerate(keys)]
        take = F.col("__new").isNotNull()
        if order_by:
            stale = F.col(f"__new.{order_by}") < F.col(order_by)
            take = take & ~F.coalesce(stale, F.col(f"__new.{order_by}").isNull() & F.col(order_by).isNotNull())
        out = (target.join(new, same, "left").withColumn("__take", take)
               .select(*[F.when(F.col("__take"), F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c)
                         for c in target.columns]))
    else:
        out = target
    if insert:
        out = out.unionByName(source.join(target.select(*keys).distinct(), keys, "left_anti"))
    return out


def check_unique(source: DataFrame, keys: Sequence[str]) -> None:
    """Raise when some key appears twice in a merge source. One aggregate
    with a partial combine; only the (at most one) offending key is fetched."""
    dup = (source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
                 .filter(F.col("_n") > 1).limit(1).collect())
    if dup:
        raise DuplicateSourceKeys(f"merge source has repeated keys, e.g. {dup[0].asDict()}")
