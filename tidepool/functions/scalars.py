"""Column expressions used across the library.

All built-in functions, so they compile into whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(cond: Column) -> Column:
    """Boolean flag column (``df.loc[df.x > 10, 'flag'] = True``);
    NULL condition → False."""
    return F.coalesce(cond, F.lit(False))


def label(cond: Column, yes: str, no: str) -> Column:
    """P10: ``CASE WHEN cond THEN yes ELSE no END``."""
    return F.when(cond, F.lit(yes)).otherwise(F.lit(no))


def round_money(c: str | Column, scale: int = 2) -> Column:
    """half-up rounding done in DECIMAL, so 1.005 → 1.01 on every
    engine (rounding the double directly depends on its binary value)."""
    return F.round(_c(c).cast("decimal(38,10)"), scale).cast(f"decimal(38,{scale})")


def calendar(ts: str | Column) -> dict[str, Column]:
    """Date, year and month of a timestamp, as the Silver contract."""
    t = _c(ts)
    return {"order_date": t.cast("date"), "order_year": F.year(t), "order_month": F.month(t),
            "order_day": F.dayofmonth(t)}
