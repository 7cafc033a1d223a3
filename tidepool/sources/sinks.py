"""Sinks and actions.

Writers never sort before writing (D7): a global sort is a full shuffle and
readers get no order guarantee from files anyway. Order belongs in the query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, mode: str = "overwrite",
              header: bool = True) -> None:
    """CSV with header. Whitespace is written as received."""
    (df.write.mode(mode)
       .option("header", header)
       .option("ignoreLeadingWhiteSpace", False)
       .option("ignoreTrailingWhiteSpace", False)
       .csv(path))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None,
                  max_records_per_file: int | None = None) -> None:
    """Parquet, optionally Hive-partitioned.

    With ``partition_by`` the rows are first rebalanced on the partition
    columns, so each task writes few directories (otherwise every task opens
    one file per partition value it sees: the small-files problem); AQE splits
    a hot value over several tasks by its bytes."""
    w = df
    if partition_by:
        w = df.hint("rebalance", *partition_by)
    writer = w.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)


def to_pandas(df: DataFrame, max_rows: int):
    """Arrow-backed ``toPandas`` behind a row guard.

    The result must fit the driver. The guard counts at most ``max_rows+1``
    rows (a limited scan), and refuses larger results instead of
    truncating them.
    """
    n = df.limit(max_rows + 1).count()
    if n > max_rows:
        raise ValueError(
            f"result has more than {max_rows} rows; aggregate or write it "
            "to storage instead of collecting it")
    return df.toPandas()
