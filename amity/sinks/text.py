"""Text sinks.

Every sink writes one file per partition. `single_file=True` brings the rows
into one partition first and is meant for reports that are small by
definition, such as a top-k.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tab_lines(df: DataFrame, null_text: str = "null") -> DataFrame:
    """The rows as tab-separated text in column `value`."""
    cells = [F.coalesce(df[c].cast("string"), F.lit(null_text)) for c in df.columns]
    return df.select(F.concat_ws("\t", *cells).alias("value"))


def write_lines(
    lines: DataFrame, path: str, single_file: bool = False, mode: str = "error"
) -> None:
    """Writes a DataFrame of one text column as lines."""
    _placed(lines, single_file).write.mode(mode).text(path)


def write_tab_text(
    df: DataFrame,
    path: str,
    single_file: bool = False,
    null_text: str = "null",
    mode: str = "error",
) -> None:
    """Writes the columns of each row as one tab-separated line."""
    write_lines(tab_lines(df, null_text), path, single_file, mode)


def write_csv_header(
    df: DataFrame, path: str, single_file: bool = False, mode: str = "error"
) -> None:
    """Writes CSV with the column names as first line of each file."""
    _placed(df, single_file).write.mode(mode).csv(path, header=True)


def _placed(df: DataFrame, single_file: bool) -> DataFrame:
    # repartition rather than coalesce: coalesce(1) would pull the whole
    # preceding stage into one task.
    return df.repartition(1) if single_file else df
