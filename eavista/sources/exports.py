"""Report sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from eavista import values
from eavista.functions.text import without_blacklisted


def csv_text(df: DataFrame) -> DataFrame:
    """Columns as the CSV design shows them: cleaned texts, formatted dates."""
    dated = (T.DateType, T.TimestampType, T.TimestampNTZType)
    shown = []
    for field in df.schema:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            col = without_blacklisted(col)
        elif isinstance(field.dataType, dated):
            col = F.date_format(col, values.CSV_DATE_FORMAT)
        shown.append(col.alias(field.name))
    return df.select(*shown)


def write_csv(df: DataFrame, path: str) -> None:
    """A CSV export in Latin-1, one part file per task."""
    csv_text(df).write.option("header", True).option("encoding", values.CSV_ENCODING).csv(path)


def write_sheets(df: DataFrame, path: str, sheet: str = "sheet_name") -> None:
    """Repeating sections: each row is a sheet of its own, named by ``sheet``.

    Sheets are written in name order, each file holding one range of names, as one JSON line
    per sheet. A folder or file per row would not survive a large report.
    """
    df.repartitionByRange(sheet).sortWithinPartitions(sheet).write.json(path)
