"""Report files, written by the executors."""

from pyspark.sql import DataFrame


def write_report(df: DataFrame, path: str) -> None:
    """CSV with a header, columns in their order, null as an empty field."""
    df.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def write_json_rows(df: DataFrame, path: str, column: str = "json") -> None:
    """Text with one exported JSON object per line."""
    df.select(column).write.mode("overwrite").text(path)
