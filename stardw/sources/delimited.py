"""Tab-separated bulk text: ``\\N`` for NULL, doubled backslashes, ISO dates, 0/1-free booleans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stardw.functions.exprs import bulk_text

NULL_TEXT = "\\N"


def bulk_lines(df: DataFrame) -> DataFrame:
    """One text column: the row as a bulk-copy line."""
    fields = []
    for field in df.schema:
        col = F.col(field.name)
        text = bulk_text(col) if isinstance(field.dataType, T.StringType) else col.cast("string")
        fields.append(F.coalesce(text, F.lit(NULL_TEXT)))
    return df.select(F.concat_ws("\t", *fields).alias("value"))


def write_bulk(df: DataFrame, path: str) -> None:
    """Write in parallel, one file per partition."""
    bulk_lines(df).write.mode("error").text(path)


def read_bulk(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read such files back."""
    cells = F.split("value", "\t")
    cols = []
    for i, field in enumerate(schema):
        cell = F.get(cells, F.lit(i))
        text = F.when(cell != F.lit(NULL_TEXT), cell)
        if isinstance(field.dataType, T.StringType):
            text = F.replace(text, F.lit("\\\\"), F.lit("\\"))
        cols.append(text.cast(field.dataType).alias(field.name))
    return spark.read.text(path).select(*cols)
