"""CSV source and sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             infer: bool = False, drop_index: str | None = "_c0", mode: str = "FAILFAST") -> DataFrame:
    """Scan CSV with a header; columns are bound by their header names.

    With an explicit ``schema`` (the default path) only the header line is read
    ahead: the scan's schema is laid out in the file's order, columns that the
    schema lacks are skipped, and the result has the schema's columns in the
    schema's order. A schema column that the file lacks is an error, and so is
    (unless ``mode`` says otherwise) a value that its type cannot hold: turned
    into null it would later be dropped without a word. With ``infer=True`` and
    no schema, Spark infers types as the source job did (one more pass over the
    files). A stray index column written by a pandas export is dropped.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        df = reader.option("inferSchema", bool(infer)).csv(path)
        return df.drop(drop_index) if drop_index else df
    names = reader.csv(path).columns
    missing = [f.name for f in schema.fields if f.name not in names]
    if missing:
        raise ValueError(f"the CSV header at {path} lacks {missing}")
    types = {f.name: f.dataType for f in schema.fields}
    laid_out = T.StructType([T.StructField(n, types.get(n, T.StringType()), True) for n in names])
    # enforceSchema=false: files of the folder whose header differs are an error, too.
    df = reader.schema(laid_out).option("enforceSchema", False).option("mode", mode).csv(path)
    return df.select([f.name for f in schema.fields if f.name != drop_index])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write CSV with a header, one file per partition (Spark has no row index,
    so no index column is written)."""
    df.write.mode(mode).option("header", True).csv(path)
    return path
