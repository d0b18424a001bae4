"""Generic readers: every schema is given, nothing is inferred."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read
    return (reader.schema(schema) if schema else reader).parquet(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str, header: bool = True, separator: str = ",") -> DataFrame:
    """A CSV file; a row that does not fit the schema is an error."""
    return spark.read.schema(schema).csv(path, header=header, sep=separator, mode="FAILFAST", enforceSchema=True)


def spread(df: DataFrame, paths_are_compressed: bool = True) -> DataFrame:
    """Deal rows of files that cannot be split (gzip) to all cores before they are parsed."""
    if not paths_are_compressed:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism * 2)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``value`` and the file's ``_metadata``; gzip files of several members are read whole."""
    return spark.read.text(path).select("value", "_metadata")


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines; a broken line or a value of another type is an error."""
    return spark.read.schema(schema).json(path, mode="FAILFAST")


def read_zip_member(spark: SparkSession, path: str, member: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """``place, value``: the lines of one file in each archive, unpacked where the archive is read."""
    import pyarrow as pa

    def unpack(batches):
        for batch in batches:
            for content in batch.column(0):
                with zipfile.ZipFile(io.BytesIO(content.as_py())) as z, z.open(member) as f:
                    lines = f.read().decode(encoding).split("\n")
                for at in range(0, len(lines), 10_000):
                    part = lines[at : at + 10_000]
                    yield pa.RecordBatch.from_pydict({"place": pa.array(range(at, at + len(part)), pa.int64()), "value": pa.array(part, pa.string())})

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(unpack, "place long, value string").where(F.col("value") != "")
