"""Writers of tables, graphs and summaries."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeflow.operators.checks import assert_no_nulls, non_null_columns


def write_table(df: DataFrame, path: str, non_null: tuple[str, ...] = (), dictionary: tuple[str, ...] | None = None) -> None:
    """Parquet with zstd; nulls in some columns are an error, found before anything is written.

    ``dictionary`` limits dictionary encoding to some columns.
    """
    if non_null:
        assert_no_nulls(df, *non_null)
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if dictionary is not None:
        for c in df.columns:
            writer = writer.option(f"parquet.enable.dictionary#{c}", str(c in dictionary).lower())
    writer.parquet(path)


def write_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """Several tables of one source."""
    for name, df in tables.items():
        write_table(df, f"{folder}/{name.replace('_', '-')}.parquet")


def tightened_schema(df: DataFrame):
    """The schema with columns that hold no null marked so."""
    from pyspark.sql.types import StructField, StructType

    full = {*non_null_columns(df)}
    return StructType([StructField(f.name, f.dataType, f.nullable and f.name not in full, f.metadata) for f in df.schema])


def write_csv(df: DataFrame, path: str, compressed: bool = True, single: bool = False) -> None:
    """CSV with a header; ``single`` for summaries of a few rows only."""
    (df.coalesce(1) if single else df).write.mode("overwrite").csv(path, header=True, compression="gzip" if compressed else "none")


def gml_lines(nodes: DataFrame, edges: DataFrame) -> Iterator[str]:
    """A graph in GML; the caller passes the subgraph of a few clusters, which is streamed through the driver."""
    yield "graph ["
    for n in nodes.toLocalIterator():
        yield f"  node [\n    id {n['book_code']}\n    namespace \"{n['node_type']}\""
        if n["label"] is not None:
            yield '    label "' + n["label"].replace("&", "&amp;").replace('"', "&quot;") + '"'
        yield "  ]"
    for e in edges.toLocalIterator():
        yield f"  edge [\n    source {e['src']}\n    target {e['dst']}\n  ]"
    yield "]"


def write_gml(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        f.writelines(line + "\n" for line in gml_lines(nodes, edges))


def write_metrics(metrics: DataFrame, path: str) -> dict:
    """A one-row table as a JSON object."""
    out = metrics.first().asDict()
    with open(path, "w") as f:
        json.dump(out, f)
    return out


def table_info(spark: SparkSession, path: str, check_length: bool = False) -> dict:
    """Rows, bytes and fields of a Parquet table; ``check_length`` decodes all rows and compares the count."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    df = spark.read.parquet(path)
    rows = df.count()
    if check_length:
        decoded = df.agg(F.count(F.xxhash64(*df.columns))).first()[0]
        if decoded != rows:
            raise ValueError(f"{path} holds {decoded} rows, its footers say {rows}")
    size = files.select("length").agg(F.sum("length")).first()[0]
    return {"row_count": rows, "file_size": size, "fields": [{"name": f.name, "data_type": f.dataType.simpleString(), "nullable": f.nullable} for f in df.schema]}
