"""Newline-JSON tables: read with a fixed schema, written as runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType, VariantType

from shelfscope.functions.dates import run_stamp
from shelfscope.functions.text import label_with_node
from shelfscope.operators.tags import Tag, tag
from shelfscope.schemas import variants_to_json


def on_disk(schema: StructType) -> StructType:
    """The schema as stored: VARIANT columns are JSON text."""
    out = StructType()
    for f in schema.fields:
        out.add(f.name, "string" if isinstance(f.dataType, VariantType) else f.dataType)
    return out


def read_jsonl(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Files of any age: columns a file lacks are NULL, VARIANT columns are parsed back."""
    df = spark.read.schema(on_disk(schema)).option("recursiveFileLookup", "true").json(path)
    nested = [f.name for f in schema.fields if isinstance(f.dataType, VariantType)]
    return df.withColumns({name: F.try_parse_json(F.col(name)) for name in nested})


def without_nan(df: DataFrame) -> DataFrame:
    """NaN and infinities as NULL: strict JSON has no spelling for them."""
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]

    def finite(c: Column) -> Column:
        return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)

    return df.withColumns({name: finite(F.col(name)) for name in numbers})


def json_lines(df: DataFrame) -> DataFrame:
    """Each row as one JSON line ``value``; NULL members are kept, text stays UTF-8."""
    flat = variants_to_json(df)
    return flat.select(F.to_json(F.struct(*flat.columns), {"ignoreNullFields": "false"}).alias("value"))


def write_run(
    df: DataFrame,
    base: str,
    label: str,
    stamp: str,
    node: str | None = None,
    strict: bool = False,
    write_empty: bool = False,
) -> str | None:
    """Write one run to ``base/label[-node]/stamp`` and return that path.

    A run without rows writes nothing and returns None, unless ``write_empty``.
    """
    if not write_empty and df.isEmpty():
        return None
    path = f"{base.rstrip('/')}/{label}{'-' + node if node else ''}/{stamp}"
    flat = variants_to_json(without_nan(df) if strict else df)
    flat.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)
    return path


def write_runs(df: DataFrame, base: str, label: Tag, node: Tag, run_at: Column, strict: bool = False) -> None:
    """Write rows of many sources in one job, as ``run_label=.../run_stamp=...`` folders.

    A run that is written again replaces its own folders and no others. A source without rows gets no folder. The rebalance hint lets AQE split the folder of a source
    that holds most rows over several tasks.
    """
    flat = variants_to_json(without_nan(df) if strict else df)
    (
        flat.withColumns({"run_label": label_with_node(tag(label), tag(node)), "run_stamp": run_stamp(run_at)})
        .hint("rebalance", "run_label")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_label", "run_stamp")
        .option("ignoreNullFields", "false")
        .json(base)
    )
