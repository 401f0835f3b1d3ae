"""The source registry: which crawls and payload feeds exist, and their parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from shelfscope.functions.text import label_with_node, stripped
from shelfscope.operators.page_window import first_page, page_budget
from shelfscope.schemas import REGISTRY


class SourceNotFound(LookupError):
    """No source of that name is registered."""


class SourceDisabled(LookupError):
    """The source is registered but switched off."""


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Registry from JSON (an array, one object per line, or one object) with a fixed schema."""
    files = spark.read.text(path, wholetext=True).select(stripped(F.col("value")).alias("v"))
    lines = F.filter(F.transform(F.split("v", "\r?\n"), stripped), lambda x: x != "")
    one_each = F.forall(lines, lambda x: x.startswith("{") & x.endswith("}"))
    entries = (
        F.when(F.col("v").startswith("["), F.from_json("v", ArrayType(REGISTRY)))
        .when(one_each, F.transform(lines, lambda x: F.from_json(x, REGISTRY)))
        .otherwise(F.array(F.from_json("v", REGISTRY)))
    )
    return files.select(F.inline(entries))


def _yaml_text(value) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


def read_yaml_registry(spark: SparkSession, path: str) -> DataFrame:
    """Registry from a YAML file with a ``sources`` list, where a YAML reader is installed."""
    import yaml

    with open(path, encoding="utf-8") as handle:
        entries = yaml.safe_load(handle)["sources"]
    rows = [
        (
            e["name"],
            e.get("type"),
            bool(e.get("enabled", True)),
            {k: _yaml_text(v) for k, v in e.get("parameters", {}).items() if v is not None},
        )
        for e in entries
    ]
    return spark.createDataFrame(rows, REGISTRY)


def parameter(name: str, default: str | None = None) -> Column:
    """A parameter of the source, or its default where it is missing or blank."""
    value = F.nullif(F.try_element_at("parameters", F.lit(name)), F.lit(""))
    return F.coalesce(value, F.lit(default).cast("string"))


def resolved(registry: DataFrame, page_cap: int | None = None) -> DataFrame:
    """Enabled sources with their parameters typed and defaulted; ``enabled`` defaults to true.

    ``max_pages`` is the budget as registered, and NULL means all pages; with ``page_cap`` it is that at most.
    Product-detail sources prefer ``node`` over ``node_label``, the others the reverse.
    """
    on = F.coalesce("enabled", F.lit(True))
    node = F.when(
        F.col("type").endswith("product_details"), F.coalesce(parameter("node"), parameter("node_label"))
    ).otherwise(F.coalesce(parameter("node_label"), parameter("node")))
    return (
        registry.where(on)
        .select(
            F.col("name").alias("source"),
            "type",
            F.coalesce(parameter("category_label"), F.col("name")).alias("category_label"),
            node.alias("node_label"),
            parameter("domain", "de").alias("domain"),
            parameter("category_url").alias("category_url"),
            parameter("bq_table").alias("table"),
            parameter("bq_column", "asin").alias("key_column"),
            parameter("bq_where").alias("where"),
            (parameter("bq_distinct", "false") == "true").alias("distinct"),
            parameter("max_items").try_cast("int").alias("max_items"),
            page_budget(parameter("max_pages").try_cast("int"), page_cap).alias("max_pages"),
            first_page(parameter("start_page")).alias("start_page"),
        )
        .withColumn("run_label", label_with_node(F.col("category_label"), F.col("node_label")))
    )


def find_source(registry: DataFrame, name: str, page_cap: int | None = None) -> dict:
    """One source's resolved parameters. The registry is a small config table read by key."""
    hit = registry.where(F.col("name") == name).limit(1).collect()
    if not hit:
        raise SourceNotFound(name)
    if hit[0]["enabled"] is False:
        raise SourceDisabled(name)
    return resolved(registry.where(F.col("name") == name), page_cap).first().asDict()
