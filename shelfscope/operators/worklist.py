"""Work-lists of keys, and pairing them with landed payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope.functions.predicates import truthy_key
from shelfscope.functions.text import stripped
from shelfscope.operators import numbering

# Answers that stand for none.
MISSING_PAYLOAD = '{"error":"Missing result"}'
EMPTY_PAYLOAD = '{"error":"Empty payload"}'


def usable_lines(lines: Column) -> Column:
    """``array<string>`` of lines, trimmed, without the blank ones."""
    return F.filter(F.transform(lines, stripped), lambda x: x != "")


def read_lines(spark: SparkSession, path: str, max_items: int | None = None) -> DataFrame:
    """``(pos, value)``: trimmed non-blank lines of text files on any Hadoop file system.

    ``pos`` counts from 0 by the file's name and the line's place in it, however Spark deals the files out. The cap
    counts lines after blanks are dropped, 0 or None is no cap.
    """
    place = ("_metadata.file_path", "_metadata.file_block_start")
    lines = spark.read.text(path).select(
        *(F.col(c).alias(f"_{i}") for i, c in enumerate(place)), F.monotonically_increasing_id().alias("_2"), stripped(F.col("value")).alias("value")
    )
    lines = numbering.numbered(lines.where("value <> ''"), ["_0", "_1", "_2"]).select("pos", "value")
    return lines.where(F.col("pos") < max_items) if max_items else lines


def column_scan(
    df: DataFrame,
    column: str,
    where: str | Column | None = None,
    max_items: int | None = None,
    distinct: bool = False,
) -> DataFrame:
    """One column as ``val``: filter, optional distinct, optional cap, then unusable values dropped.

    The cap comes before the drop, as in ``SELECT ... LIMIT n`` read by a client that skips blanks,
    and takes the smallest values first so that it is repeatable.
    """
    rows = df.where(where) if where is not None else df
    rows = rows.select(F.col(column).alias("val"))
    if distinct:
        rows = rows.distinct()
    if max_items:
        rows = rows.orderBy(F.col("val").asc_nulls_first()).limit(max_items)
    return rows.where(truthy_key(rows, "val"))


def numbered(df: DataFrame, column: str, pos: str = "input_pos", order: Sequence[str | Column] = ()) -> DataFrame:
    """``(pos, column)``: numbers from 0 without gaps in the given order, or in the input's, to restore it later."""
    return numbering.numbered(df, order, pos).select(pos, column)


def attach_payloads(worklist: DataFrame, payloads: DataFrame, key: str = "asin") -> DataFrame:
    """Each work-list row with its key's payload text.

    ``payloads`` holds ``(key, payload, landed_at)``, several per key at most by retries: the latest
    counts. Repeated work-list keys keep their rows and share it. The payload side has one row per
    key after its aggregation, so a key repeated many times in the work-list is split by AQE's skew join.
    """
    # A struct holds the payload once; a retried NULL payload still counts as an answer.
    newest = payloads.groupBy(key).agg(F.max(F.struct("landed_at", "payload")).alias("hit"))
    joined = worklist.join(newest, key, "left")
    return joined.withColumn(
        "payload",
        F.when(F.col("hit").isNull(), F.lit(MISSING_PAYLOAD)).otherwise(
            F.coalesce(F.col("hit.payload"), F.lit(EMPTY_PAYLOAD))
        ),
    ).drop("hit")


def status_counts(df: DataFrame, status: str, *keys: str) -> DataFrame:
    """Rows per status (and optional further keys), the run report of a flattened table."""
    return df.groupBy(*keys, status).agg(F.count("*").alias("n_rows"))
