"""A two-pass external shuffle of all rows into shards of equal counts.

First pass: a seeded hash of the whole row scatters the rows uniformly over buckets of ``bucket_bytes`` of text, so no
source, id or text decides where a row goes. Second pass: each bucket is sorted, put in random order by a seeded
Fisher-Yates shuffle (what Spark's ``shuffle`` of an array does) and written. The buckets one after the other are the
random order of all rows, and a shard is a stretch of it, cut so that counts differ by one at most.

Everything is a DataFrame expression. The order depends on the rows, the seed and ``bucket_bytes`` alone, not on the
cluster: a bucket is one partition of its own number, in which the shuffle's random numbers start anew. Where a bucket
starts comes from a count per bucket beforehand; it travels to the bucket as one more row, so no join moves texts.

Rows that are equal in all columns have one hash. A bucket that they fill beyond its size is dealt anew: its rows are
counted per distinct row, which tasks combine before they shuffle, and the copies go to all buckets in small lots.

Size counts the UTF-8 bytes of ``text`` plus 1; NULL and empty texts have none. Repeated rows stay, each with a place of
its own, and so does a row without an id. An empty table gives no rows. All columns are written; one that is called
like a column of the shards (shard, slot, bucket) is written under that name with ``_in``. Columns that cannot be
grouped (maps, variants) are refused by Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscope.llm.common import scratch, stored
from shelfscope.operators.numbering import running_total

BUCKET_BYTES = 16 << 20  # of text; what a task holds as one array, a few times over
SEED = 20260101
OWN = ("shard", "slot", "bucket")
# Copies of a row are spread in lots of this share of a bucket, and lots are made in steps of so many.
LOTS_PER_BUCKET = 16
LOT_STEP = 4096


def _out_names(columns: list[str]) -> list[str]:
    taken, out = {*OWN, *(c.lower() for c in columns)}, []
    for c in columns:
        name = c
        while name.lower() in OWN or (name != c and name.lower() in taken):
            name += "_in"
        taken.add(name.lower())
        out.append(name)
    return out


def _bucket(key: Column, n_buckets: int, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed + 1), key), F.lit(n_buckets)).cast("int")


def text_size(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def _spread(crowded: DataFrame, n_buckets: int, seed: int, bucket_bytes: int) -> DataFrame:
    """(bucket, key, record, n): lots of at most n copies of each distinct row of the crowded buckets."""
    distinct = stored(crowded.groupBy("record", "key", "size").agg(F.count("*").alias("copies")), "copies")
    in_lot = F.greatest(F.lit(1), F.expr(f"{bucket_bytes} div ({LOTS_PER_BUCKET} * size)"))
    lots = distinct.withColumn("in_lot", in_lot).withColumn("last", F.expr("(copies - 1) div in_lot"))
    steps = lots.withColumn("step", F.explode(F.sequence(F.lit(0).cast("long"), "last", F.lit(LOT_STEP).cast("long"))))
    steps = steps.withColumn("lot", F.explode(F.sequence("step", F.least("last", F.col("step") + LOT_STEP - 1))))
    return steps.select(
        _bucket(F.struct("key", "lot"), n_buckets, seed).alias("bucket"), "key", "record",
        F.least("in_lot", F.col("copies") - F.col("lot") * F.col("in_lot")).alias("n"),
    )


def shuffled_shards(
    docs: DataFrame, n_shards: int = 8, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, path: str | None = None
) -> DataFrame:
    """The rows of ``docs`` in random order with (shard, slot, bucket), written to ``path`` and read back.

    ``path`` (default: a folder of its own in the shared one) holds a folder per shard; the files of a shard follow in
    the order of their buckets, and the rows of a file in the order of their slots.
    """
    spark = docs.sparkSession
    path = path or scratch(spark, "shards")
    names = _out_names(docs.columns)
    rows = docs.select(F.struct(*(F.col(c).alias(n) for c, n in zip(docs.columns, names, strict=True))).alias("record"), text_size().alias("size"))
    n_rows, n_bytes = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    n_buckets = max(n_shards, -(-n_bytes // bucket_bytes))
    rows = rows.withColumn("key", F.xxhash64(F.lit(seed), "record"))
    rows = rows.withColumn("bucket", _bucket(F.struct("key", F.lit(0).cast("long")), n_buckets, seed))
    counts = stored(rows.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), F.max("size").alias("largest")), "bucket-sizes")
    over = counts.where(F.col("bytes") > 2 * bucket_bytes + F.col("largest")).select("bucket")
    scattered = rows.select("bucket", "key", "record")
    if not over.isEmpty():
        lots = stored(_spread(rows.join(over, "bucket", "left_semi"), n_buckets, seed, bucket_bytes), "lots")
        copies = lots.select("bucket", "key", "record", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"))
        scattered = rows.join(over, "bucket", "left_anti").select("bucket", "key", "record").unionByName(copies.drop("copy"))
        counts = counts.join(over, "bucket", "left_anti").select("bucket", "n").unionByName(lots.select("bucket", "n"))
        counts = stored(counts.groupBy("bucket").agg(F.sum("n").alias("n")), "bucket-sizes")
    starts = running_total(counts.select("bucket", "n"), "bucket", ["n"]).select("bucket", F.col("before_n").alias("start"))
    dealt = (
        scattered.unionByName(starts, allowMissingColumns=True)
        .repartitionById(n_buckets, "bucket")
        .groupBy("bucket")
        .agg(F.max("start").alias("start"), F.array_sort(F.collect_list(F.when(F.col("start").isNull(), F.struct("key", "record")))).alias("rows"))
    )
    placed = dealt.select("bucket", "start", F.posexplode(F.shuffle("rows", F.lit(seed))).alias("i", "row")).withColumn("place", F.col("start") + F.col("i"))
    # Shard s holds the places from s * n_rows div n_shards on.
    cut = placed.withColumn("shard", F.expr(f"cast((place * {n_shards} + {n_shards - 1}) div {max(n_rows, 1)} as int)"))
    cut = cut.withColumn("slot", F.expr(f"place - (shard * {n_rows}L) div {n_shards}"))
    shards = cut.select("shard", "slot", "bucket", "row.record.*")
    shards.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return spark.read.schema(shards.schema).parquet(path).select(*shards.columns)
