"""The trie of conversation prefixes, by ROLLUP over positional columns of turn ids.

A turn is known by a 120-bit digest of its role and text, in two longs. ``BLOCK`` consecutive turns of a conversation
make one row with a pair of columns for each position, and one ``ROLLUP`` over the pairs aggregates all prefixes of
all rows together; ``grouping_id`` tells how many turns a group spans. A conversation of more turns goes on in further
rows, each keyed by the node its block starts from. These keys do not need block after block: digests of blocks are
digested again in groups of ``BLOCK``, and a block's key follows from those of the few groups before it, level by
level, so the rounds grow with the logarithm of the longest conversation.

Sums over subtrees need no walk either. Every node is represented by its smallest conversation, and the nodes that a
conversation represents are the last ones of its path. So a subtree's sum is the ``ROLLUP`` of what its members
represent, less what its own representative represents above it.

Turns are numbered over a range-partitioned sort, and a conversation with a large share of all turns is dealt over
several tasks. The ids of a node's ends are hashed in one sorted stream, in a few bytes of memory, as SHA-256 must.

Turns are ordered by ``turn``, NULL first; turns that tie are ordered by their digest. NULL role or text counts as
empty, repeated rows as turns of their own. Rows without a conv_id belong to no conversation and are left out. Empty
input has the root alone, if conversations without turns are given, or else no node. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfscope.llm.common import stored
from shelfscope.operators.numbering import numbered, running_total

BLOCK = 8
WORDS = r"[^\x20\x09-\x0D]+"
NO_IDS = hashlib.sha256(b"").hexdigest()


def _halves(digest: Column, *names: str) -> list[Column]:
    """The first 120 bits of a digest in hex, as two longs."""
    return [F.conv(F.substring(digest, 15 * i + 1, 15), 16, 10).cast("long").alias(n) for i, n in enumerate(names)]


def turn_index(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, a, b, n_words): the turns of each conversation from 1 on, by digest; no text goes further."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.sha2(role, 256), text), 256)
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.regexp_count(text, F.lit(WORDS)).cast("long").alias("n_words"), digest.alias("digest")
    )
    turns = turns.select("conv_id", "turn", "n_words", *_halves(F.col("digest"), "a", "b"))
    return numbered(turns, [F.col("turn").asc_nulls_first(), "a", "b"], "pos", ["conv_id"], 1).drop("turn")


def with_borrowed_heads(index: DataFrame, every: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns come from another: (turns as ``turn_index`` has them, all conv_ids).

    The first h turns, crc32 of the id modulo ``heads``, are those of the conversation ``conv_id - conv_id % every``,
    as many as it has. A lender has fewer than twice ``every`` borrowers, so no join key grows.
    """
    own = index.groupBy("conv_id").agg(F.max("pos").alias("n_own"))
    borrowers = own.select(
        "conv_id",
        (F.col("conv_id") - F.col("conv_id") % every).alias("lender"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h"),
    )
    lenders = own.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("lender"), F.col("n_own").alias("n_lender"))
    plan = borrowers.join(lenders, "lender", "left").withColumn("k", F.least("h", F.coalesce("n_lender", F.lit(0))))
    first = index.where((F.col("conv_id") % every == 0) & (F.col("pos") < heads)).withColumnRenamed("conv_id", "lender")
    borrowed = plan.select("conv_id", "lender", "h").join(first, "lender").where("pos <= h")
    rest = index.join(plan.select("conv_id", "h", "k"), "conv_id").where("pos > h").withColumn("pos", F.col("pos") - F.col("h") + F.col("k"))
    turns = borrowed.select(*index.columns).unionByName(rest.select(*index.columns))
    return stored(turns, "turns"), own.select("conv_id")


def _blocks(turns: DataFrame, conv_ids: DataFrame) -> DataFrame:
    """(conv_id, block, n, a1, b1, w1, ...): one row per block of turns; one empty row for a conversation without."""
    slot, block = (F.col("pos") - 1) % BLOCK + 1, F.floor((F.col("pos") - 1) / BLOCK)
    placed = [F.max(F.when(slot == k, F.col(c))).alias(f"{name}{k}") for k in range(1, BLOCK + 1) for name, c in (("a", "a"), ("b", "b"), ("w", "n_words"))]
    rows = turns.groupBy("conv_id", block.alias("block")).agg(F.count("*").alias("n"), *placed)
    turnless = conv_ids.join(turns.select("conv_id").distinct(), "conv_id", "left_anti").select("conv_id", F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("n"))
    return stored(rows.unionByName(turnless, allowMissingColumns=True), "blocks")


def _pairs(upto: int) -> list[str]:
    return [f"{c}{k}" for k in range(1, upto + 1) for c in "ab"]


def _node(level: Column, *names: str) -> list[Column]:
    """Key of the node that ``level`` turns of a block lead to from the block's own key."""
    parts = F.slice(F.array(*(F.col(c).cast("string") for c in ("p", "q", *_pairs(BLOCK)))), 1, (2 + 2 * level).cast("int"))
    return _halves(F.sha2(F.array_join(parts, ","), 256), *(names or ("x", "y")))


def _keyed(blocks: DataFrame) -> DataFrame:
    """``blocks`` with (p, q), the same for all that start from one prefix, and (up, uq), the node they start from."""
    longest = blocks.agg(F.max("block")).first()[0] or 0
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    if not longest:
        return blocks.withColumns({"p": zero, "q": zero, "up": none, "uq": none})
    digest = F.sha2(F.concat_ws(",", *_pairs(BLOCK)), 256)
    level = blocks.select("conv_id", F.col("block").alias("i"), F.when(F.col("n") == BLOCK, digest).alias("d"))
    levels, width = [level], longest + 1
    while width > BLOCK:
        ordered = F.array_sort(F.collect_list(F.struct("i", "d")))
        level = level.groupBy("conv_id", F.floor(F.col("i") / BLOCK).alias("i_")).agg(F.sha2(F.array_join(F.transform(ordered, lambda x: x["d"]), ","), 256).alias("d"))
        level = stored(level.withColumnRenamed("i_", "i"), "block-digests")
        levels.append(level)
        width = -(-width // BLOCK)
    above = None
    for level in reversed(levels):
        group = F.floor(F.col("i") / BLOCK)
        before = Window.partitionBy("conv_id", "g").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
        rows = level.withColumn("g", group).withColumn("earlier", F.array_join(F.collect_list("d").over(before), ","))
        rows = rows.withColumn("top", F.lit("")) if above is None else rows.join(above.select("conv_id", F.col("i").alias("g"), F.col("key").alias("top")), ["conv_id", "g"])
        above = rows.select("conv_id", "i", F.when(F.col("earlier") == "", F.col("top")).otherwise(F.sha2(F.concat_ws("/", "top", "earlier"), 256)).alias("key"))
    keys = above.select("conv_id", F.col("i").alias("block"), *(F.coalesce(h, zero).alias(n) for h, n in zip(_halves(F.col("key"), "p", "q"), "pq", strict=True)))
    keyed = stored(blocks.join(keys, ["conv_id", "block"]), "keyed-blocks")
    ends = keyed.where(F.col("n") == BLOCK).select("conv_id", (F.col("block") + 1).alias("block"), *_node(F.lit(BLOCK), "up", "uq"))
    return stored(keyed.join(ends, ["conv_id", "block"], "left"), "keyed-blocks")


def _rolled_up(blocks: DataFrame, **aggregates: str) -> DataFrame:
    """One row per prefix: block, key and columns of the block, ``level`` (turns of it that count), the aggregates."""
    composite = ", ".join(f"(a{k}, b{k})" for k in range(1, BLOCK + 1))
    wanted = ", ".join(f"{sql} {name}" for name, sql in aggregates.items())
    groups = blocks.sparkSession.sql(
        f"select block, p, q, {', '.join(_pairs(BLOCK))}, grouping_id() gid, {wanted} from {{rows}} group by block, p, q, rollup({composite})",
        rows=blocks,
    )
    # grouping_id has two bits for each pair that a group leaves out.
    ids = F.array(*(F.lit((1 << 2 * (BLOCK - level)) - 1).cast("long") for level in range(BLOCK + 1)))
    groups = groups.withColumn("level", (F.array_position(ids, F.col("gid").cast("long")) - 1).cast("int")).drop("gid")
    # A group whose last column is NULL only repeats a shorter prefix, and so does the start of a later block.
    last = F.get(F.array(*(f"a{k}" for k in range(1, BLOCK + 1))), F.col("level") - 1)
    return groups.where(F.when(F.col("level") == 0, F.col("block") == 0).otherwise(last.isNotNull()))


def _nodes(blocks: DataFrame) -> DataFrame:
    """(x, y) key, (ux, uy) key of the parent, conv_id, depth, n_convs, n_words of the last turn."""
    # All rows of a prefix agree in its words and in the node that its block starts from.
    same = {c: f"max({c})" for c in ("up", "uq", *(f"w{k}" for k in range(1, BLOCK + 1)))}
    groups = _rolled_up(blocks, n_convs="count(*)", conv_id="min(conv_id)", **same)
    level = F.col("level")
    words = F.get(F.array(*(f"w{k}" for k in range(1, BLOCK + 1))), level - 1)
    parent = [
        F.when(level > 1, own).when(level == 1, F.coalesce(from_block, own)).alias(name)
        for from_block, own, name in zip(("up", "uq"), _node(level - 1), ("ux", "uy"), strict=True)
    ]
    return groups.select(
        *_node(level, "x", "y"), *parent, "conv_id", (F.col("block") * BLOCK + level).alias("depth"), "n_convs", F.coalesce(words, F.lit(0)).alias("n_words")
    )


def prefix_trie(turns: DataFrame, conv_ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes of the trie, and the (x, y, conv_id) at whose node each conversation ends.

    ``turns`` as ``turn_index`` has them, ``conv_ids`` all conversations, those without turns too. Nodes: (x, y) key,
    conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens.
    """
    blocks = _keyed(_blocks(turns, conv_ids))
    nodes = stored(_nodes(blocks), "prefix-nodes")
    children = nodes.where("ux is not null").groupBy(F.col("ux").alias("x"), F.col("uy").alias("y")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["x", "y"], "left").fillna(0, ["n_children"])
    own = nodes.withColumns({"saved": (F.col("n_convs") - 1) * F.col("n_words"), "leaf": (F.col("n_children") == 0).cast("long")})
    own = stored(running_total(own, "depth", ["saved", "leaf"], ["conv_id"]), "prefix-nodes")
    represented = own.groupBy("conv_id").agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    below = _rolled_up(blocks.join(represented, "conv_id"), saved="sum(saved)", leaf="sum(leaf)")
    below = below.select(*_node(F.col("level"), "x", "y"), "saved", "leaf")
    parents = nodes.select(F.col("x").alias("ux"), F.col("y").alias("uy"), F.col("conv_id").alias("parent_conv_id"))
    full = own.drop("saved", "leaf").join(below, ["x", "y"], "left").join(parents, ["ux", "uy"], "left").select(
        "x", "y", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.coalesce("leaf", F.lit(0)) - F.col("before_leaf")).alias("n_leaves"),
        (F.coalesce("saved", F.lit(0)) - F.col("before_saved")).alias("saved_tokens"),
    )
    last = blocks.groupBy("conv_id").agg(F.max("block").alias("block"))
    ends = blocks.join(last, ["conv_id", "block"]).select(*_node(F.col("n"), "x", "y"), "conv_id")
    return full, ends


def joined_ids_sha256(ends: DataFrame) -> DataFrame:
    """(x, y, ends_sha256): SHA-256 of a node's conv_ids in order, comma-joined, as one stream over sorted rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            keys = list(zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True))
            ids = pa.compute.cast(batch.column("conv_id"), pa.string()).to_pylist()
            done, start = [], 0
            while start < len(keys):
                stop = start + 1
                while stop < len(keys) and keys[stop] == keys[start]:
                    stop += 1
                if keys[start] != at:
                    if at is not None:
                        done.append((*at, state.hexdigest()))
                    at, state = keys[start], hashlib.sha256()
                else:
                    state.update(b",")
                state.update(",".join(ids[start:stop]).encode())
                start = stop
            yield _digests(done)
        if at is not None:
            yield _digests([(*at, state.hexdigest())])

    dealt = ends.repartition("x", "y").sortWithinPartitions("x", "y", "conv_id").select("x", "y", "conv_id")
    return dealt.mapInArrow(run, "x long, y long, ends_sha256 string")


def _digests(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["x", "y", "ends_sha256"])
