"""Reversible line dedup: sharded cuckoo filters over exact reference counts.

A ``LineIndex`` keeps three tables in one folder of the shared store: ``postings`` (key, doc_id), one row per document
and line key; ``counts`` (key, n_docs, holder), the exact reference counts with the largest document holding each key;
and ``filters``, one cuckoo filter per shard over the keys found in at least ``min_docs`` documents. ``insert`` and
``delete`` bring counts up to date from the touched keys only and add or take out the filter entries of keys that
cross the threshold, so deleting documents undoes their insertion. ``apply`` asks the filters first (almost every line
is answered there) and settles their yes answers with the exact counts. Filters of bounded size are sent to the documents'
tasks; beyond that size, line keys are dealt out by shard and stream past the shard's filter. The state of an index is
written with each change, and ``LineIndex.open`` goes on from the newest one in a folder.

A key is the 128-bit digest of a line with outer white space removed and A-Z lower-cased, if it has ``min_chars`` code
points or more. NULL and empty texts are one empty line. Rows that repeat a doc_id count as one document. Rows with a NULL doc_id
are never counted, and they keep all their lines. Other columns of the input are kept by ``deduplicated`` and are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope.llm.common import batch_of, out_schema, over_texts, pieces, scratch

MIN_DOCS = 5
MIN_CHARS = 40
# Keys a filter shard is planned for; the number of shards grows with the keys.
SHARD_KEYS = 200_000
# All filters together may be sent to the tasks up to this size; beyond it keys and filters meet by shard.
FILTER_BYTES = 32 << 20
# Tasks that share the keys of one shard, each with a copy of its filter.
SHARD_TASKS = 16
_EDGE = " \t\n\x0b\x0c\r"
_SLOTS = 4


class CuckooFilter:
    """Fingerprints of 64-bit keys in buckets of four, each key in one of two buckets; supports removal.

    Keys that find no place after many moves go to a small overflow list, so a key that was added is always found.
    """

    def __init__(self, capacity: int):
        buckets = 1
        while buckets * _SLOTS * 0.9 < max(1, capacity):
            buckets *= 2
        self.table = np.zeros((buckets, _SLOTS), np.uint16)
        self.over: list[int] = []

    @staticmethod
    def _prints(keys: np.ndarray) -> np.ndarray:
        return ((keys >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return (keys & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _other(self, bucket, prints):
        mixed = (np.asarray(prints, np.uint64) * np.uint64(0x5BD1E995)) & np.uint64(len(self.table) - 1)
        return np.asarray(bucket, np.int64) ^ mixed.astype(np.int64)

    def add(self, keys: np.ndarray) -> None:
        for key, mark, bucket in zip(keys.tolist(), self._prints(keys).tolist(), self._first(keys).tolist()):
            for _ in range(200):
                free = np.flatnonzero(self.table[bucket] == 0)
                if not len(free):
                    bucket = int(self._other(bucket, mark))
                    free = np.flatnonzero(self.table[bucket] == 0)
                if len(free):
                    self.table[bucket, free[0]] = mark
                    break
                slot = mark % _SLOTS
                mark, self.table[bucket, slot] = int(self.table[bucket, slot]), mark
                bucket = int(self._other(bucket, mark))
            else:
                self.over.append((mark << 32) | min(bucket, int(self._other(bucket, mark))))

    def remove(self, keys: np.ndarray) -> None:
        for mark, bucket in zip(self._prints(keys).tolist(), self._first(keys).tolist()):
            other = int(self._other(bucket, mark))
            held = (mark << 32) | min(bucket, other)
            if held in self.over:
                self.over.remove(held)
                continue
            for place in (bucket, other):
                at = np.flatnonzero(self.table[place] == mark)
                if len(at):
                    self.table[place, at[0]] = 0
                    break

    def has(self, keys: np.ndarray) -> np.ndarray:
        prints, first = self._prints(keys), self._first(keys)
        other = self._other(first, prints)
        found = (self.table[first] == prints[:, None]).any(1) | (self.table[other] == prints[:, None]).any(1)
        if self.over:
            held = (prints.astype(np.int64) << 32) | np.minimum(first, other)
            found |= np.isin(held, np.array(self.over, np.int64))
        return found

    def to_bytes(self) -> bytes:
        over = np.array(self.over, np.int64)
        return len(self.table).to_bytes(8, "little") + self.table.tobytes() + over.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        out, buckets = cls(1), int.from_bytes(data[:8], "little")
        end = 8 + buckets * _SLOTS * 2
        out.table = np.frombuffer(data[8:end], np.uint16).reshape(buckets, _SLOTS).copy()
        out.over = np.frombuffer(data[end:], np.int64).tolist()
        return out


def _ascii_lower(text: str) -> str:
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def line_key(line: str, min_chars: int) -> bytes | None:
    """The digest of a line's key, or None for lines that are too short to count."""
    key = line.strip(_EDGE)
    if len(key) < min_chars:
        return None
    return hashlib.blake2b(_ascii_lower(key).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _halves(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The part of each key that names its shard and the part that is stored in the shard's filter."""
    both = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _keys_of(docs: DataFrame, min_chars: int, filters: tuple[int, object] | None = None) -> DataFrame:
    """(doc_id, key, shard_hash) of each distinct key of a document; with filters, only keys they may hold."""
    number, sent = filters or (0, None)

    def make():
        loaded = {s: CuckooFilter.from_bytes(b) for s, b in sent.value.items()} if sent else None

        def work(part: pa.RecordBatch, texts: list) -> pa.RecordBatch | None:
            rows, keys = [], []
            for row, text in enumerate(texts):
                mine = dict.fromkeys(k for line in (text or "").split("\n") if (k := line_key(line, min_chars)))
                rows += [row] * len(mine)
                keys += mine
            if not keys:
                return None
            shard_part, filter_part = _halves(keys)
            rows = np.array(rows)
            if loaded is not None:
                shards = (shard_part % np.uint64(number)).astype(np.int64)
                kept = np.zeros(len(keys), bool)
                for shard in np.unique(shards).tolist():
                    at = np.flatnonzero(shards == shard)
                    if shard in loaded:
                        kept[at] = loaded[shard].has(filter_part[at])
                at = np.flatnonzero(kept)
                if not len(at):
                    return None
                rows, keys = rows[at], [keys[i] for i in at.tolist()]
            return batch_of(part.column("doc_id").take(pa.array(rows)), key=pa.array(keys, pa.binary()))

        return work

    return over_texts(docs.where("doc_id is not null"), make, out_schema(docs, "key binary"))


class LineIndex:
    """The state of incremental line dedup; each change is written as a new version and read back."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, folder: str | None = None):
        self.spark, self.min_docs, self.min_chars = spark, min_docs, min_chars
        self.folder, self.version, self.shards = folder or scratch(spark, "line-index"), 0, 1
        self.postings: DataFrame | None = None
        self.counts: DataFrame | None = None
        self.filters: DataFrame | None = None
        self.paths: dict[str, str] = {}

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> LineIndex:
        """The index as its last finished change left it in ``folder``."""
        states = spark.read.schema("version int, shards int, min_docs int, min_chars int, tables map<string,string>").json(f"{folder}/states/*")
        state = states.orderBy(F.col("version").desc()).first()
        index = cls(spark, state["min_docs"], state["min_chars"], folder)
        index.version, index.shards, index.paths = state["version"], state["shards"], state["tables"]
        index.postings, index.counts, index.filters = (spark.read.parquet(index.paths[n]) for n in ("postings", "counts", "filters"))
        return index

    def _save(self) -> None:
        """Written last, so a change that was cut short leaves the state before it."""
        tables = F.create_map(*(F.lit(x) for item in sorted(self.paths.items()) for x in item))
        row = self.spark.range(1, numPartitions=1).select(
            *(F.lit(v).alias(n) for n, v in (("version", self.version), ("shards", self.shards), ("min_docs", self.min_docs), ("min_chars", self.min_chars))),
            tables.alias("tables"),
        )
        row.write.mode("overwrite").json(f"{self.folder}/states/v{self.version}")

    def _written(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/v{self.version}/{name}"
        df.write.mode("overwrite").parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def _counted(self, postings: DataFrame) -> DataFrame:
        """Exact counts. The pair grouping inside spreads a hot key over all tasks before keys meet."""
        return postings.groupBy("key").agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("holder"))

    def insert(self, docs: DataFrame) -> LineIndex:
        self.version += 1
        added = self._written(_keys_of(docs, self.min_chars), "added")
        if self.postings is None:
            self.postings, self.paths["postings"] = added, self.paths["added"]
            fresh = self._counted(added)
            return self._settle(None, fresh)
        # A document may be given again: only its new pairs are added.
        added = self._written(added.distinct().join(self.postings, ["key", "doc_id"], "left_anti"), "fresh")
        return self._change(self._written(self.postings.unionByName(added), "postings"), added)

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """Forget all lines of the given documents (a frame with column doc_id)."""
        self.version += 1
        gone = doc_ids.select("doc_id").where("doc_id is not null").distinct()
        touched = self._written(self.postings.join(gone, "doc_id", "left_semi").select("key", "doc_id"), "touched")
        return self._change(self._written(self.postings.join(gone, "doc_id", "left_anti"), "postings"), touched)

    def _change(self, postings: DataFrame, touched: DataFrame) -> LineIndex:
        keys = touched.select("key").distinct()
        before, self.postings = self.counts, postings
        fresh = self._counted(postings.join(keys, "key", "left_semi"))
        changed = keys.join(fresh, "key", "left").select("key", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), "holder")
        return self._settle(before, changed)

    def _settle(self, before: DataFrame | None, changed: DataFrame) -> LineIndex:
        """Write the counts with the changed keys in place of the old ones, and move filter entries that crossed."""
        if before is None:
            self.counts = self._written(changed.where("n_docs > 0"), "counts")
            frequent = self.counts.where(F.col("n_docs") >= self.min_docs)
            self.shards = max(1, -(-frequent.count() // SHARD_KEYS))
            crossed = frequent.select("key", F.lit(1).alias("step"))
        else:
            changed = self._written(changed, "changed")
            old = before.join(changed.select("key"), "key", "left_semi").select("key", F.col("n_docs").alias("old"))
            steps = changed.join(old, "key", "left").select(
                "key",
                ((F.col("n_docs") >= self.min_docs).cast("int") - (F.coalesce("old", F.lit(0)) >= self.min_docs).cast("int")).alias("step"),
            )
            crossed = steps.where("step <> 0")
            kept = before.join(changed.select("key"), "key", "left_anti")
            self.counts = self._written(kept.unionByName(changed.where("n_docs > 0")), "counts")
            frequent = self.counts.where(F.col("n_docs") >= self.min_docs)
            if (n := frequent.count()) > 2 * SHARD_KEYS * self.shards:
                # The shards are full: deal all frequent keys out to more of them.
                self.shards, self.filters = -(-n // SHARD_KEYS), None
                crossed = frequent.select("key", F.lit(1).alias("step"))
        self.filters = self._written(self._moved(crossed), "filters")
        self.paths = {n: self.paths[n] for n in ("postings", "counts", "filters")}
        self._save()
        return self

    def _shard(self):
        """The number of a key's shard, as a column function."""
        shards = self.shards

        def number(keys: pd.Series) -> pd.Series:
            return pd.Series((_halves(keys.tolist())[0] % np.uint64(shards)).astype(np.int64)) if len(keys) else pd.Series([], dtype="int64")

        return F.pandas_udf(number, "long")

    def _moved(self, crossed: DataFrame) -> DataFrame:
        shard = self._shard()
        old = self.filters if self.filters is not None else self.spark.createDataFrame([], "shard long, filter binary")

        def rebuild(key: tuple, stored: pd.DataFrame, moves: pd.DataFrame) -> pd.DataFrame:
            one = CuckooFilter.from_bytes(stored["filter"].iloc[0]) if len(stored) else CuckooFilter(2 * SHARD_KEYS)
            for step, change in ((-1, one.remove), (1, one.add)):
                keys = moves.loc[moves["step"] == step, "key"].tolist()
                if keys:
                    change(_halves(sorted(keys))[1])
            return pd.DataFrame({"shard": [key[0]], "filter": [one.to_bytes()]})

        moves = crossed.withColumn("shard", shard("key"))
        return old.groupBy("shard").cogroup(moves.groupBy("shard")).applyInPandas(rebuild, "shard long, filter binary")

    def _asked(self, keys: DataFrame) -> DataFrame:
        """The (doc_id, key) rows that the filters may hold. Rows of a shard are sorted behind its filter and stream past it."""
        task = F.pmod(F.xxhash64("doc_id"), F.lit(SHARD_TASKS)).cast("int")
        rows = keys.select(self._shard()("key").alias("shard"), task.alias("task"), F.lit(None).cast("binary").alias("filter"), "doc_id", "key")
        copies = self.filters.select("shard", F.explode(F.sequence(F.lit(0), F.lit(SHARD_TASKS - 1))).alias("task"), "filter")
        both = copies.unionByName(rows, allowMissingColumns=True)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, one = None, None
            for batch in batches:
                places = np.stack([batch.column(c).to_numpy() for c in ("shard", "task")], 1)
                changes = np.flatnonzero((places[1:] != places[:-1]).any(1)) + 1
                kept = np.zeros(batch.num_rows, bool)
                for start, stop in zip([0, *changes.tolist()], [*changes.tolist(), batch.num_rows], strict=True):
                    if tuple(places[start]) != at:
                        at, one = tuple(places[start]), None
                        if (data := batch.column("filter")[start].as_py()) is not None:
                            one, start = CuckooFilter.from_bytes(data), start + 1
                    if one is not None and start < stop:
                        kept[start:stop] = one.has(_halves(batch.column("key").slice(start, stop - start).to_pylist())[1])
                yield batch.select(["doc_id", "key"]).filter(pa.array(kept))

        dealt = both.repartition("shard", "task").sortWithinPartitions("shard", "task", F.col("filter").isNull())
        return dealt.mapInArrow(run, keys.schema)

    def doomed(self, docs: DataFrame) -> DataFrame:
        """(doc_id, keys): the keys whose lines a document loses."""
        total = self.filters.agg(F.sum(F.length("filter"))).first()[0] or 0
        if total <= FILTER_BYTES:
            sent = self.spark.sparkContext.broadcast({r["shard"]: bytes(r["filter"]) for r in self.filters.collect()})
            asked = _keys_of(docs, self.min_chars, (self.shards, sent))
        else:
            asked = self._asked(_keys_of(docs, self.min_chars))
        frequent = self.counts.where(F.col("n_docs") >= self.min_docs).select("key", "holder")
        hits = asked.join(frequent, "key")
        return hits.where(F.col("doc_id") != F.col("holder")).groupBy("doc_id").agg(F.collect_set("key").alias("doomed_keys"))

    def apply(self, docs: DataFrame) -> DataFrame:
        """The documents with ``kept_text``, ``n_lines`` and ``n_dropped``; only doc_id and text are read."""
        plain = docs.select("doc_id", "text")
        min_chars = self.min_chars

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, texts in (piece for whole in batches for piece in pieces(whole)):
                n_lines, n_dropped, kept = [], [], []
                for text, keys in zip(texts, batch.column("doomed_keys").to_pylist()):
                    lines = (text or "").split("\n")
                    gone = set(keys or ())
                    left = [line for line in lines if line_key(line, min_chars) not in gone] if gone else lines
                    n_lines.append(len(lines))
                    n_dropped.append(len(lines) - len(left))
                    kept.append("\n".join(left))
                yield batch_of(batch.column("doc_id"), kept_text=pa.array(kept, pa.string()),
                               n_lines=pa.array(n_lines, pa.int64()), n_dropped=pa.array(n_dropped, pa.int64()))

        both = plain.join(self.doomed(docs), "doc_id", "left")
        return both.mapInArrow(run, out_schema(docs, "kept_text string, n_lines long, n_dropped long"))


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """All documents through a new index: (doc_id, kept_text, n_lines, n_dropped)."""
    return LineIndex(docs.sparkSession, min_docs, min_chars).insert(docs).apply(docs)


def deduplicated(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents with their columns, texts without the lines they lose. A text that loses nothing stays as it is (NULL too);
    where a column n_chars exists it follows the text."""
    index = LineIndex(docs.sparkSession, min_docs, min_chars).insert(docs)
    lost = index.doomed(docs).withColumnRenamed("doc_id", "lost_doc_id").withColumnRenamed("doomed_keys", "lost_keys")
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, here in (piece for whole in batches for piece in pieces(whole)):
            keys = batch.column("lost_keys")
            out = batch.drop_columns(["lost_doc_id", "lost_keys"])
            if keys.null_count < len(keys):
                texts = []
                for text, lost_here in zip(here, keys.to_pylist()):
                    gone = set(lost_here or ())
                    texts.append("\n".join(x for x in text.split("\n") if line_key(x, min_chars) not in gone) if gone else text)
                out = out.set_column(out.schema.get_field_index("text"), out.schema.field("text"), pa.array(texts, pa.string()))
            yield out

    kept = docs.join(lost, docs["doc_id"] == lost["lost_doc_id"], "left").mapInArrow(run, schema)
    if "n_chars" in docs.columns:
        counted = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(schema["n_chars"].dataType))
        kept = kept.withColumn("n_chars", counted)
    return kept.select(*docs.columns)
