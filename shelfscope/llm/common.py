"""Reading texts in bounded pieces inside Arrow tasks, and values kept once per distinct word."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfscope.session import shared_folder

# Bytes of text a task holds as Python words at a time; one longer text is a piece of its own.
PIECE_BYTES = 4 << 20
# Distinct words whose values a task keeps; when full, the table starts anew.
KEPT_WORDS = 600_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the one that all executors share."""
    return os.path.join(shared_folder(spark), "shelfscope-llm", f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: cuts lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(column: str, modulus: int) -> Column:
    """crc32 of an id written as text, modulo a number: the fixed folds of the learned operators."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, bound: int) -> DataFrame:
    """(doc_id, text, label) of at most ``bound`` labelled training documents, chosen by a hash of the id.

    The chosen label rows are few by that bound, so Spark sends them to the documents and no text moves.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & train)
        .groupBy("doc_id")
        .agg(F.min(label).alias("label"))
        .orderBy(F.xxhash64(F.lit(17), "doc_id"), "doc_id")
        .limit(bound)
    )
    return docs.select("doc_id", "text").where("text is not null").join(chosen, "doc_id")


def pieces(batch: pa.RecordBatch, column: str = "text", size: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of a batch with at most ``size`` bytes of text each, and their texts (NULL as None)."""
    lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        part = batch.slice(start, stop - start)
        yield part, part.column(column).to_pylist()
        start = stop


def over_texts(
    docs: DataFrame, make: Callable[[], Callable[[pa.RecordBatch, list], pa.RecordBatch | None]], schema: T.StructType, *columns: str, size: int = PIECE_BYTES
) -> DataFrame:
    """Rows made from pieces of (columns, text); ``make`` runs once a task and returns the work on a piece of ``size`` bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part, texts in pieces(batch, size=size):
                out = work(part, texts)
                if out is not None:
                    yield out

    return docs.select(*(columns or ("doc_id",)), "text").mapInArrow(run, schema)


def out_schema(docs: DataFrame, rest: str) -> T.StructType:
    """doc_id as the documents have it, then the columns of a DDL string."""
    return T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *T.StructType.fromDDL(rest).fields])


def batch_of(doc_ids: pa.Array, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [doc_ids, *(c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values())], ["doc_id", *columns]
    )


class WordTable(dict):
    """Numbers distinct words; ``values`` holds one row of numbers for each, computed once for many words at a time."""

    def __init__(self, compute: Callable[[list], np.ndarray], limit: int = KEPT_WORDS):
        super().__init__()
        self.compute, self.limit, self.new, self.values = compute, limit, [], None

    def __missing__(self, word):
        number = self[word] = len(self)
        self.new.append(word)
        return number

    def numbers(self, words: list) -> np.ndarray:
        """A number for each word; rows of ``values`` up to date."""
        if len(self) > self.limit:
            self.clear()
            self.values = None
        numbers = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.new or self.values is None:
            fresh = self.compute(self.new)
            self.values = fresh if self.values is None else np.concatenate([self.values, fresh])
            self.new = []
        return numbers

    def rows(self, words: list) -> np.ndarray:
        """The row of numbers of each word."""
        numbers = self.numbers(words)
        return self.values[numbers]


def split_all(texts: list, split: Callable[[str], list]) -> tuple[list, np.ndarray]:
    """All words of the texts in one list, and the bounds of each text in it."""
    words: list = []
    bounds = np.zeros(len(texts) + 1, np.int64)
    for i, text in enumerate(texts):
        if text:
            words += split(text)
        bounds[i + 1] = len(words)
    return words, bounds


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of consecutive segments; an empty segment gives 0. Segments are summed apart, so a text's sum
    does not depend on its neighbours."""
    out = np.zeros((len(bounds) - 1, *values.shape[1:]), np.float64)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, bounds[full], axis=0, dtype=np.float64)
    return out


def segment_max(values: np.ndarray, bounds: np.ndarray, empty: float) -> np.ndarray:
    out = np.full(len(bounds) - 1, empty, np.float64)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(full):
        out[full] = np.maximum.reduceat(values, bounds[full])
    return out


def substring_codes(words: list[str], least: int, most: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams of ``<word>`` for all words at once: (bucket, number of the word)."""
    text = "".join(f"<{w}>" for w in words)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), lengths)
    grams, owners = [], []
    rolled = np.zeros(len(codes), np.uint64)
    for n in range(1, most + 1):
        if len(codes) < n:
            break
        rolled = rolled[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :]
        if n >= least:
            inside = owner[: len(rolled)] == owner[n - 1 :]
            mixed = (rolled[inside] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            grams.append((mixed >> np.uint64(40)).astype(np.int64) % buckets)
            owners.append(owner[: len(rolled)][inside])
    if not grams:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(grams), np.concatenate(owners)


_TABLES: dict[str, WordTable] = {}


def worker_table(key: str, make: Callable[[], WordTable]) -> WordTable:
    """The word table of a model, kept by a Python worker from task to task; another model's table replaces it."""
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = make()
    return _TABLES[key]
