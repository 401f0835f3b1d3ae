"""Exact n-gram Jaccard join of documents by token-combination prefixes.

A token is the 64-bit hash of a five-word shingle. Tokens fall into two classes by the number of documents holding them:
rare ones come first in the order of every document, frequent ones last. Two documents whose similarity reaches the threshold share a
token in the first ``n - ceil(t n) + 1`` tokens of each (the prefix). While that prefix is rare, its tokens are indexed one by
one. Where it reaches into the frequent class it is extended by k - 1 tokens, so that a pair without a common rare token
shares k frequent ones; these are dealt into k - 1 groups by hash, so two of them meet in a group, and pairs of tokens of a group are
indexed. Candidates are those that meet under a key and may be similar by their sizes. They are verified twice: by folded bitmaps, whose differing bits never
exceed the symmetric difference, and by the token sets themselves.

Exact copies (equal token sets) are one class before the join. Candidates of a key are first its smallest document with all others; keys
whose documents are then in one component are done, and in the others only pairs across components follow. Pairs without a common rare token share their frequent ones at
most, which rules out most pairs of a group by their sizes. So a group of many near copies costs a row per document and key, not a row per pair, and no link between different texts is lost.

NULL and empty texts, and texts without words, have no tokens and are linked with nothing. Shorter texts are one shingle. Rows that
repeat a doc_id count as documents of their own text and have its component; different texts of an id are not joined by it. NULL ids are kept as rows and linked with nothing.
Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfscope.llm.common import WordTable, batch_of, out_schema, over_texts, pieces, stored, worker_table

WORDS = 5
PERCENT = 80
FREQUENT = 64  # documents that make a token frequent; raised while more than MOST_FREQUENT tokens are
MOST_FREQUENT = 1 << 18  # the list of frequent tokens is sent to the tasks, so its size has a bound
BUCKET_TOKENS = 2_000_000  # tokens counted by one task
_MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
_STIR = np.uint64(0xFF51AFD7ED558CCD)


def _stirred(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _STIR
    return x ^ (x >> np.uint64(29))


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split()


class Tokens:
    """Sorted distinct shingle hashes of texts."""

    def __init__(self):
        self.known = worker_table("jaccard-words", lambda: WordTable(_word_hashes))

    def of(self, texts: list) -> list[np.ndarray]:
        words: list = []
        bounds = [0]
        for text in texts:
            if text:
                words += words_of(text)
            bounds.append(len(words))
        numbers = self.known.numbers(words)
        hashes = self.known.values[numbers] if len(words) else np.zeros(0, np.uint64)
        n = max(0, len(words) - WORDS + 1)
        rolled = np.zeros(n, np.uint64)
        for k in range(WORDS):
            rolled += hashes[k : k + n] * _MIX[k]
        rolled = _stirred(rolled)
        out = []
        for low, high in zip(bounds, bounds[1:]):
            if high - low >= WORDS:
                out.append(_distinct(rolled[low : high - WORDS + 1]))
            elif high > low:
                short = xxhash.xxh3_64_intdigest(b" ".join(words[low:high]), seed=high - low)
                out.append(np.array([short], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
        return out


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    return values[keep]


def least_overlap(n: int) -> int:
    """Tokens that a document of n tokens shares with any similar one, at least."""
    return -(-PERCENT * n // 100)


def _size_class(n: int) -> int:
    return int(n).bit_length()


def _groups(size_class: int) -> int:
    """Groups of frequent tokens for documents of a size class: about as many as a prefix has tokens."""
    return max(1, (1 << size_class) * (100 - PERCENT) // 200)


def index_keys(tokens: np.ndarray, is_frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys under which a document is indexed: rare prefix tokens, and pairs of frequent tokens where those reach in."""
    n = len(tokens)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    prefix = n - least_overlap(n) + 1
    rare, common = tokens[~is_frequent], tokens[is_frequent]
    keys = [np.zeros(0, np.uint64)]
    if len(rare) < prefix:
        # A partner may be a quarter larger, and the larger one's class decides the number of groups.
        for size_class in {_size_class(n), _size_class(n * 100 // PERCENT)}:
            groups = _groups(size_class)
            if groups + 1 > min(least_overlap(1 << (size_class - 1)), least_overlap(n)):
                # Too few shared tokens for pairs: frequent prefix tokens are indexed one by one, apart from rare ones.
                keys.append(_stirred(common[: prefix - len(rare)] + np.uint64(size_class)))
                continue
            part = common[: prefix + groups - len(rare)]
            group = (part >> np.uint64(7)) % np.uint64(groups)
            by = np.argsort(group, kind="stable")
            part, group = part[by], group[by]
            for gap in range(1, len(part)):
                same = group[gap:] == group[:-gap]
                if not same.any():
                    break  # sorted by group: without neighbours at this distance there are none farther
                a, b = part[:-gap][same], part[gap:][same]
                keys.append(_stirred(a * _MIX[0] + b * _MIX[1] + np.uint64(size_class)))
    return rare[:prefix].view(np.int64), np.concatenate(keys).view(np.int64)


def bitmap(tokens: np.ndarray) -> bytes:
    """A bit per hash value modulo the size, flipped once a token; about four bits a token."""
    bits = 64
    while bits < 4 * len(tokens):
        bits *= 2
    flipped = np.bincount((tokens >> np.uint64(11)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(flipped.astype(np.uint8)).tobytes()


def may_be_similar(a: bytes, b: bytes, n_a: int, n_b: int) -> bool:
    """False only if the bitmaps prove the similarity to be under the threshold."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    differing = int(np.bitwise_count(x ^ y).sum())
    # |A xor B| = a + b - 2 o with 100 o >= PERCENT (a + b - o)
    shared = -(-PERCENT * (n_a + n_b) // (100 + PERCENT))
    return differing <= n_a + n_b - 2 * shared


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    shared = len(a) + len(b) - len(_distinct(np.concatenate([a, b])))
    return 100 * shared >= PERCENT * (len(a) + len(b) - shared)


def _codes(tokens: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket that counts a token, and its mark in that bucket."""
    return (tokens >> np.uint64(32)) % np.uint64(buckets), (tokens & np.uint64(0xFFFFFFFF)).astype("<u4")


class FrequentTokens:
    """The frequent class, as a test that depends on the token alone."""

    def __init__(self, codes: np.ndarray, buckets: int):
        self.codes, self.buckets = codes, buckets

    def has(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.codes):
            return np.zeros(len(tokens), bool)
        bucket, mark = _codes(tokens, self.buckets)
        codes = (bucket << np.uint64(32)) | mark.astype(np.uint64)
        return self.codes[np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)] == codes


def frequent_tokens(docs: DataFrame, frequent: int = FREQUENT) -> FrequentTokens:
    """Tokens held by more than ``frequent`` documents.

    Every token of every document is counted. Each task adds up the tokens of a slice of its texts and sends a bucket's
    marks packed into one value, those found more than once with their counts, so a token that every document holds is one
    entry per slice. A bucket is one task's share, and their number grows with the corpus. Tokens with equal codes count together, which can only move a rare token to the
    other class, for all documents alike.
    """
    chars = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, chars // (6 * BUCKET_TOKENS))

    def make():
        tokens = Tokens()

        def work(part: pa.RecordBatch, texts: list) -> pa.RecordBatch | None:
            every = np.concatenate(tokens.of(texts))
            if not len(every):
                return None
            bucket, mark = _codes(every, buckets)
            codes, times = np.unique((bucket << np.uint64(32)) | mark.astype(np.uint64), return_counts=True)
            bucket, mark = codes >> np.uint64(32), (codes & np.uint64(0xFFFFFFFF)).astype("<u4")
            starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            again = times > 1
            once_at, again_at = (np.cumsum(np.r_[0, x]) for x in (~again, again))
            once, repeated = mark[~again], np.stack([mark[again], times[again].astype("<u4")], 1)
            ends = np.r_[starts[1:], len(bucket)]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket[starts].astype(np.int64)),
                    pa.array([once[once_at[a] : once_at[b]].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                    pa.array([repeated[again_at[a] : again_at[b]].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                ],
                ["bucket", "marks", "repeated"],
            )

        return work

    packed = over_texts(docs, make, T.StructType.fromDDL("bucket long, marks binary, repeated binary"))

    def count(batches):
        held: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for bucket, marks, repeated in zip(batch.column("bucket").to_pylist(), batch.column("marks"), batch.column("repeated")):
                mine = held.setdefault(bucket, ([], []))
                mine[0].append(np.frombuffer(marks.as_py(), "<u4"))
                mine[1].append(np.frombuffer(repeated.as_py(), "<u4").reshape(-1, 2))
        for bucket in list(held):
            once, repeated = map(np.concatenate, held.pop(bucket))
            marks, place = np.unique(np.concatenate([once, repeated[:, 0]]), return_inverse=True)
            times = np.bincount(place, np.concatenate([np.ones(len(once)), repeated[:, 1]])).astype(np.int64)
            often = times > frequent
            if often.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(int(often.sum()), bucket)), pa.array(marks[often].astype(np.int64)), pa.array(times[often].astype(np.int64))],
                    ["bucket", "mark", "n"],
                )

    found = stored(packed.repartition(int(buckets), "bucket").mapInArrow(count, "bucket long, mark long, n long"), "frequent")
    total = found.count()
    if total > MOST_FREQUENT:
        # The class keeps the most frequent tokens; those left out are indexed one by one like rare ones.
        least = found.select(F.percentile_approx("n", 1 - MOST_FREQUENT / total, 100_000)).first()[0]
        found = found.where(F.col("n") > least).limit(2 * MOST_FREQUENT)
    rows = found.select("bucket", "mark").toArrow()
    codes = (rows["bucket"].to_numpy().astype(np.uint64) << np.uint64(32)) | rows["mark"].to_numpy().astype(np.uint64)
    return FrequentTokens(np.sort(codes), int(buckets))


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *values])))


def _digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def indexed(docs: DataFrame, frequent: FrequentTokens) -> DataFrame:
    """(doc_id, n, digest, rare_keys, pair_keys, common, bits) of every row; common: its frequent tokens; a narrow plan."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent)  # at most twice MOST_FREQUENT codes

    def make():
        tokens, known = Tokens(), sent.value

        def work(part: pa.RecordBatch, texts: list) -> pa.RecordBatch:
            sets = tokens.of(texts)
            flags = np.split(known.has(np.concatenate(sets)), np.cumsum([len(s) for s in sets])[:-1])
            keys = [index_keys(s, f) for s, f in zip(sets, flags)]
            return batch_of(
                part.column("doc_id"),
                n=pa.array([len(s) for s in sets], pa.int64()),
                digest=pa.array([_digest(s) for s in sets], pa.binary()),
                rare_keys=_lists([k for k, _ in keys]),
                pair_keys=_lists([k for _, k in keys]),
                common=pa.array([int(f.sum()) for f in flags], pa.int64()),
                bits=pa.array([bitmap(s) for s in sets], pa.binary()),
            )

        return work

    return over_texts(docs, make, out_schema(docs, "n long, digest binary, rare_keys array<long>, pair_keys array<long>, common long, bits binary"))


def _rare_members(entries: DataFrame) -> DataFrame:
    """Rows of keys that two or more documents share, with the key's first document, from (key, node, n).

    ``most`` is what two documents that meet here may share at most: for a rare key, all tokens.

    A rare key has few documents, so keys are dealt out evenly; each task reads its sorted rows as a stream.
    """

    def run(batches):
        held = None  # the last row, whose key may go on in the next batch
        first = None  # (key, node, n) of the first row of that key
        for batch in batches:
            key, node, n = (batch.column(c).to_numpy() for c in ("key", "node", "n"))
            if held is not None:
                key, node, n = (np.concatenate([[h], x]) for h, x in zip(held, (key, node, n)))
            opens = np.r_[True, key[1:] != key[:-1]]
            start = np.flatnonzero(opens)[np.cumsum(opens) - 1]
            pivot, pivot_n = node[start], n[start]
            if first is not None and first[0] == key[0]:
                mine = key == first[0]
                pivot[mine], pivot_n[mine] = first[1], first[2]
            goes_on = np.r_[key[1:] == key[:-1], False]
            shared = goes_on | (node != pivot) | ~opens
            shared[-1] = False  # decided with the next batch, or at the end
            at = np.flatnonzero(shared)
            if len(at):
                yield _member_batch(key[at], node[at], n[at], pivot[at], pivot_n[at])
            held, first = (key[-1], node[-1], n[-1]), (key[-1], pivot[-1], pivot_n[-1])
        if held is not None and first[1] != held[1]:
            yield _member_batch(*(np.array([x]) for x in (*held, first[1], first[2])))

    dealt = entries.repartition("key").sortWithinPartitions("key", "node")
    found = dealt.mapInArrow(run, "key long, node long, n long, pivot long, pivot_n long")
    return found.withColumn("most", F.col("n")).withColumn("pivot_most", F.col("pivot_n"))


def _member_batch(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["key", "node", "n", "pivot", "pivot_n"])


def _pair_members(entries: DataFrame) -> DataFrame:
    """The same for pair keys, which may hold any number of documents: grouped with partial sums, and joined.

    Documents that only meet here have no rare token in common, so they share their frequent ones at most. The first
    document is the one with the fewest rare tokens: in a group of near copies, the text the others come from.
    """
    best = F.min(F.struct((F.col("n") - F.col("common")).alias("rare"), "node", "n", "common")).alias("p")
    first = entries.groupBy("key").agg(best, F.count("*").alias("c")).where("c > 1")
    return entries.join(first, "key").select(
        "key", "node", "n", F.col("p.node").alias("pivot"), F.col("p.n").alias("pivot_n"), F.col("common").alias("most"), F.col("p.common").alias("pivot_most")
    )


def _may_fit(na: str, nb: str, most_a: str, most_b: str):
    """Whether two documents of these sizes reach the threshold if they share as much as they may."""
    return F.expr(f"100 * least({most_a}, {most_b}) >= {PERCENT} * ({na} + {nb} - least({most_a}, {most_b}))")


def _verified(candidates: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs of nodes (a, b) whose token sets are similar."""
    bits = classes.select(F.col("node").alias("id"), F.col("bits").alias("value"), "n")
    left = stored(_checked(candidates, bits, may_be_similar), "jaccard-candidates")
    if left.isEmpty():
        return left
    wanted = left.select(F.col("a").alias("node")).union(left.select(F.col("b").alias("node"))).distinct()
    wanted = stored(classes.join(wanted, "node", "left_semi").select("node", "doc_id", "digest", "n"), "jaccard-wanted")

    def make():
        tokens = Tokens()

        def work(part: pa.RecordBatch, texts: list) -> pa.RecordBatch:
            sets = tokens.of(texts)
            return pa.RecordBatch.from_arrays(
                [pa.array([_digest(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["digest", "value"]
            )

        return work

    sets = over_texts(docs.join(wanted.select("doc_id"), "doc_id", "left_semi"), make, T.StructType.fromDDL("digest binary, value binary"))
    values = stored(sets.join(wanted.select("digest", F.col("node").alias("id"), "n"), "digest").select("id", "value", "n"), "jaccard-sets")
    return stored(_checked(left, values, _similar_bytes), "jaccard-links").distinct()


def _similar_bytes(a: bytes, b: bytes, n_a: int, n_b: int) -> bool:
    return similar(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64))


def _links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """All links (a, b) between classes that components need."""

    def entries(keys: str) -> DataFrame:
        return classes.select(F.explode(F.array_distinct(keys)).alias("key"), "node", "n", "common")

    members = stored(_rare_members(entries("rare_keys").drop("common")).unionByName(_pair_members(entries("pair_keys"))), "jaccard-members")
    stars = members.where("node <> pivot").where(_may_fit("n", "pivot_n", "most", "pivot_most"))
    stars = stars.select(F.least("pivot", "node").alias("a"), F.greatest("pivot", "node").alias("b")).distinct()
    first = _verified(stars, classes, docs)
    labels = components(members.select(F.col("node").alias("id")).distinct(), first, "jaccard-stars")
    # Keys whose documents are not yet one component: those outside the largest one meet the others.
    placed = stored(members.join(labels.withColumnRenamed("id", "node"), "node"), "jaccard-placed")
    shares = placed.groupBy("key", "label").agg(F.count("*").alias("c"))
    mixed = shares.groupBy("key").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.count("*").alias("labels")).where("labels > 1")
    a = placed.join(mixed.select("key", "main"), "key").where("label <> main and node <> pivot")
    a = a.select("key", F.col("node").alias("a"), F.col("n").alias("na"), F.col("label").alias("la"), F.col("most").alias("ma"), "main")
    b = placed.where("node <> pivot").select("key", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("label").alias("lb"), F.col("most").alias("mb"))
    crossing = a.join(b, "key").where("la <> lb and (lb = main or a < b)").where(_may_fit("na", "nb", "ma", "mb"))
    ordered = crossing.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return first.unionByName(_verified(ordered, classes, docs))


def _checked(pairs: DataFrame, values: DataFrame, test) -> DataFrame:
    """Pairs (a, b) that pass ``test`` on the values (id, value, n) of both."""
    left = values.select(F.col("id").alias("a"), F.col("value").alias("va"), F.col("n").alias("na"))
    right = values.select(F.col("id").alias("b"), F.col("value").alias("vb"), F.col("n").alias("nb"))

    def run(batches):
        for batch in batches:
            columns = [batch.column(c) for c in ("va", "vb", "na", "nb")]
            keep = pa.array([test(x.as_py(), y.as_py(), m.as_py(), n.as_py()) for x, y, m, n in zip(*columns)], pa.bool_())
            yield batch.select(["a", "b"]).filter(keep)

    return pairs.join(left, "a").join(right, "b").select("a", "b", "va", "vb", "na", "nb").mapInArrow(run, pairs.select("a", "b").schema)


def components(nodes: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """(id, label): the smallest id reachable from each node over edges (a, b).

    Labels fall along edges and then along the labels themselves, so chains halve from round to round. Every round is
    written to the shared folder.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), f"{name}-edges")
    labels = nodes.select("id", F.col("id").alias("label"))
    if both.isEmpty():
        return labels
    current = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label")), f"{name}-labels")
    while True:
        near = both.join(current.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        lower = current.join(near, "id").select("id", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        lower = stored(lower, f"{name}-labels")
        jumped = lower.join(lower.select(F.col("id").alias("label"), F.col("label").alias("further")), "label", "left")
        after = stored(jumped.select("id", F.least("label", F.coalesce("further", "label")).alias("label"), "was"), f"{name}-labels")
        if after.where("label <> was").isEmpty():
            break
        current = after.select("id", "label")
    return labels.join(after.select("id", F.col("label").alias("low")), "id", "left").select("id", F.coalesce("low", "label").alias("label"))


def joined(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    return _placed_rows(docs).drop("digest")


def _placed_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, digest) of every row; rows linked with nothing have no digest."""
    plain = docs.select("doc_id", "text")
    known = stored(indexed(plain, frequent_tokens(plain)), "jaccard-index")
    usable = known.where("n > 0 and doc_id is not null")
    # Exact copies are one class with its smallest id; classes are numbered once and written down.
    smallest = usable.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    chosen = usable.join(smallest, ["digest", "doc_id"], "left_semi")
    once = chosen.groupBy("digest").agg(*(F.first(c).alias(c) for c in ("doc_id", "n", "rare_keys", "pair_keys", "common", "bits")))
    classes = stored(once.withColumn("node", F.monotonically_increasing_id()), "jaccard-classes")
    labels = components(classes.select(F.col("node").alias("id")), _links(plain, classes), "jaccard")
    placed = classes.select("node", "digest", "doc_id").join(labels.withColumnRenamed("id", "node"), "node")
    smallest = placed.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    found = placed.join(smallest, "label").select("digest", "component_id")
    rows = known.select("doc_id", "n", F.when(F.expr("n > 0 and doc_id is not null"), F.col("digest")).alias("digest"))
    linked = rows.where("digest is not null").join(found, "digest").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "digest")
    alone = rows.where("digest is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "digest")
    return linked.unionByName(alone)


def _with_digest(docs: DataFrame) -> DataFrame:
    names = [*docs.columns, "_digest"]

    def run(batches):
        tokens = Tokens()
        for batch in batches:
            for part, texts in pieces(batch):
                digests = pa.array([_digest(s) for s in tokens.of(texts)], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, digests], names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("_digest", T.BinaryType())]))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents whose id is the smallest of their component.

    Where an id has several texts and only some of them go, its rows are told apart by their token sets.
    """
    rows = stored(_placed_rows(docs).select("doc_id", "digest", F.expr("component_id <> doc_id").alias("goes")), "jaccard-rows")
    ids = rows.groupBy("doc_id").agg(F.bool_or("goes").alias("some"), F.bool_and("goes").alias("all"))
    hit = stored(ids.where("some"), "jaccard-gone")
    kept = docs.join(hit.select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    mixed = hit.where("not all").select("doc_id")
    if mixed.isEmpty():
        return kept
    gone = rows.where("goes").join(mixed, "doc_id", "left_semi").select("doc_id", F.col("digest").alias("_digest")).distinct()
    told = _with_digest(docs.join(mixed, "doc_id", "left_semi").select(*docs.columns))
    return kept.unionByName(told.join(gone, ["doc_id", "_digest"], "left_anti").select(*docs.columns))
