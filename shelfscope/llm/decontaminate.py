"""Benchmark decontamination by greedy string tiling.

Every window of ``SEED`` words of a benchmark item is a seed. A document that holds a seed is tiled against the item: the
longest common run of unmarked words is found by running Karp-Rabin (rolling hashes of a search length that is
halved as runs get rarer), all runs of that length are marked without overlap, and so on down to ``SEED`` words. The share of the item's
words under tiles is its coverage; since tiles may lie in any order, a passage whose sentences were shuffled is
covered as well as a straight copy. A document is contaminated when the coverage of some item reaches ``COVERAGE``.

Items meet the documents in blocks of bounded size (``BLOCK_CHARS``), one narrow pass over the documents for each, so
neither side is shuffled. An item of fewer than ``SEED`` words is its own seed and matches where all of it occurs in a row.
In scripts that set no spaces between words, each character is a word. Items without a word never match. NULL and empty
texts are clean. Repeated rows give repeated results; ties go to the smallest item_id. Other columns are kept and not read.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscope.llm.common import WordTable, batch_of, out_schema, over_texts, split_all

SEED = 5
COVERAGE = 0.5
BLOCK_CHARS = 16 << 20  # benchmark text sent to the tasks at a time
# Ranges of scripts without spaces between words (kana, Han, Thai to Lao, Myanmar, Khmer).
_UNSPACED = "\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff"
_WORD = re.compile(rf"[{_UNSPACED}]|[^\W{_UNSPACED}]+")
_BASE = 0x9E3779B97F4A7C15


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _windows(codes: np.ndarray, size: int) -> np.ndarray:
    """Rolling hash of every window of ``size`` codes."""
    n = max(0, len(codes) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(_BASE) + codes[k : k + n]
    return out


def tiles(pattern: list, text: list, shortest: int = SEED) -> list[tuple[int, int, int]]:
    """(start in pattern, start in text, length) of greedy tiles, longest first; equal lengths in order of the pattern."""
    marked_p, marked_t = [False] * len(pattern), [False] * len(text)
    found: list[tuple[int, int, int]] = []
    search = max(shortest, min(20, len(pattern)))
    while True:
        runs = _longest_runs(pattern, text, marked_p, marked_t, search)
        if runs and runs[0][2] > 2 * search:
            search = runs[0][2]  # far longer than looked for: look for that length first
            continue
        for p, t, length in runs:
            while length and (any(marked_p[p : p + length]) or any(marked_t[t : t + length])):
                length -= 1  # an earlier tile took its end
            if length < search:
                continue
            marked_p[p : p + length] = [True] * length
            marked_t[t : t + length] = [True] * length
            found.append((p, t, length))
        if search == shortest:
            # What was cut short by longer tiles may still hold runs of the shortest length.
            if not runs:
                return found
            continue
        search = max(shortest, search // 2)


def _longest_runs(pattern: list, text: list, marked_p: list, marked_t: list, size: int) -> list[tuple[int, int, int]]:
    """Maximal common runs of at least ``size`` unmarked words, longest first, by hashes of windows of that size."""
    places: dict[tuple, list[int]] = {}
    for t in _open_windows(marked_t, size):
        places.setdefault(tuple(text[t : t + size]), []).append(t)
    runs = []
    for p in _open_windows(marked_p, size):
        for t in places.get(tuple(pattern[p : p + size]), ()):
            if p and t and not marked_p[p - 1] and not marked_t[t - 1] and pattern[p - 1] == text[t - 1]:
                continue  # part of a run that began before
            length = size
            while (p + length < len(pattern) and t + length < len(text) and pattern[p + length] == text[t + length]
                   and not marked_p[p + length] and not marked_t[t + length]):
                length += 1
            runs.append((p, t, length))
    return sorted(runs, key=lambda r: (-r[2], r[0], r[1]))


def _open_windows(marked: list, size: int):
    """Starts of windows without a marked word."""
    run = 0
    for i, taken in enumerate(marked):
        run = 0 if taken else run + 1
        if run >= size:
            yield i - size + 1


class _Block:
    """Benchmark items of one block, with their seeds in sorted order."""

    def __init__(self, items: list[tuple], seed: int):
        self.seed, self.names = seed, [i for i, _ in items]
        self.codes = WordTable(lambda words: np.zeros(len(words)), limit=1 << 62)
        self.items = [self._codes(words_of(text)) for _, text in items]
        # Short items by their number of words: hash of the whole item, and the item.
        self.short: dict[int, list[tuple[int, int]]] = {}
        for i, codes in enumerate(self.items):
            if 0 < len(codes) < seed:
                self.short.setdefault(len(codes), []).append((int(_windows(codes, len(codes))[0]), i))
        hashes = [np.unique(_windows(c, seed)) for c in self.items]
        owner = np.repeat(np.arange(len(items)), [len(h) for h in hashes])
        seeds = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        by = np.argsort(seeds, kind="stable")
        self.seeds, self.owner = seeds[by], owner[by]

    def _codes(self, words: list[str]) -> np.ndarray:
        return (self.codes.numbers(words) + 1).astype(np.uint64)

    def document(self, codes: np.ndarray, hashes: np.ndarray, at: np.ndarray) -> list[tuple[int, float, int]]:
        """(item, coverage, tiles) for every item a document shares a seed with; at: places of the shared seeds."""
        low, high = np.searchsorted(self.seeds, hashes[at], "left"), np.searchsorted(self.seeds, hashes[at], "right")
        hits: dict[int, list[int]] = {}
        for place, a, b in zip(at.tolist(), low.tolist(), high.tolist()):
            for i in self.owner[a:b].tolist():
                hits.setdefault(i, []).append(place)
        out = []
        for i, places in hits.items():
            # Common runs lie within chains of shared seeds; a break (None) stands between chains.
            text: list = []
            end = -1
            for place in places:
                if place > end:
                    text.append(None)
                    end = place
                text += codes[end : place + self.seed].tolist()
                end = place + self.seed
            pattern = self.items[i].tolist()
            found = tiles(pattern, text, self.seed)
            out.append((i, sum(n for _, _, n in found) / len(pattern), len(found)))
        return out


    def whole_items(self, codes: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int]]:
        """(document, item) where all words of a short item stand in a row."""
        out = set()
        for size, items in self.short.items():
            hashes = _windows(codes, size)
            wanted = np.sort(np.array([h for h, _ in items], np.uint64))
            near = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
            by_hash: dict[int, list[int]] = {}
            for h, i in items:
                by_hash.setdefault(h, []).append(i)
            for place in np.flatnonzero(wanted[near] == hashes).tolist():
                doc = int(np.searchsorted(bounds, place, "right")) - 1
                if place + size <= bounds[doc + 1]:
                    found = codes[place : place + size]
                    out.update((doc, i) for i in by_hash[int(hashes[place])] if (self.items[i] == found).all())
        return sorted(out)


def _blocks(benchmark: DataFrame, block_chars: int) -> list[DataFrame]:
    """The benchmark in parts of bounded text."""
    usable = benchmark.where("item_id is not null and text is not null").select("item_id", "text")
    total = usable.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    number = -(-total // block_chars)
    if number <= 1:
        return [usable]
    part = F.pmod(F.xxhash64("item_id"), F.lit(number))
    return [usable.where(part == i) for i in range(number)]


def matches(docs: DataFrame, benchmark: DataFrame, seed: int = SEED, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, coverage, n_tiles) for every document and item that share a seed."""
    spark = docs.sparkSession
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    schema = out_schema(docs, f"item_id {item_type}, coverage double, n_tiles int")

    def one(block: DataFrame) -> DataFrame:
        sent = spark.sparkContext.broadcast(sorted((r["item_id"], r["text"]) for r in block.collect()))

        def make():
            known = _Block(sent.value, seed)
            get = known.codes.get

            def work(part: pa.RecordBatch, texts: list) -> pa.RecordBatch | None:
                words, bounds = split_all(texts, words_of)
                # A word no item has is 0; a window with one can only match by a hash collision, which tiling rejects.
                codes = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
                codes = (codes + 1).astype(np.uint64)
                hashes = _windows(codes, seed)
                shared = np.zeros(0, np.int64)
                if len(hashes) and len(known.seeds):
                    near = np.minimum(np.searchsorted(known.seeds, hashes), len(known.seeds) - 1)
                    shared = np.flatnonzero(known.seeds[near] == hashes)
                doc = np.searchsorted(bounds, shared, "right") - 1
                inside = shared + seed <= bounds[doc + 1]
                shared, doc = shared[inside], doc[inside]
                rows, items, coverage, count = [], [], [], []
                for d, item in known.whole_items(codes, bounds):
                    rows.append(d)
                    items.append(known.names[item])
                    coverage.append(1.0)
                    count.append(1)
                for d in np.unique(doc).tolist():
                    for item, share, n in known.document(codes, hashes, shared[doc == d]):
                        rows.append(d)
                        items.append(known.names[item])
                        coverage.append(share)
                        count.append(n)
                if not rows:
                    return None
                return batch_of(part.column("doc_id").take(pa.array(rows)), item_id=pa.array(items),
                                coverage=pa.array(coverage, pa.float64()), n_tiles=pa.array(count, pa.int32()))

            return work

        return over_texts(docs, make, schema)

    return reduce(DataFrame.unionByName, [one(b) for b in _blocks(benchmark, block_chars)])


def contamination(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, contaminated, item_ids, best_item, best_coverage) of every document id that shares a seed with an item."""
    found = matches(docs, benchmark)
    best = F.min_by("item_id", F.struct(-F.col("coverage"), "item_id"))
    leaked = F.sort_array(F.collect_set(F.when(F.col("coverage") >= coverage, F.col("item_id"))))
    return found.groupBy("doc_id").agg(
        (F.max("coverage") >= coverage).alias("contaminated"), leaked.alias("item_ids"), best.alias("best_item"), F.max("coverage").alias("best_coverage")
    )


def clean_only(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Documents in which no item is covered to the threshold."""
    leaked = matches(docs, benchmark).where(F.col("coverage") >= coverage).select("doc_id").distinct()
    return docs.join(leaked, "doc_id", "left_anti").select(*docs.columns)
