"""Alignment of two tokenizations of the same text: groups of tokens that start and end together, and overlapping pairs.

A text is tokenized by a byte-level vocabulary (A) and by a piece vocabulary (B) over the same bytes, a space and the
text. Byte offsets at which tokens of both end cut the tokens into groups; a token of A and a token of B are linked where
their bytes overlap. Overlapping pairs are read off the union of all ends: every stretch between two neighbouring ends
lies in one token of each side.

A stretch of bytes yields a *fragment*: the open tokens up to the first common end, the closed groups, and the open tokens
after the last common end. Fragments of neighbouring stretches compose: what one leaves open and what the next one
begins with close a group, or go on being open. The composition is associative, so it may be bracketed as a tree.
Texts of more than ``PART_BYTES`` are cut into parts at spaces, parts go to different tasks, each yields a fragment per
``RANGE_BYTES`` of the text, wherever tokens lie, and rounds of grouped tasks compose ``FAN`` neighbours at a time. Within
shorter texts the units between such spaces are fragments without open tokens, computed once for many texts and added up.

A byte-level vocabulary that splits words first, and pieces that have the space at their start only, never join what stands
before a space (that follows no white space) with what comes after it; with other vocabularies whole texts are tokenized. A part without such a space is as long as it takes.

A pair of ids counts the documents that hold it linked. Pairs found in many documents, at most ``FREQUENT_PAIRS`` of them
since each accounts for a share of all, go to the tasks as one table; the rest are joined.

NULL and empty texts have no tokens, and neither has a text that one of the vocabularies does not give back byte for byte.
Repeated rows count as documents of their own. An empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer

from shelfscope.llm.common import out_schema, pieces, segment_sums, split_all, stored

BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
PART_BYTES = 64 << 10
RANGE_BYTES = 16 << 10
FAN = 8
FREQUENT_PAIRS = 500_000
KEPT_UNITS = 200_000
KEPT_CHARS = 16 << 20
SLICE_BYTES = 1 << 20  # of text that a task holds as units at a time
SLICE_PAIRS = 1 << 18
JOINED_UNITS = 50_000
SPACE = "▁"
# A space that follows no white space, with something after it.
_CUT = re.compile(rf"(?<=[^\s{SPACE}])(?= .)", re.DOTALL)
# Fixed value: how a byte-level vocabulary splits a text into words before it merges bytes.
WORD_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Beyond these, libraries may know another version of the character classes.
_BEYOND_LATIN = re.compile("[^\x00-\u024f\u2010-\u2027]")
# White space other than the space: before a space it keeps a text from being cut there.
_WHITE_BEFORE = [f"{c} " for c in map(chr, range(0x3001)) if c.isspace() or c == SPACE]
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class Vocabularies:
    """Both tokenizers, and the number of bytes of every id."""

    def __init__(self, byte_level: str = BYTE_LEVEL, piece_model: str = PIECES):
        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        entries = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        to_byte = {c: b for b, c in enumerate(_byte_characters())}
        self.a_bytes = [bytes(to_byte[c] for c in e) if all(c in to_byte for c in e) else b"" for e in entries]
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(n[3:5], 16)]) if self.b.is_byte(i) else n.replace(SPACE, " ").encode() for i, n in enumerate(names)]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in v], np.int64) for v in (self.a_bytes, self.b_bytes))
        self.n_b = len(names)
        # Ids as they stand in the text of a group, by what follows them.
        self.a_words, self.b_words = ([np.array([f"{i}{c}" for i in range(n)], object) for c in marks] for n, marks in ((len(entries), ",|"), (len(names), ",;")))
        model = json.loads(self.a.to_str())
        splitter = model.get("pre_tokenizer") or {}
        self.cuts_at_spaces = splitter.get("type") == "ByteLevel" and splitter.get("use_regex", False) and not any(SPACE in n.lstrip(SPACE) for n in names)
        self.ranked = self._by_rank(model["model"]) if self.cuts_at_spaces else None

    def _by_rank(self, model: dict):
        """The same encoding by ranks of tokens, several times as fast, if ids rise with the merges that make them."""
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = [model["vocab"].get("".join(m), -1) for m in merges]
        if made != list(range(256, 256 + len(made))) or len({*self.a_bytes[: 256 + len(made)]}) != 256 + len(made):
            return None
        ranks = {raw: i for i, raw in enumerate(self.a_bytes[: 256 + len(made)])}
        return tiktoken.Encoding("by_rank", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def units(self, text: str) -> list[str]:
        """A space and the text, cut where both tokenizers end a token; each unit stands for itself after a space."""
        whole = f" {text}"
        if not self.cuts_at_spaces:
            return [text]
        if whole[-1] == " " or any(w in whole for w in _WHITE_BEFORE):
            return [u[1:] for u in _CUT.split(whole)]
        return text.split(" ")

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A for all units in a row and how many each has, and the same of B (which puts the first space itself)."""
        a, a_counts = self._encode_a(units)
        b = self.b.encode(units, num_threads=1)
        return a, a_counts, np.array(list(chain.from_iterable(b)), np.int64), np.fromiter(map(len, b), np.int64, len(b))

    def _encode_a(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # Units that end in a visible character are read as one text: no token spans two of them.
        joined = np.fromiter((self.cuts_at_spaces and u != "" and not u[-1].isspace() for u in units), bool, len(units))
        latin = np.fromiter((self.ranked is not None and not _BEYOND_LATIN.search(u) for u in units), bool, len(units))
        order, flat, counts = [], [], []
        for numbers, read in ((np.flatnonzero(joined & latin), self._ranked_ids), (np.flatnonzero(joined & ~latin), self._ids)):
            for lo in range(0, len(numbers), JOINED_UNITS):
                some = numbers[lo : lo + JOINED_UNITS].tolist()
                ids = np.array(read(f" {' '.join([units[i] for i in some])}"), np.int64)
                sizes = np.fromiter((len(units[i].encode()) + 1 for i in some), np.int64, len(some))
                ends = np.searchsorted(np.cumsum(self.a_sizes[ids]), np.cumsum(sizes)) + 1
                order += some
                flat.append(ids)
                counts.append(np.diff(ends, prepend=0))
        for i in np.flatnonzero(~joined).tolist():
            ids = np.array(self._ids(f" {units[i]}"), np.int64)
            order.append(i)
            flat.append(ids)
            counts.append(np.array([len(ids)]))
        if not order:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        flat, counts, place = np.concatenate(flat), np.concatenate(counts), np.argsort(np.array(order))
        return flat[_spans((np.cumsum(counts) - counts)[place], counts[place])], counts[place]

    def _ids(self, text: str) -> list[int]:
        return self.a.encode(text, add_special_tokens=False).ids

    def _ranked_ids(self, text: str) -> list[int]:
        return self.ranked.encode_ordinary(text)

    def gives_back(self, units: list[str], a: np.ndarray, a_counts: np.ndarray, b: np.ndarray, b_counts: np.ndarray) -> np.ndarray:
        """For each unit, whether both sides' bytes are a space and the unit."""
        sides = [(t, ids, np.concatenate([[0], np.cumsum(n)])) for t, ids, n in ((self.a_bytes, a, a_counts), (self.b_bytes, b, b_counts))]
        raw = [f" {u}".encode() for u in units]
        good = np.ones(len(units), bool)
        for table, ids, bounds in sides:
            given = [table[t] for t in ids.tolist()]
            sizes = segment_sums(np.fromiter(map(len, given), np.int64, len(given)), bounds)
            if b"".join(given) != b"".join(raw) or (sizes != np.fromiter(map(len, raw), np.int64, len(raw))).any():
                good &= np.array([b"".join(given[lo:hi]) == r for lo, hi, r in zip(bounds[:-1].tolist(), bounds[1:].tolist(), raw, strict=True)], bool)
        return good


def _spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Consecutive numbers from each start on, in a row."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def _common_and_all(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values in both of two rising arrays, and values in either."""
    merged = np.sort(np.concatenate([x, y]), kind="stable")  # two runs: a merge
    again = np.zeros(len(merged), bool)
    again[1:] = merged[1:] == merged[:-1]
    return merged[again], merged[~again]


def _byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, the others from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


_LOADED: dict[tuple[str, str], Vocabularies] = {}


def _loaded(paths: tuple[str, str]) -> Vocabularies:
    if paths not in _LOADED:
        _LOADED[paths] = Vocabularies(*paths)
    return _LOADED[paths]


def _group_text(a: list[int], b: list[int]) -> str:
    return f"{','.join(map(str, a))}|{','.join(map(str, b))}"


@dataclass
class Open:
    """Tokens of both sides in order, with the byte offset at which each ends."""

    a: list[int] = field(default_factory=list)
    a_ends: list[int] = field(default_factory=list)
    b: list[int] = field(default_factory=list)
    b_ends: list[int] = field(default_factory=list)

    def __add__(self, other: Open) -> Open:
        return Open(self.a + other.a, self.a_ends + other.a_ends, self.b + other.b, self.b_ends + other.b_ends)

    def cut(self, a_from: int, a_to: int, b_from: int, b_to: int) -> Open:
        return Open(self.a[a_from:a_to], self.a_ends[a_from:a_to], self.b[b_from:b_to], self.b_ends[b_from:b_to])


@dataclass
class Closed:
    """What is kept of closed groups."""

    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    text: list[str] = field(default_factory=list)
    pairs: list[np.ndarray] = field(default_factory=list)  # codes of linked pairs, each occurrence

    def __add__(self, other: Closed) -> Closed:
        return Closed(
            self.n_a + other.n_a, self.n_b + other.n_b, self.n_groups + other.n_groups, self.n_links + other.n_links,
            self.text + other.text, self.pairs + other.pairs,
        )


@dataclass
class Fragment:
    """Open tokens before the first common end, closed groups, open tokens after the last; without a common end all is open."""

    prefix: Open
    closed: Closed | None
    suffix: Open

    def then(self, after: Fragment, n_b: int) -> Fragment:
        if self.closed is None:
            return Fragment(self.prefix + after.prefix, after.closed, after.suffix)
        if after.closed is None:
            return Fragment(self.prefix, self.closed, self.suffix + after.prefix)
        between = closed_groups(self.suffix + after.prefix, n_b)
        return Fragment(self.prefix, self.closed + between + after.closed, after.suffix)


def closed_groups(tokens: Open, n_b: int) -> Closed:
    """Groups and links of tokens that start and end together."""
    if not tokens.a:
        return Closed()
    a_ends, b_ends = np.array(tokens.a_ends, np.int64), np.array(tokens.b_ends, np.int64)
    common, ends = _common_and_all(a_ends, b_ends)
    codes = np.array(tokens.a, np.int64)[np.searchsorted(a_ends, ends)] * n_b + np.array(tokens.b, np.int64)[np.searchsorted(b_ends, ends)]
    text, i, j = [], 0, 0
    for x, y in zip(np.searchsorted(a_ends, common) + 1, np.searchsorted(b_ends, common) + 1, strict=True):
        text.append(_group_text(tokens.a[i:x], tokens.b[j:y]))
        i, j = x, y
    return Closed(len(tokens.a), len(tokens.b), len(common), len(ends), text, [codes])


def fragment(tokens: Open, n_b: int) -> Fragment:
    """The fragment of a stretch from the tokens that end in it."""
    a_ends, b_ends = np.array(tokens.a_ends, np.int64), np.array(tokens.b_ends, np.int64)
    common, _ = _common_and_all(a_ends, b_ends)
    if not len(common):
        return Fragment(tokens, None, Open())
    (a0, a1), (b0, b1) = (np.searchsorted(e, common[[0, -1]]) + 1 for e in (a_ends, b_ends))
    return Fragment(tokens.cut(0, a0, 0, b0), closed_groups(tokens.cut(a0, a1, b0, b1), n_b), tokens.cut(a1, None, b1, None))


class UnitTable(dict):
    """Numbers units of text; keeps counts, the text of the groups and the linked pairs of each, computed many at a time."""

    def __init__(self, vocabularies: Vocabularies):
        super().__init__()
        self.vocabularies, self.new = vocabularies, []
        self._empty()

    def _empty(self) -> None:
        self.clear()
        self.chars, self.text, self.counts = 0, [], np.zeros((0, 4), np.int64)
        self.good, self.starts, self.codes = np.zeros(0, bool), np.zeros(1, np.int64), np.zeros(0, np.int64)

    def __missing__(self, unit: str) -> int:
        number = self[unit] = len(self)
        self.new.append(unit)
        return number

    def numbers(self, units: list[str]) -> np.ndarray:
        if len(self) > KEPT_UNITS or self.chars > KEPT_CHARS:
            self._empty()
        numbers = np.fromiter(map(self.__getitem__, units), np.int64, len(units))
        if self.new:
            self._compute(self.new)
            self.new = []
        return numbers

    def _compute(self, units: list[str]) -> None:
        v = self.vocabularies
        a, n_a, b, n_b = v.encode(units)
        good = v.gives_back(units, a, n_a, b, n_b)
        if not good.all():
            a, b, n_a, n_b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)], n_a * good, n_b * good
        a_ends, b_ends = np.cumsum(v.a_sizes[a]), np.cumsum(v.b_sizes[b])
        bounds = np.concatenate([[0], a_ends])[np.cumsum(n_a)]  # a unit's last byte, the same for both sides
        common, ends = _common_and_all(a_ends, b_ends)
        codes = a[np.searchsorted(a_ends, ends)] * v.n_b + b[np.searchsorted(b_ends, ends)] if len(ends) else ends
        n_groups, n_links = (np.diff(np.searchsorted(e, bounds, "right"), prepend=0) for e in (common, ends))
        self.text += _group_texts(v, a, b, np.searchsorted(a_ends, common) + 1, np.searchsorted(b_ends, common) + 1, n_a + n_b)
        self.counts = np.concatenate([self.counts, np.stack([n_a, n_b, n_groups, n_links], 1)])
        self.good = np.concatenate([self.good, good])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(n_links)])
        self.codes = np.concatenate([self.codes, codes])
        self.chars += sum(map(len, units))


def _group_texts(v: Vocabularies, a: np.ndarray, b: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray, sizes: np.ndarray) -> list[str]:
    """Texts of the groups that end at the cuts, joined for each stretch of so many tokens (of both sides)."""
    a_group, b_group = (np.repeat(np.arange(len(c)), np.diff(c, prepend=0)) for c in (a_cuts, b_cuts))
    b_before = np.concatenate([[0], b_cuts]).astype(np.int64)
    words = np.empty(len(a) + len(b), object)
    # A token's place: those of its own side before it, and the other side's of earlier groups (for B, of its own too).
    words[np.arange(len(a)) + b_before[a_group]] = v.a_words[0][a]
    words[np.arange(len(b)) + a_cuts[b_group]] = v.b_words[0][b]
    words[a_cuts - 1 + b_before[:-1]] = v.a_words[1][a[a_cuts - 1]]
    words[a_cuts + b_cuts - 1] = v.b_words[1][b[b_cuts - 1]]
    ends, words = np.cumsum(sizes).tolist(), words.tolist()
    return ["".join(words[lo:hi])[:-1] for lo, hi in zip([0, *ends[:-1]], ends, strict=True)]


_TABLES: dict[tuple[str, str], UnitTable] = {}


def _unit_table(paths: tuple[str, str]) -> UnitTable:
    """Kept by a Python worker from task to task."""
    if paths not in _TABLES:
        _TABLES[paths] = UnitTable(_loaded(paths))
    return _TABLES[paths]


def _distinct(owners: np.ndarray, codes: np.ndarray, n_owners: int, span: int) -> tuple[pa.Array, pa.Array]:
    """Lists of the distinct codes of each owner, and how often each occurs."""
    keys, times = np.unique(owners * span + codes, return_counts=True)
    offsets = pa.array(np.searchsorted(keys, np.arange(n_owners + 1) * span).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(keys % span)), pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32)))


def _hashed(text: str, tokens: int) -> str:
    return hashlib.sha256(text.encode()).hexdigest() if tokens else ""


_ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"


def _aligned_schema(doc_id: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("row", T.LongType()), T.StructField("doc_id", doc_id), *T.StructType.fromDDL(_ALIGNED).fields])


def _short(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Rows of ``_ALIGNED`` for texts that one task aligns whole; ``row`` numbers them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, row = _unit_table(paths), TaskContext.get().partitionId() << 33
        v = table.vocabularies
        for batch in batches:
            for part, texts in pieces(batch, size=SLICE_BYTES):
                units, bounds = split_all(texts, v.units)
                numbers = table.numbers(units)
                whole = segment_sums(~table.good[numbers], bounds) == 0
                counts = segment_sums(table.counts[numbers], bounds).astype(np.int64) * whole[:, None]
                strings, order = table.text, numbers.tolist()
                hashes = [
                    _hashed(";".join([strings[n] for n in order[lo:hi]]), ok and hi > lo)
                    for lo, hi, ok in zip(bounds[:-1].tolist(), bounds[1:].tolist(), whole.tolist(), strict=True)
                ]
                numbers = numbers[np.repeat(whole, np.diff(bounds))]
                owners = np.repeat(np.arange(len(texts)), np.diff(bounds) * whole)
                n = table.counts[numbers, 3]
                pairs, times = _distinct(np.repeat(owners, n), table.codes[_spans(table.starts[numbers], n)], len(texts), len(v.a_sizes) * v.n_b)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + len(texts))), part.column("doc_id"), *(pa.array(c) for c in counts.T), pa.array(hashes, pa.string()), pairs, times],
                    ["row", "doc_id", *_COUNTS, "groups_sha256", "pairs", "times"],
                )
                row += len(texts)

    return docs.select("doc_id", "text").mapInArrow(run, _aligned_schema(docs.schema["doc_id"].dataType))


def _parts(docs: DataFrame, paths: tuple[str, str], part_bytes: int) -> DataFrame:
    """(row, doc_id, start, part): long texts in parts of about ``part_bytes``, cut at units; ``row`` below zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, row = _loaded(paths), -(TaskContext.get().partitionId() << 33) - 1
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                starts, parts, at, held, size = [], [], 0, [], 0
                for unit in v.units(text.as_py()):
                    held.append(unit)
                    size += len(unit.encode()) + 1
                    if size >= part_bytes:
                        starts.append(at)
                        parts.append(" ".join(held))
                        at, held, size = at + size, [], 0
                if held:
                    starts.append(at)
                    parts.append(" ".join(held))
                n = len(parts)
                yield pa.RecordBatch.from_arrays([pa.array([row] * n), pa.array([doc_id.as_py()] * n, doc_id.type), pa.array(starts, pa.int64()), pa.array(parts)], ["row", "doc_id", "start", "part"])
                row -= 1

    schema = T.StructType([T.StructField("row", T.LongType()), *out_schema(docs, "start long, part string").fields])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


_OPEN = "struct<a: array<int>, a_ends: array<long>, b: array<int>, b_ends: array<long>>"
_FRAGMENT = f"start long, good boolean, common boolean, prefix {_OPEN}, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<int>, suffix {_OPEN}"


def _fragment_schema(doc_id: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("row", T.LongType()), T.StructField("doc_id", doc_id), *T.StructType.fromDDL(_FRAGMENT).fields])


def _counted(closed: Closed) -> tuple[list[int], list[int]]:
    codes, times = np.unique(np.concatenate(closed.pairs), return_counts=True) if closed.pairs else (np.zeros(0, np.int64),) * 2
    return codes.tolist(), times.tolist()


def _to_row(row: int, doc_id, start: int, good: bool, f: Fragment) -> dict:
    c = f.closed or Closed()
    pairs, times = _counted(c)
    return {
        "row": row, "doc_id": doc_id, "start": start, "good": good, "common": f.closed is not None, "prefix": vars(f.prefix), "n_a": c.n_a, "n_b": c.n_b,
        "n_groups": c.n_groups, "n_links": c.n_links, "groups": ";".join(c.text), "pairs": pairs, "times": times, "suffix": vars(f.suffix),
    }


def _whole_row(row: int, doc_id, good: bool, f: Fragment, n_b: int) -> dict:
    """A text ends with a common end, so what it starts with closes and nothing is left open."""
    c = closed_groups(f.prefix, n_b) + (f.closed or Closed()) if good else Closed()
    pairs, times = _counted(c)
    return {
        "row": row, "doc_id": doc_id, "n_a": c.n_a, "n_b": c.n_b, "n_groups": c.n_groups, "n_links": c.n_links,
        "groups_sha256": _hashed(";".join(c.text), c.n_a), "pairs": pairs, "times": times,
    }


def _of_row(r: dict) -> Fragment:
    if not r["common"]:
        return Fragment(Open(**r["prefix"]), None, Open())
    codes = np.repeat(np.array(r["pairs"], np.int64), np.array(r["times"], np.int64))
    closed = Closed(r["n_a"], r["n_b"], r["n_groups"], r["n_links"], [r["groups"]] if r["groups"] else [], [codes])
    return Fragment(Open(**r["prefix"]), closed, Open(**r["suffix"]))


def _fragments(parts: DataFrame, paths: tuple[str, str], range_bytes: int) -> DataFrame:
    """One fragment for each range of ``range_bytes`` that tokens of a part end in."""
    schema = _fragment_schema(parts.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _loaded(paths)
        arrow = None
        for batch in batches:
            for r in batch.to_pylist():
                a, n_a, b, n_b = v.encode(units := v.units(r["part"]))
                good = bool(v.gives_back(units, a, n_a, b, n_b).all())
                a, b = (a, b) if good else (a[:0], b[:0])
                a_ends, b_ends = (r["start"] + np.cumsum(sizes[ids]) for sizes, ids in ((v.a_sizes, a), (v.b_sizes, b)))
                tokens = Open(a.tolist(), a_ends.tolist(), b.tolist(), b_ends.tolist())
                size = int(a_ends[-1]) - r["start"] if len(a) else 1
                bounds = np.arange(r["start"] // range_bytes, (r["start"] + size - 1) // range_bytes + 2) * range_bytes
                i, j = np.searchsorted(a_ends, bounds, "right"), np.searchsorted(b_ends, bounds, "right")
                out = [
                    _to_row(r["row"], r["doc_id"], max(int(bounds[k]), r["start"]), good, fragment(tokens.cut(i[k], i[k + 1], j[k], j[k + 1]), v.n_b))
                    for k in range(len(bounds) - 1)
                ]
                arrow = arrow or pa.schema([(f.name, t) for f, t in zip(schema, _arrow_types(schema), strict=True)])
                yield pa.RecordBatch.from_pylist(out, arrow)

    return parts.repartition("row", "start").mapInArrow(run, schema)


def _arrow_types(schema: T.StructType) -> list[pa.DataType]:
    return [to_arrow_type(f.dataType) for f in schema]


def _composed(fragments: DataFrame, n_b: int, width: int, last: bool) -> DataFrame:
    """Neighbouring fragments whose starts share a stretch of ``width`` bytes as one; the last round closes whole texts."""
    doc_id = fragments.schema["doc_id"].dataType
    schema = _aligned_schema(doc_id) if last else _fragment_schema(doc_id)

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["start"])
        whole = _of_row(rows[0])
        for r in rows[1:]:
            whole = whole.then(_of_row(r), n_b)
        row, doc_id, good = rows[0]["row"], rows[0]["doc_id"], all(r["good"] for r in rows)
        out = _whole_row(row, doc_id, good, whole, n_b) if last else _to_row(row, doc_id, rows[0]["start"], good, whole)
        return pa.Table.from_pylist([out], pa.schema([(f.name, t) for f, t in zip(schema, _arrow_types(schema), strict=True)]))

    return fragments.groupBy("row", F.floor(F.col("start") / width)).applyInArrow(run, schema)


def _long(docs: DataFrame, paths: tuple[str, str], part_bytes: int, range_bytes: int) -> DataFrame:
    """Rows of ``_ALIGNED`` for long texts, by composing fragments in rounds of tasks."""
    parts = stored(_parts(docs, paths, part_bytes), "parts")
    longest, n_b = parts.agg(F.max("start")).first()[0] or 0, _loaded(paths).n_b
    whole, width = _fragments(parts, paths, range_bytes), range_bytes
    # The last round works in the task that composes: a second Python worker beside it would keep memory of its own.
    last = False
    while not last:
        width *= FAN
        last = width > longest
        whole = _composed(whole, n_b, width, last)
    return whole


def aligned(
    docs: DataFrame, paths: tuple[str, str] = (BYTE_LEVEL, PIECES), part_bytes: int = PART_BYTES, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times), stored; ``pairs`` are a * |B| + b."""
    long = F.coalesce(F.octet_length("text") > part_bytes, F.lit(False))
    rows = docs.select("doc_id", "text")
    return stored(_short(rows.where(~long), paths).unionByName(_long(rows.where(long), paths, part_bytes, range_bytes)), "aligned")


def pair_documents(rows: DataFrame, n_b: int) -> DataFrame:
    """(pair, n, best), stored: documents that hold each linked pair, and whether no other pair of its A id has more."""
    counts = stored(rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pair-counts")
    # An A id has at most as many pairs as B has ids.
    highest = counts.groupBy(F.expr(f"pair div {n_b}").alias("a")).agg(F.max("n").alias("highest"))
    marked = counts.withColumn("a", F.expr(f"pair div {n_b}")).join(highest, "a")
    return stored(marked.select("pair", "n", (F.col("n") == F.col("highest")).alias("best")), "pair-documents")


def alignment(
    docs: DataFrame,
    paths: tuple[str, str] = (BYTE_LEVEL, PIECES),
    part_bytes: int = PART_BYTES,
    range_bytes: int = RANGE_BYTES,
    frequent_pairs: int = FREQUENT_PAIRS,
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row of ``docs``."""
    rows = aligned(docs, paths, part_bytes, range_bytes)
    counts = pair_documents(rows, _loaded(paths).n_b)
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # Each of these stands in total / frequent_pairs documents or more, so there are frequent_pairs at most.
    frequent = counts.where(F.col("n") * frequent_pairs >= total).orderBy("pair").toArrow()
    codes, n, best = (frequent.column(c).to_numpy() for c in ("pair", "n", "best"))
    plain = ("row", "doc_id", *_COUNTS, "groups_sha256")
    schema = T.StructType([*(rows.schema[c] for c in plain), *T.StructType.fromDDL("n_best long, count_sum long").fields])
    found = rows.mapInArrow(_frequent_sums(codes, n, best, plain), schema)
    rare = counts.where(F.col("n") * frequent_pairs < total)
    if not rare.isEmpty():
        loose = rows.select("row", "pairs", "times").mapInArrow(_rare_pairs(codes), "row long, pair long, times int")
        sums = loose.join(rare, "pair").groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum")
        )
        found = found.join(sums, "row", "left").withColumns(
            {a: F.col(a) + F.coalesce(b, F.lit(0)) for a, b in (("n_best", "more_best"), ("count_sum", "more_sum"))}
        )
    return found.select("doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256")


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Stretches of a batch with about SLICE_PAIRS pairs each."""
    ends = np.cumsum(np.diff(batch.column("pairs").offsets.to_numpy()))
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + SLICE_PAIRS, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    pairs, times = batch.column("pairs"), batch.column("times")
    sizes = np.diff(pairs.offsets.to_numpy())
    return np.repeat(np.arange(batch.num_rows), sizes), pairs.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)


def _place(codes: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(codes, pairs), max(len(codes) - 1, 0))
    return at, codes[at] == pairs if len(codes) else np.zeros(len(pairs), bool)


def _frequent_sums(codes: np.ndarray, n: np.ndarray, best: np.ndarray, plain: tuple[str, ...]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _TABLES.clear()  # the units that this worker kept are done with
        for batch in chain.from_iterable(map(_slices, batches)):
            owners, pairs, times = _flat(batch)
            at, hit = _place(codes, pairs)
            owners, at, times = owners[hit], at[hit], times[hit]
            sums = []
            for worth in (best.astype(np.int64), n):
                ends = np.concatenate([[0], np.cumsum(worth[at] * times)])
                bounds = np.searchsorted(owners, np.arange(batch.num_rows + 1))
                sums.append(pa.array(np.diff(ends[bounds])))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in plain), *sums], [*plain, "n_best", "count_sum"])

    return run


def _rare_pairs(codes: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _TABLES.clear()
        for batch in chain.from_iterable(map(_slices, batches)):
            owners, pairs, times = _flat(batch)
            rare = ~_place(codes, pairs)[1]
            rows = batch.column("row").to_numpy()[owners[rare]]
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(pairs[rare]), pa.array(times[rare].astype(np.int32))], ["row", "pair", "times"])

    return run
