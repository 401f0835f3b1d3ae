"""Encoding and decoding with a given piece vocabulary, by suffix-array matching.

The distinct words of a batch are laid end to end, their suffixes sorted, and every piece of the vocabulary looked up in the
suffix array by binary search: the range it finds holds all places where the piece occurs. These occurrences are edges
from one character position to another; sorted by position they are relaxed from left to right.

The vocabulary holds merge pieces with a rank each, so relaxing keeps an edge only if it may follow the edge that
ends where it starts: a sequence is the merge encoding of its text exactly when every piece in it is one and every two
neighbours would not merge across their border. For each position one last piece is kept, which makes relaxing linear in the edges.

Characters outside the vocabulary become byte pieces; a vocabulary without them gives its unknown piece. Words
are cut before every run of spaces, which is allowed because no piece holds a space after another character (checked
when the vocabulary is read). NULL texts have no ids and decode to NULL; empty texts have none and decode to
empty texts. Repeated rows give repeated results. Only doc_id and text of the documents are read.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from shelfscope.llm.common import WordTable, batch_of, out_schema, over_texts, split_all, worker_table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
WORDS_AT_ONCE = 40_000  # distinct words whose suffixes are sorted together
SLICE_BYTES = 1 << 20  # text encoded at a time: its words are held as strings
KEPT_PAIRS = 2_000_000  # pairs of neighbours whose answer a task keeps


@dataclass
class PieceVocabulary:
    """Pieces by id, and the rank by which two neighbours merge (smaller first)."""

    pieces: list[str]
    rank: dict[str, int]  # of ordinary pieces
    ids: dict[str, int]
    byte_ids: list[int] | None
    unknown: int
    longest: int

    @classmethod
    def read(cls, model: bytes) -> PieceVocabulary:
        source = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = source.get_piece_size()
        pieces = [source.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (source.is_byte(i) or source.is_control(i) or source.is_unknown(i) or source.is_unused(i))]
        for i in plain:
            if SPACE in pieces[i].lstrip(SPACE):
                raise ValueError(f"piece {i} holds a space after another character: words cannot be encoded apart")
        order = sorted(plain, key=lambda i: -source.get_score(i))
        named = {pieces[i]: i for i in range(n) if source.is_byte(i)}
        byte_ids = [named.get(f"<0x{b:02X}>", -1) for b in range(256)]
        return cls(
            pieces, {pieces[i]: r for r, i in enumerate(order)}, {pieces[i]: i for i in plain},
            byte_ids if min(byte_ids) >= 0 else None, source.unk_id(), max(len(pieces[i]) for i in plain),
        )

    def merged(self, symbols: list[str]) -> list[str]:
        """Merge the best-ranked neighbours, leftmost first, until none are left."""
        while len(symbols) > 1:
            ranks = [self.rank.get(a + b, 1 << 60) for a, b in zip(symbols, symbols[1:])]
            best = min(ranks)
            if best == 1 << 60:
                break
            at = ranks.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def apart(self, left: str, right: str) -> bool:
        """Whether the two pieces stay apart when their joint text is merged from its characters."""
        return self.merged(list(left + right)) == [left, right]


def occurrences(text: str, low_keys: np.ndarray, high_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, piece number) of every occurrence of every piece in the text.

    Suffixes are sorted by as many characters as the longest piece has; a piece's occurrences lie between the places
    where it and its largest continuation would be inserted.
    """
    longest = low_keys.dtype.itemsize // 4
    codes = np.frombuffer((text + "\0" * longest).encode("utf-32-le", "surrogatepass"), np.uint32)
    windows = np.lib.stride_tricks.sliding_window_view(codes, longest)[: len(text)]
    suffixes = np.ascontiguousarray(windows).view(low_keys.dtype).ravel()
    array = np.argsort(suffixes)
    ordered = suffixes[array]
    low, high = np.searchsorted(ordered, low_keys, "left"), np.searchsorted(ordered, high_keys, "left")
    found = high - low
    number = np.repeat(np.arange(len(low_keys)), found)
    place = np.arange(found.sum()) + np.repeat(low - np.cumsum(found) + found, found)
    return array[place], number


class WordEncoder:
    """Ids of distinct words, for many words at a time.

    A piece has a number below ``foreign``; a character outside the vocabulary is ``foreign`` plus its code.
    """

    def __init__(self, vocabulary: PieceVocabulary):
        self.vocabulary = vocabulary
        # Only pieces that are the encoding of their own text can occur in an encoding.
        self.searched = [p for p in vocabulary.rank if vocabulary.merged(list(p)) == [p]]
        self.foreign = len(self.searched)
        self.low = np.array(self.searched, f"<U{vocabulary.longest}")
        self.high = np.array([p + "\U0010ffff" for p in self.searched], f"<U{vocabulary.longest + 1}")
        self.lengths = np.fromiter(map(len, self.searched), np.int64, self.foreign)
        self.ids = np.fromiter((vocabulary.ids[p] for p in self.searched), np.int32, self.foreign)
        self.letters = np.array(sorted({ord(p) for p in self.searched if len(p) == 1}), np.uint32)
        self.breaks = all("\n" not in p for p in vocabulary.rank)
        self.pair_codes, self.pair_apart = np.zeros(0, np.int64), np.zeros(0, bool)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the number of ids of each word."""
        flat, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for at in range(0, len(words), WORDS_AT_ONCE):
            ids, counts = self._encode(words[at : at + WORDS_AT_ONCE])
            flat.append(ids)
            sizes.append(counts)
        return np.concatenate(flat), np.concatenate(sizes)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        begins = np.cumsum(lengths + 1) - lengths - 1
        text = "\0".join(words) + "\0"
        starts, numbers = occurrences(text, self.low, self.high)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        owner = np.repeat(np.arange(len(words)), lengths + 1)
        offset = np.arange(len(text)) - begins[owner]
        inside = offset < lengths[owner]
        strange = np.flatnonzero(inside & ~np.isin(codes, self.letters))
        starts = np.concatenate([starts, strange])
        numbers = np.concatenate([numbers, self.foreign + codes[strange].astype(np.int64)])
        sizes = np.concatenate([self.lengths[numbers[: len(numbers) - len(strange)]], np.ones(len(strange), np.int64)])
        kept = offset[starts] + sizes <= lengths[owner[starts]]  # a separator may be a character of a text
        starts, numbers, sizes = starts[kept], numbers[kept], sizes[kept]

        by = np.argsort(offset[starts], kind="stable")
        starts, numbers, sizes = starts[by], numbers[by], sizes[by]
        bounds = np.searchsorted(offset[starts], np.arange((lengths.max() if len(words) else 0) + 1))
        last = np.full(len(text) + 1, -1, np.int64)  # the piece that ends here in the encoding of the text before
        for step, (low, high) in enumerate(zip(bounds[:-1], bounds[1:])):
            at, number, size = starts[low:high], numbers[low:high], sizes[low:high]
            if step:
                before = last[at - 1]
                live = before >= 0
                at, number, size = at[live], number[live], size[live]
                live = self._apart(before[live], number)
                at, number, size = at[live], number[live], size[live]
            last[at + size - 1] = number

        # Walk back from the ends of all words at once.
        place, word = begins + lengths - 1, np.arange(len(words))
        word, place = word[lengths > 0], place[lengths > 0]
        found, of, turn = [], [], []
        while len(word):
            number = last[place]
            found.append(number)
            of.append(word)
            turn.append(np.full(len(word), -len(turn)))
            place = place - np.where(number < self.foreign, self.lengths[np.minimum(number, self.foreign - 1)], 1)
            more = place >= begins[word]
            word, place = word[more], place[more]
        if not found:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        number, of = np.concatenate(found), np.concatenate(of)
        by = np.lexsort((np.concatenate(turn), of))
        return self._ids(number[by], of[by], len(words))

    def _apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        out = np.ones(len(left), bool)
        plain = np.flatnonzero((left < self.foreign) & (right < self.foreign))
        codes = left[plain] * self.foreign + right[plain]
        distinct, back = np.unique(codes, return_inverse=True)
        at = np.minimum(np.searchsorted(self.pair_codes, distinct), max(0, len(self.pair_codes) - 1))
        known = self.pair_codes[at] == distinct if len(self.pair_codes) else np.zeros(len(distinct), bool)
        answer = np.zeros(len(distinct), bool)
        answer[known] = self.pair_apart[at[known]]
        fresh = np.flatnonzero(~known)
        if len(fresh):
            name = self.searched
            answer[fresh] = [self.vocabulary.apart(name[c // self.foreign], name[c % self.foreign]) for c in distinct[fresh].tolist()]
            if len(self.pair_codes) > KEPT_PAIRS:
                self.pair_codes, self.pair_apart = distinct, answer
            else:
                merged = np.concatenate([self.pair_codes, distinct[fresh]])
                by = np.argsort(merged)
                self.pair_codes, self.pair_apart = merged[by], np.concatenate([self.pair_apart, answer[fresh]])[by]
        out[plain] = answer[back]
        return out

    def _ids(self, number: np.ndarray, of: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        strange = number >= self.foreign
        if not strange.any():
            return self.ids[number], np.bincount(of, minlength=words)
        spelled = {int(n): self._spelled(chr(int(n) - self.foreign)) for n in np.unique(number[strange])}
        sizes = np.ones(len(number), np.int64)
        sizes[strange] = [len(spelled[n]) for n in number[strange].tolist()]
        out = np.repeat(self.ids[np.where(strange, 0, number)], sizes)
        out[np.repeat(strange, sizes)] = [i for n in number[strange].tolist() for i in spelled[n]]
        return out, np.bincount(np.repeat(of, sizes), minlength=words)

    def _spelled(self, character: str) -> list[int]:
        known = self.vocabulary.ids.get(character)
        if known is not None:
            return [known]
        if self.vocabulary.byte_ids is None:
            return [self.vocabulary.unknown]
        return [self.vocabulary.byte_ids[b] for b in character.encode("utf-8", "surrogatepass")]


# Distinct words whose ids a task keeps: idle workers hold them too, beside what the next stage of a pipeline needs.
KEPT_IDS = 400_000
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_WORD_OR_BREAK = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")


def words_of(text: str, breaks: bool = False) -> list[str]:
    """The text with its leading space mark and all spaces as marks, cut before every run of marks.

    breaks: also cut around line breaks, which is allowed when no piece holds one.
    """
    return (_WORD_OR_BREAK if breaks else _WORD).findall(SPACE + text.replace(" ", SPACE)) if text else []


def decoded(ids: list[int], vocabulary: PieceVocabulary, byte_of: dict[int, int]) -> str:
    """The text of ids: pieces in a row, byte pieces gathered to characters, the leading mark taken off."""
    out: list[str] = []
    held = bytearray()
    for i in ids:
        byte = byte_of.get(i)
        if byte is not None:
            held.append(byte)
            continue
        if held:
            out.append(held.decode("utf-8", "replace"))
            held.clear()
        out.append(vocabulary.pieces[i])
    if held:
        out.append(held.decode("utf-8", "replace"))
    return "".join(out).replace(SPACE, " ").removeprefix(" ")


def _model_bytes(docs: DataFrame, path: str) -> bytes:
    """The model file, read by Spark if Spark knows the path, so that any store works."""
    rows = docs.sparkSession.read.format("binaryFile").load(path).select("content").collect()
    return bytes(rows[0]["content"])


class _Ids(WordTable):
    """Word numbers with the ids of each word in one flat array."""

    def __init__(self, encoder: WordEncoder):
        super().__init__(self._spans, KEPT_IDS)
        self.encoder = encoder

    def _spans(self, words: list[str]) -> np.ndarray:
        fresh, sizes = self.encoder.encode(words)
        if self.values is None:
            self.flat = np.zeros(0, np.int32)
        ends = len(self.flat) + np.cumsum(sizes)
        self.flat = np.concatenate([self.flat, fresh])
        return np.stack([ends - sizes, sizes], 1)


def _encoding(sent, name: str):
    """Work on one piece: texts to lists of ids."""

    def make():
        known = worker_table(name, lambda: _Ids(WordEncoder(PieceVocabulary.read(sent.value))))
        breaks = known.encoder.breaks

        def work(texts: list) -> pa.ListArray:
            flat, bounds = split_all(texts, lambda text: words_of(text, breaks))
            numbers = known.numbers(flat)
            spans = known.values[numbers]
            at, sizes = spans[:, 0], spans[:, 1]
            ends = np.cumsum(sizes)
            ids = known.flat[np.repeat(at - ends + sizes, sizes) + np.arange(sizes.sum())]
            offsets = np.concatenate([[0], ends])[bounds].astype(np.int32)
            missing = pa.array([t is None for t in texts], pa.bool_())
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()), mask=missing)

        return work

    return make


def _decoding(sent):
    """Work on one piece: lists of ids to texts."""

    def make():
        vocabulary = PieceVocabulary.read(sent.value)
        byte_of = {i: b for b, i in enumerate(vocabulary.byte_ids or ())}
        is_byte = np.zeros(len(vocabulary.pieces), bool)
        is_byte[list(byte_of)] = True
        texts = np.array([p.replace(SPACE, " ") for p in vocabulary.pieces], object)
        plain = {b: i for i, b in byte_of.items() if b < 128}
        for byte, i in plain.items():
            texts[i] = chr(byte)  # a byte below 128 is a character by itself
            is_byte[i] = False

        def work(lists: pa.ListArray) -> list:
            values, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            out = []
            for i, valid in enumerate(lists.is_valid().to_pylist()):
                ids = values[offsets[i] : offsets[i + 1]]
                if not valid:
                    out.append(None)
                elif is_byte[ids].any():
                    out.append(decoded(ids.tolist(), vocabulary, byte_of))
                else:
                    out.append("".join(texts[ids].tolist()).removeprefix(" "))
            return out

        return work

    return make


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, ids) of every row; a narrow plan. The vocabulary is a fixed file of bounded size."""
    data = _model_bytes(docs, model)
    encoder = _encoding(docs.sparkSession.sparkContext.broadcast(data), hashlib.sha256(data).hexdigest())

    def make():
        work = encoder()
        return lambda part, texts: batch_of(part.column("doc_id"), ids=work(texts))

    return over_texts(docs, make, out_schema(docs, "ids array<int>"), size=SLICE_BYTES)


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""
    decoder = _decoding(encoded.sparkSession.sparkContext.broadcast(_model_bytes(encoded, model)))

    def run(batches):
        work = decoder()
        for batch in batches:
            yield batch_of(batch.column("doc_id"), text=pa.array(work(batch.column("ids")), pa.string()))

    return encoded.select("doc_id", "ids").mapInArrow(run, out_schema(encoded, "text string"))


def round_trip(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, ids, same_text) of every row: the ids, and whether they decode to the text.

    A text that holds the space mark itself decodes to one with spaces, as the vocabulary cannot tell them apart.
    """
    data = _model_bytes(docs, model)
    sent, name = docs.sparkSession.sparkContext.broadcast(data), hashlib.sha256(data).hexdigest()
    encoder, decoder = _encoding(sent, name), _decoding(sent)

    def make():
        encode_piece, decode_ids = encoder(), decoder()

        def work(part: pa.RecordBatch, texts: list) -> pa.RecordBatch:
            ids = encode_piece(texts)
            same = [a == b for a, b in zip(decode_ids(ids), texts)]
            return batch_of(part.column("doc_id"), ids=ids, same_text=pa.array(same, pa.bool_()))

        return work

    return over_texts(docs, make, out_schema(docs, "ids array<int>, same_text boolean"), size=SLICE_BYTES)
