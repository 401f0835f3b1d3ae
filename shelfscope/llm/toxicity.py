"""Toxic spans and document scores by a linear-chain conditional random field.

Tokens get labels from the labelled documents: a token is marked when its word or its prefix is tied to toxic
documents beyond chance, by a likelihood ratio over documents whose threshold grows with the number of words tested; in
samples too small to reach it, the best supported words are. A two-label field (plain, toxic) over word, prefix,
suffix, shape and neighbour features is trained on them by gradient ascent. Forward-backward marginals of every token of a whole
text give its offending spans and, through a small calibrated layer, the document score.

Features are summed per distinct word, and the forward and backward recursions run over blocks of all texts at once, so
a long text costs no more per token than a short one. Learning reads a bounded sample (``SAMPLE``) of labelled documents.

NULL and empty texts, and texts without words, have no spans and the score of a document without signs. Without labelled
rows of both classes every score is 0. Repeated rows give repeated results. Only doc_id and text of the documents are read.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from shelfscope.llm.common import WordTable, batch_of, labelled_sample, out_schema, over_texts, pieces, segment_max, segment_sums, split_all, worker_table

SAMPLE = 3000  # labelled documents learned from; the bound on what reaches the driver
BUCKETS = 1 << 17
MARK_BUCKETS = 1 << 22  # for counting words and prefixes by hash
ROUNDS = 25
RATE = 0.4
FEWEST_DOCUMENTS = 2  # toxic ones that share a marked word or prefix
SMALLEST_PURITY = 0.9  # share of its documents, and of its contexts, that are toxic
RIDGE = 1e-3
THRESHOLD = 0.7
SPAN_MARGINAL = 0.5
BLOCK = 64
LEARN_TOKENS = 100_000  # tokens whose marginals are held at a time while learning; one longer text is a part by itself
SLICE_BYTES = 1 << 20  # text scored at a time: some tens of numbers are held for each of its tokens
KEPT_WORDS = 300_000  # distinct words whose scores a Python worker keeps, also while it is idle
_WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _parts(word: str) -> tuple[str, ...]:
    """Named features of a word. Prefixes are parts of it, so that unseen forms of a known stem are recognised."""
    out = ["w" + word, "s" + word[-3:], "z" + ("d" if word.isdigit() else str(min(len(word), 12)))]
    out += ["p" + word[:n] for n in (3, 4, 5, 6) if len(word) > n]
    return tuple(out)


def _bucket(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % BUCKETS


def _features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    buckets, sizes = array("i"), array("i")
    for word in words:
        mine = _parts(word)
        buckets.extend(map(_bucket, mine))
        sizes.append(len(mine))
    owners = np.repeat(np.arange(len(words), dtype=np.int32), np.array(sizes, np.int32))
    return np.array(buckets, np.int32), owners


def marginals(toxic: np.ndarray, bounds: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over all texts: P(label toxic) per token, and the summed pair marginals (2 x 2).

    toxic: score of label 1 against label 0 per token; links[a, b]: score of label b after label a. Each text is cut
    into blocks; within a block the products of step matrices are built for all blocks at once, and a short second
    pass carries the state across the blocks of a text.
    """
    if not len(toxic):
        return np.zeros(0), np.zeros((2, 2))
    p, first, step, before, after = _both_ways(toxic, bounds, links)
    inner = np.flatnonzero(~first)
    joint = np.stack([x[inner - 1] * step[i, j] * y[inner] for i, x in enumerate(before) for j, y in enumerate(after)])
    pairs = (joint / np.maximum(joint.sum(0), 1e-300)).sum(1).reshape(2, 2)
    return p, pairs


def token_marginals(toxic: np.ndarray, bounds: np.ndarray, links: np.ndarray) -> np.ndarray:
    """The first result of ``marginals``: scoring needs no pairs of tokens."""
    return _both_ways(toxic, bounds, links)[0] if len(toxic) else np.zeros(0)


def _both_ways(toxic: np.ndarray, bounds: np.ndarray, links: np.ndarray) -> tuple:
    """P(label toxic) per token, which tokens are first in a text, the step matrix, forward and backward messages."""
    n = len(toxic)
    full = bounds[1:] > bounds[:-1]
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    first[bounds[:-1][full]] = True
    last[bounds[1:][full] - 1] = True
    step = np.exp(links - links.max())
    lift = np.exp(np.clip(toxic, -40, 40))
    a0, a1 = _messages(lift, first, step)
    # The backward pass is the forward pass of the reversed chain; both hold the token's own score, so one is taken out.
    b0, b1 = (x[::-1] for x in _messages(lift[::-1], last[::-1], step.T))
    plain, marked = a0 * b0, a1 * b1 / lift
    return marked / np.maximum(plain + marked, 1e-300), first, step, (a0, a1), (b0, b1)


def _messages(lift: np.ndarray, first: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the two labels at each token given all tokens up to it; they sum to 1."""
    n = len(lift)
    blocks = -(-n // BLOCK)

    def by_step(values: np.ndarray, rest) -> np.ndarray:
        padded = np.full(blocks * BLOCK, rest, values.dtype)
        padded[:n] = values
        return np.ascontiguousarray(padded.reshape(blocks, BLOCK).T)

    lifts, starts = by_step(lift, 1.0), by_step(first, False)
    # w[a][s]: weight of label s at this token when the block was entered with label a
    w = [[np.ones(blocks), np.zeros(blocks)], [np.zeros(blocks), np.ones(blocks)]]
    held = np.empty((2, 2, BLOCK, blocks))
    (s00, s01), (s10, s11) = step.tolist()
    for t in range(BLOCK):
        new = starts[t]
        any_new = new.any()
        total = 0.0
        for row in w:
            plain = row[0] * s00 + row[1] * s10
            marked = row[0] * s01 + row[1] * s11
            if any_new:  # a new text forgets what was before
                plain[new] = marked[new] = 1.0
            marked *= lifts[t]
            row[0], row[1] = plain, marked
            total = total + plain + marked
        for a, row in enumerate(w):
            row[0] /= total
            row[1] /= total
            held[a, 0, t], held[a, 1, t] = row
    state0, state1, entry = 0.5, 0.5, []
    for e00, e01, e10, e11 in zip(*(held[a, s, -1].tolist() for a in (0, 1) for s in (0, 1))):
        entry.append(state0)
        next0, next1 = state0 * e00 + state1 * e10, state0 * e01 + state1 * e11
        state0, state1 = next0 / (next0 + next1), next1 / (next0 + next1)
    entry0 = np.array(entry)
    out0, out1 = (held[0, s] * entry0 + held[1, s] * (1 - entry0) for s in (0, 1))
    out0, out1 = (x.T.reshape(-1)[:n] for x in (out0, out1))
    total = out0 + out1
    return out0 / total, out1 / total


@dataclass(frozen=True)
class ToxicModel:
    own: np.ndarray  # score per feature bucket of the token itself,
    before: np.ndarray  # of the word before it,
    after: np.ndarray  # and of the word after it
    links: np.ndarray
    bias: float
    layer: tuple[float, float, float]  # constant, largest marginal's logit, log of expected toxic tokens

    def of_words(self, words: list[str]) -> np.ndarray:
        bucket, owner = _features(words)
        n = len(words)
        return np.stack([np.bincount(owner, w[bucket], n) if n else np.zeros(0) for w in (self.own, self.before, self.after)], 1).astype(np.float32)

    def emissions(self, by_word: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Score of each token from itself and its neighbours; by_word: one row of three numbers per token."""
        out = by_word[:, 0].astype(np.float64) + self.bias
        inner = np.ones(len(out), bool)
        inner[bounds[:-1][bounds[1:] > bounds[:-1]]] = False
        at = np.flatnonzero(inner)
        out[at] += by_word[at - 1, 1]
        out[at - 1] += by_word[at, 2]
        return out

    def scores(self, p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        constant, top, amount = self.layer
        signs = _signs(p, bounds)
        return 1 / (1 + np.exp(-np.clip(constant + top * signs[:, 0] + amount * signs[:, 1], -500, 500)))


def _signs(p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text: logit of the largest marginal, and log of one plus the expected number of toxic tokens. Marginals near
    0 add nothing, or length alone would count as toxicity."""
    top = np.clip(segment_max(p, bounds, 0.0), 1e-4, 1 - 1e-4)
    expected = segment_sums(np.where(p > 0.1, p, 0.0), bounds)
    return np.stack([np.log(top / (1 - top)), np.log1p(expected)], 1)


def _ratio(with_toxic: np.ndarray, with_all: np.ndarray, toxic: int, total: int) -> np.ndarray:
    """Likelihood ratio of "documents with it are toxic at another rate"."""
    rate, mine = toxic / total, with_toxic / with_all

    def part(k, n, q):
        q = np.clip(q, 1e-12, 1 - 1e-12)
        return k * np.log(q) + (n - k) * np.log(1 - q)

    rest_k, rest_n = toxic - with_toxic, np.maximum(total - with_all, 1)
    return 2 * (part(with_toxic, with_all, mine) + part(rest_k, rest_n, rest_k / rest_n)
                - part(with_toxic, with_all, rate) - part(rest_k, rest_n, rate))


def marked_words(words: list[str], docs: list[np.ndarray], truth: np.ndarray) -> np.ndarray:
    """Which distinct words are labelled toxic: they or one of their prefixes are tied to toxic documents.

    Evidence is counted in documents that have the word in a context of their own (the word with its neighbours). The ratio
    asked for is what the largest of all tested words and prefixes would reach by chance, or the largest that there is.
    """
    part, sizes = array("i"), array("i")
    for word in words:
        mine = ["w" + word, *("p" + word[:n] for n in (4, 5, 6) if len(word) >= n)]
        part.extend(zlib.crc32(x.encode("utf-8", "surrogatepass")) % MARK_BUCKETS for x in mine)
        sizes.append(len(mine))
    part = np.array(part, np.int32)
    owner = np.repeat(np.arange(len(words), dtype=np.int32), np.array(sizes, np.int32))
    contexts = []
    for mine, label in zip(docs, truth):
        if len(mine):
            edge = (np.concatenate([[-1], mine, [-1]]) + 1).astype(np.uint64)
            mixed = (edge[:-2] * np.uint64(0x9E3779B1) + edge[2:]) * np.uint64(0xC2B2AE3D27D4EB4F) + edge[1:-1]
            # The last bit says clean, so of equal contexts a toxic one sorts first.
            contexts.append(((mixed * np.uint64(0x9E3779B97F4A7C15)) & ~np.uint64(1)) | np.uint64(label == 0))
    tokens, contexts = np.concatenate(docs), np.concatenate(contexts)
    by = np.argsort(contexts, kind="stable")
    fresh = np.ones(len(by), bool)
    fresh[1:] = (contexts[by[1:]] >> np.uint64(1)) != (contexts[by[:-1]] >> np.uint64(1))
    by = by[fresh]
    kept = np.zeros(len(tokens), bool)
    kept[by] = True
    uses = np.bincount(tokens[by], minlength=len(words))
    bad_uses = np.bincount(tokens[by], (contexts[by] & np.uint64(1)) == 0, len(words))
    # Only buckets that occur are counted.
    used, part = np.unique(part, return_inverse=True)
    uses, bad_uses = np.bincount(part, uses[owner], len(used)), np.bincount(part, bad_uses[owner], len(used))
    seen, bad, toxic, total = _documents_with(docs, kept, truth, part, owner, len(used))
    able = (bad >= FEWEST_DOCUMENTS) & (bad >= SMALLEST_PURITY * seen) & (bad_uses >= SMALLEST_PURITY * uses)
    if not able.any():
        return np.zeros(len(words), bool)
    ratio = _ratio(bad, np.maximum(seen, 1), toxic, total)
    # What the largest of so many ratios reaches by chance; the best supported buckets count in any sample.
    chance = 2 * np.log(max(int((seen >= 2).sum()), 1))
    strong = able & (ratio >= min(chance, ratio[able].max()))
    return np.bincount(owner, strong[part], len(words)) > 0


def _documents_with(docs: list[np.ndarray], kept: np.ndarray, truth: np.ndarray, part: np.ndarray, owner: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """For each bucket the documents and the toxic documents that have it, and the numbers of both.

    A document counts for the words that it has in a context of its own (``kept``), so copies count once, and a word that
    one document repeats counts once.
    """
    starts = np.searchsorted(owner, np.arange(owner[-1] + 2))
    seen, bad = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    low = toxic = total = 0
    for mine, label in zip(docs, truth):
        own = np.unique(mine[kept[low : low + len(mine)]])
        low += len(mine)
        if len(own):
            n = starts[own + 1] - starts[own]
            parts = np.unique(part[np.repeat(starts[own] - np.cumsum(n) + n, n) + np.arange(n.sum())])
            seen[parts] += 1
            bad[parts] += label
            total, toxic = total + 1, toxic + int(label)
    return seen, bad, toxic, total


def _tagged(model: ToxicModel, table: np.ndarray, tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of all texts, a few texts at a time; ``table`` has the three numbers of each distinct word."""
    p, pairs = np.empty(len(tokens)), np.zeros((2, 2))
    low = 0
    while low < len(bounds) - 1:
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + LEARN_TOKENS, "right")) - 1)
        a, b = bounds[low], bounds[high]
        mine = bounds[low : high + 1] - a
        p[a:b], some = marginals(model.emissions(table[tokens[a:b]], mine), mine, model.links)
        pairs += some
        low = high
    return p, pairs


class _Pace:
    """Steps along running means of the slopes, scaled by their running size."""

    def __init__(self, rate: float):
        self.rate, self.mean, self.square, self.n = rate, 0.0, 0.0, 0

    def step(self, slope: np.ndarray) -> np.ndarray:
        self.n += 1
        self.mean = 0.9 * self.mean + 0.1 * slope
        self.square = 0.95 * self.square + 0.05 * slope**2
        size = np.sqrt(self.square / (1 - 0.95**self.n))
        return self.rate * self.mean / (1 - 0.9**self.n) / (size + 1e-2)


def fit(texts: list[str], labels: list[int]) -> ToxicModel:
    """Train the field and the layer. Rows are sorted first, so the result does not depend on their order."""
    order = sorted(range(len(texts)), key=lambda i: (texts[i], labels[i]))
    truth = np.array([labels[i] for i in order], np.int64)
    numbers: dict[str, int] = {}
    docs = [np.array([numbers.setdefault(w, len(numbers)) for w in words_of(texts[i])], np.int32) for i in order]
    words = list(numbers)
    zero = np.zeros(BUCKETS)
    none = ToxicModel(zero, zero, zero, np.zeros((2, 2)), 0.0, (-50.0, 0.0, 0.0))
    if not len(truth) or truth.min() == truth.max() or not words:
        return none
    marks = marked_words(words, docs, truth)
    tokens = np.concatenate(docs)
    bounds = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    # A marked word in a clean document is a plain token.
    y = marks[tokens] & np.repeat(truth > 0, np.diff(bounds))
    if not y.any():
        return none
    bucket, owner = _features(words)
    inner = np.ones(len(tokens), bool)
    inner[bounds[:-1][bounds[1:] > bounds[:-1]]] = False
    inner = np.flatnonzero(inner)
    seen_pairs = np.bincount(y[inner - 1] * 2 + y[inner], minlength=4).reshape(2, 2)
    weights, links = np.zeros((3, BUCKETS)), np.log(seen_pairs + 1.0)
    links -= np.log(seen_pairs.sum(1, keepdims=True) + 2.0)
    bias, pace = 0.0, _Pace(RATE)
    model = none
    for _ in range(ROUNDS):
        model = ToxicModel(*weights, links, bias, none.layer)
        table = np.stack([np.bincount(owner, w[bucket], len(words)) for w in weights], 1)
        p, pairs = _tagged(model, table, tokens, bounds)
        error = y - p
        at = np.zeros((3, len(words)))
        at[0] = np.bincount(tokens, error, len(words))
        at[1] = np.bincount(tokens[inner - 1], error[inner], len(words))
        at[2] = np.bincount(tokens[inner], error[inner - 1], len(words))
        slopes = np.stack([np.bincount(bucket, at[k][owner], BUCKETS) for k in range(3)]) - RIDGE * weights
        steps = pace.step(np.concatenate([slopes.ravel(), (seen_pairs - pairs).ravel(), [error.sum()]]))
        weights = weights + steps[: 3 * BUCKETS].reshape(3, BUCKETS)
        links, bias = links + 0.3 * steps[3 * BUCKETS : -1].reshape(2, 2), bias + 0.3 * steps[-1]
    p, _ = _tagged(model, table, tokens, bounds)
    return ToxicModel(model.own, model.before, model.after, model.links, model.bias, _layer(_signs(p, bounds), truth))


def _layer(signs: np.ndarray, truth: np.ndarray) -> tuple[float, float, float]:
    """Logistic layer over the signs of a text, by Newton steps with a small ridge."""
    x = np.concatenate([np.ones((len(signs), 1)), signs], 1)
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (truth - p) - 0.1 * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3)
        w = w + np.clip(np.linalg.solve(bend, slope), -2, 2)
    return tuple(float(v) for v in w)


def train(docs: DataFrame, labels: DataFrame, training: Column, label: str = "toxic", sample: int = SAMPLE) -> ToxicModel:
    rows = labelled_sample(docs, labels, label, training, sample).select("text", "label").toArrow()
    return fit(rows["text"].to_pylist(), [int(x) for x in rows["label"].to_pylist()])


def tag(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """(doc_id, score, toxic_spans): spans are code points of the text, end exclusive. A narrow plan."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # three times BUCKETS numbers
    name = uuid.uuid4().hex

    def make():
        one: ToxicModel = sent.value
        known = worker_table(name, lambda: WordTable(one.of_words, KEPT_WORDS))

        def work(part: pa.RecordBatch, texts: list) -> pa.RecordBatch:
            words, bounds = split_all(texts, words_of)
            p = token_marginals(one.emissions(known.rows(words), bounds), bounds, one.links)
            spans: list[list] = [[] for _ in texts]
            hot = np.flatnonzero(p > SPAN_MARGINAL)
            for i in np.unique(np.searchsorted(bounds, hot, "right") - 1).tolist():
                # Lower-casing may change a text's length, so offsets are those of the words of the text itself.
                places = list(_WORD.finditer(texts[i]))
                chosen = hot[(hot >= bounds[i]) & (hot < bounds[i + 1])] - bounds[i]
                if len(places) == bounds[i + 1] - bounds[i]:
                    spans[i] = [{"start": places[j].start(), "end": places[j].end()} for j in chosen.tolist()]
            return batch_of(part.column("doc_id"), score=pa.array(one.scores(p, bounds), pa.float64()),
                            toxic_spans=pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))))

        return work

    return over_texts(docs, make, out_schema(docs, "score double, toxic_spans array<struct<start:int,end:int>>"), size=SLICE_BYTES)


def clean_only(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """Documents that are not rejected: each row is judged by its own text, and all columns stay as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    name = uuid.uuid4().hex

    def run(batches):
        one: ToxicModel = sent.value
        known = worker_table(name, lambda: WordTable(one.of_words, KEPT_WORDS))
        for batch in batches:
            for part, texts in pieces(batch, size=SLICE_BYTES):
                words, bounds = split_all(texts, words_of)
                p = token_marginals(one.emissions(known.rows(words), bounds), bounds, one.links)
                yield part.filter(pa.array(one.scores(p, bounds) < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
