"""Supervised subword embeddings for document quality.

Every word and every character n-gram of it is hashed to a learned vector; a word is the mean of its vectors, a
document the mean of its words, and a softmax layer gives the probability of label 1. Vectors and layer are trained together
by numpy stochastic gradient descent on a bounded sample of labelled documents (``SAMPLE``), whole texts each.

Because the layer is linear, a trained word is one number, so scoring costs a lookup per word and a mean.
NULL and empty texts, and texts without words, get the score of the bias alone. Without labelled rows every score is
0.5. Rows with a NULL label are not learned from; repeated label rows count once, with their smallest label. Only
doc_id and text of the documents are read.
"""

from __future__ import annotations

import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from shelfscope.llm.common import WordTable, batch_of, labelled_sample, out_schema, over_texts, segment_sums, split_all, substring_codes, worker_table

SAMPLE = 2500  # labelled documents learned from; the bound on what reaches the driver
BUCKETS = 1 << 16
WIDTH = 8
SHORTEST, LONGEST = 1, 4
EPOCHS = 6
BATCH = 32
RATE = 0.5
THRESHOLD = 0.3
REPEAT = "\x00again"  # white space never leaves a word like it


@dataclass(frozen=True)
class QualityModel:
    effect: np.ndarray  # logit per bucket
    bias: float

    def of_words(self, words: list[str]) -> np.ndarray:
        bucket, owner = _features(words)
        return np.bincount(owner, self.effect[bucket], len(words)) / np.maximum(np.bincount(owner, minlength=len(words)), 1)


def _features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and their n-grams, and the word each belongs to."""
    buckets, owners = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for at in range(0, len(words), 40_000):  # bounds the memory of the n-grams
        some = words[at : at + 40_000]
        bucket, owner = substring_codes(some, SHORTEST, LONGEST, BUCKETS // 2)
        buckets += [bucket.astype(np.int32), np.fromiter(map(_hash, some), np.int32, len(some))]
        owners += [(owner + at).astype(np.int32), np.arange(at, at + len(some), dtype=np.int32)]
    return np.concatenate(buckets), np.concatenate(owners)


def _hash(word: str) -> int:
    return BUCKETS // 2 + zlib.crc32(word.encode("utf-8", "surrogatepass")) % (BUCKETS // 2)


def _split(text: str) -> list[str]:
    """Words, and after each word that equals the one before it the sign REPEAT: the word pair that marks filler."""
    words = text.split()
    out = words[:1]
    for before, word in zip(words, words[1:]):
        out.append(word)
        if word == before:
            out.append(REPEAT)
    return out


def _softmax(logits: np.ndarray) -> np.ndarray:
    shifted = np.exp(logits - logits.max(1, keepdims=True))
    return shifted / shifted.sum(1, keepdims=True)


def _sparse(words: np.ndarray, times: np.ndarray, bucket: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A document's buckets and the share of each in the mean of its words' means."""
    spans = starts[words + 1] - starts[words]
    inner = np.repeat(starts[words] - np.cumsum(spans) + spans, spans) + np.arange(spans.sum())
    cell, back = np.unique(bucket[inner], return_inverse=True)
    share = np.bincount(back, np.repeat(times / max(1, times.sum()) / np.maximum(spans, 1), spans), len(cell))
    return cell.astype(np.int32), share.astype(np.float32)


def fit(texts: list[str], labels: list[int], seed: int = 7) -> QualityModel:
    """Train on whole texts. Rows are sorted first, so the result does not depend on their order."""
    order = sorted(range(len(texts)), key=lambda i: (texts[i], labels[i]))
    truth = np.array([labels[i] for i in order], np.int64)
    if not len(truth):
        return QualityModel(np.zeros(BUCKETS), 0.0)
    numbers: dict[str, int] = {}
    docs = []
    for i in order:
        mine = np.array([numbers.setdefault(w, len(numbers)) for w in _split(texts[i])], np.int64)
        docs.append(np.unique(mine, return_counts=True))
    bucket, owner = _features(list(numbers))
    by_word = np.argsort(owner, kind="stable")
    bucket, starts = bucket[by_word], np.searchsorted(owner[by_word], np.arange(len(numbers) + 1))
    cells, shares = zip(*(_sparse(words, times, bucket, starts) for words, times in docs))

    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH))
    layer, bias = np.zeros((WIDTH, 2)), np.zeros(2)
    weight = len(truth) / (2 * np.maximum(np.bincount(truth, minlength=2), 1))[truth]  # both classes count alike
    usable = np.array([i for i, c in enumerate(cells) if len(c)], np.int64)
    steps, total = 0, max(1, EPOCHS * -(-len(usable) // BATCH))
    for _ in range(EPOCHS):
        rng.shuffle(usable)
        for at in range(0, len(usable), BATCH):
            chosen = usable[at : at + BATCH]
            rate = RATE * (1 - steps / total)
            steps += 1
            cell, part = np.concatenate([cells[i] for i in chosen]), np.concatenate([shares[i] for i in chosen])[:, None]
            sizes = [len(cells[i]) for i in chosen]
            hidden = segment_sums(vectors[cell] * part, np.concatenate([[0], np.cumsum(sizes)]))
            error = _softmax(hidden @ layer + bias)
            error[np.arange(len(chosen)), truth[chosen]] -= 1
            error *= weight[chosen][:, None]
            back_hidden = np.repeat(error @ layer.T, sizes, axis=0)
            layer -= rate * hidden.T @ error / len(chosen) * 4
            bias -= rate * error.mean(0)
            np.add.at(vectors, cell, -4 * rate * back_hidden * part)
    effect = vectors @ (layer[:, 1] - layer[:, 0])
    return QualityModel(effect, float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, training: Column, label: str = "quality", sample: int = SAMPLE) -> QualityModel:
    rows = labelled_sample(docs, labels, label, training, sample).select("text", "label").toArrow()
    return fit(rows["text"].to_pylist(), [int(x) for x in rows["label"].to_pylist()])


def predict(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score) of every row; a narrow plan."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers
    name = uuid.uuid4().hex

    def make():
        one: QualityModel = sent.value
        known = worker_table(name, lambda: WordTable(one.of_words))

        def work(part: pa.RecordBatch, texts: list) -> pa.RecordBatch:
            words, bounds = split_all(texts, _split)
            numbers = known.numbers(words)
            mean = segment_sums(known.values[numbers], bounds) / np.maximum(np.diff(bounds), 1)
            score = 1 / (1 + np.exp(-np.clip(mean + one.bias, -500, 500)))
            return batch_of(part.column("doc_id"), score=pa.array(score, pa.float64()))

        return work

    return over_texts(docs, make, out_schema(docs, "score double"))
