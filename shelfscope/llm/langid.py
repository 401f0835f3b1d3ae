"""Language of a document as a mixture: expectation-maximisation over words.

Character n-gram counts per language over all training texts give each word a likelihood under each language. For a
document, expectation-maximisation estimates the share of its words that each language explains; languages enter the
set only while the likelihood gains more than a penalty of ``PENALTY * ln(words)`` for each one. The prediction is the language with
the largest share in that set, the score its share.

NULL texts and texts without a letter give ``und`` with score 0, as does a model without any training text. Ties go to
the language that sorts first. Training rows with a NULL text or language are left out; repeated rows count as often
as they occur. Columns other than doc_id, text and (for training) lang are not read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscope.llm.common import KEPT_WORDS, WordTable, batch_of, out_schema, over_texts, pieces, segment_sums, split_all, substring_codes, worker_table

UNKNOWN = "und"
BUCKETS = 1 << 16
SHORTEST, LONGEST = 2, 4
SMOOTHING = 0.5
PENALTY = 2.0
ROUNDS = 8
# n-grams of a word overlap, so each says less than an independent sign would.
SHARPNESS = 0.4
_LETTER = re.compile(r"[^\W\d_]")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class LanguageModel:
    """Log likelihood of each n-gram bucket under each language."""

    languages: tuple[str, ...]
    weights: np.ndarray  # BUCKETS x languages

    def of_words(self, words: list[str]) -> np.ndarray:
        bucket, owner = substring_codes(words, SHORTEST, LONGEST, BUCKETS)
        out = np.empty((len(words), len(self.languages)), np.float32)
        for i in range(len(self.languages)):
            out[:, i] = np.bincount(owner, self.weights[bucket, i], len(words)) * SHARPNESS
        return out


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def ngram_counts(docs: DataFrame, language: str = "lang") -> DataFrame:
    """(language, bucket, n) over all texts, counted in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, dict[str, int]] = {}
        total: dict[str, np.ndarray] = {}

        def fold(name: str) -> None:
            words = seen.pop(name)
            bucket, owner = substring_codes(list(words), SHORTEST, LONGEST, BUCKETS)
            times = np.fromiter(words.values(), np.float64, len(words))
            total[name] = total.get(name, 0) + np.bincount(bucket, times[owner], BUCKETS)

        for batch in batches:
            for part, texts in pieces(batch):
                for name, text in zip(part.column("lang").to_pylist(), texts):
                    mine = seen.setdefault(name, {})
                    for word in _words(text):
                        mine[word] = mine.get(word, 0) + 1
                    if len(mine) > KEPT_WORDS:
                        fold(name)
        for name in list(seen):
            fold(name)
        for name, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at].astype(np.int64))], ["lang", "bucket", "n"]
            )

    plain = docs.select(F.col(language).alias("lang"), "text").where("lang is not null and text is not null")
    return plain.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, language: str = "lang") -> LanguageModel:
    """The model of all given texts. The driver sees one number per language and bucket, whatever the corpus size."""
    rows = ngram_counts(docs, language).toArrow()
    names = np.array(rows["lang"].to_pylist(), object)
    languages = tuple(sorted(set(names)))
    weights = np.zeros((BUCKETS, len(languages)), np.float32)
    for i, name in enumerate(languages):
        at = names == name
        counts = np.zeros(BUCKETS)
        counts[rows["bucket"].to_numpy()[at]] = rows["n"].to_numpy()[at]
        weights[:, i] = np.log((counts + SMOOTHING) / (counts.sum() + SMOOTHING * BUCKETS))
    return LanguageModel(languages, weights)


def _mixture(likely: np.ndarray, bounds: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the allowed languages and the log likelihood of each text. likely: words x languages, largest 1."""
    sizes = np.diff(bounds)
    share = allowed / allowed.sum(1, keepdims=True)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    for _ in range(ROUNDS):
        joint = likely * share[owner].astype(np.float32)
        joint /= np.maximum(joint.sum(1, keepdims=True), 1e-30)
        share = segment_sums(joint, bounds) / np.maximum(sizes, 1)[:, None]
        share = np.where(sizes[:, None] > 0, share, allowed / allowed.sum(1, keepdims=True))
    gain = np.log(np.maximum((likely * share[owner].astype(np.float32)).sum(1), 1e-30))
    return share, segment_sums(gain, bounds)


def _may_have_more(likely: np.ndarray, bounds: np.ndarray, share: np.ndarray, gain: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Texts whose penalised likelihood might be least with several languages; for the others, one is proven to be best.

    The log likelihood is concave in the shares, so no shares lie above a mixture's value by more than its largest slope
    towards one language. Two languages or more cost one penalty more than one.
    """
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    mixed = np.maximum((likely * share[owner].astype(np.float32)).sum(1, keepdims=True), 1e-30)
    highest = gain + segment_sums(likely / mixed, bounds).max(1, initial=0) - sizes
    alone = segment_sums(np.log(np.maximum(likely[np.arange(len(owner)), first[owner]], 1e-30)), bounds)
    return highest - alone > PENALTY * np.log(np.maximum(sizes, 2)) - 1e-3


def mixtures(likely: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Shares per text over the language set of least penalised likelihood."""
    sizes = np.diff(bounds)
    likely = np.exp(likely - likely.max(1, keepdims=True))
    k = likely.shape[1]
    full, gain = _mixture(likely, bounds, np.ones((len(sizes), k)))
    order = np.argsort(-full, axis=1, kind="stable")
    best_share = np.zeros((len(sizes), k))
    best_share[np.arange(len(sizes)), order[:, 0]] = 1.0
    open_ = np.flatnonzero(_may_have_more(likely, bounds, full, gain, order[:, 0]))
    if len(open_) and k > 1:
        words = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in open_])
        some, some_bounds = likely[words], np.concatenate([[0], np.cumsum(sizes[open_])])
        cost = np.full(len(open_), np.inf)
        for size in range(1, k + 1):
            allowed = np.zeros((len(open_), k))
            np.put_along_axis(allowed, order[open_, :size], 1.0, 1)
            share, gain = _mixture(some, some_bounds, allowed)
            now = -gain + PENALTY * size * np.log(np.maximum(sizes[open_], 2))
            better = now < cost - 1e-9
            cost[better], best_share[open_[better]] = now[better], share[better]
    return best_share


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score) of every row; a narrow plan."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages numbers
    name = uuid.uuid4().hex

    def make():
        one: LanguageModel = sent.value
        known = worker_table(name, lambda: WordTable(one.of_words))

        def work(part: pa.RecordBatch, texts: list) -> pa.RecordBatch:
            words, bounds = split_all(texts, _words)
            names, scores = [], []
            if one.languages:
                numbers = known.numbers(words)
                share = mixtures(known.values[numbers], bounds)
                best = share.argmax(1)
            for i, text in enumerate(texts):
                if not one.languages or not text or not _LETTER.search(text):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                else:
                    names.append(one.languages[best[i]])
                    scores.append(min(1.0, float(share[i, best[i]])))
            return batch_of(part.column("doc_id"), lang_pred=pa.array(names, pa.string()), score=pa.array(scores, pa.float64()))

        return work

    return over_texts(docs, make, out_schema(docs, "lang_pred string, score double"))


def identify(docs: DataFrame, training: Column) -> DataFrame:
    """Learn from the training rows, predict every row."""
    return predict(docs, train(docs.where(training)))
