"""Quality rules as a learned decision list, in DataFrame expressions only.

Statistics of each document (``statistics``) are columns. ``learn`` runs sequential covering on the statistics of labelled
documents: a rule starts empty, grows by the threshold literal of the largest information gain on the growing part, is
pruned on the other part while that does not lower its worth, and joins the list if it is precise enough there; the rows it covers are taken out
and the next rule follows. Every count is one Spark aggregate over the stored statistics. ``verdict`` turns the ordered
rules into one conditional expression.

NULL and empty texts have zero statistics and fail the base check. Without labelled rows of both classes the list is empty
and every document that passes the base check is kept. Ties between literals go to the one that sorts first. Repeated rows count
as often as they occur. Only doc_id and text of the documents are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscope.functions.bind import bind
from shelfscope.llm.common import labelled_sample, stored

SAMPLE = 10_000  # labelled documents whose statistics rules are learned from
MOST_RULES = 6
MOST_LITERALS = 3
PRECISION = 0.95  # of a rule on the pruning part
LEAST_COVERED = 5  # bad documents a rule must cover on the pruning part
QUANTILES = (0.01, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.9, 0.95, 0.98, 0.99)
FEATURES = ("n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "mark_share", "distinct_share")

_SPACE = " \t\n\x0b\x0c\r"
_SPACES = r"[\x20\x09-\x0D]+"
_SYMBOLS = "#*$%&|<>"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def words_of(text: Column) -> Column:
    """Words between white space; an empty array for texts without any."""
    trimmed = F.btrim(text, F.lit(_SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPACES))


def repeated_words(words: Column, size: int = 3) -> Column:
    """Words that lie in a window of ``size`` words found twice or more, the first included.

    Windows are hashed, packed with their place into one number and sorted; equal neighbours are compared word by word.
    """

    def covered(w: Column) -> Column:
        n = F.size(w)
        bits = F.ceil(F.log2(n + F.lit(1))).cast("int") + 1
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1

        def high(x: Column) -> Column:
            return F.call_function("shiftright", x, bits)

        def same(x: Column, y: Column) -> Column:
            a, b = x.bitwiseAND(mask).cast("int"), y.bitwiseAND(mask).cast("int")
            equal = high(x) == high(y)
            for k in range(size):
                equal = equal & (F.get(w, a + k) == F.get(w, b + k))
            return F.coalesce(equal, F.lit(False))

        packed = F.slice(
            F.transform(
                w,
                lambda x, i: F.call_function("shiftleft", F.xxhash64(x, *(F.get(w, i + k) for k in range(1, size))), bits).bitwiseOR(i.cast("long")),
            ),
            F.lit(1),
            n - (size - 1),
        )

        def marked(s: Column) -> Column:
            found = F.filter(s, lambda x, j: same(x, F.get(s, j - 1)) | same(x, F.get(s, j + 1)))
            return F.sort_array(F.transform(found, lambda x: x.bitwiseAND(mask)))

        def total(starts: Column) -> Column:
            spans = F.transform(starts, lambda x, j: F.least(F.lit(size).cast("long"), F.coalesce(F.get(starts, j + 1) - x, F.lit(size).cast("long"))))
            return F.aggregate(spans, F.lit(0).cast("long"), lambda a, x: a + x)

        return F.when(n < size + 1, F.lit(0).cast("long")).otherwise(bind(bind(F.sort_array(packed), marked), total))

    return bind(words, covered)


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, counts, shares) of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(_SPACE)) != "")
    counted = (
        docs.select("doc_id", text.alias("text"))
        .select(
            "doc_id",
            bind(words_of(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("again"),
                                                            F.size(F.array_distinct(w)).alias("distinct"))).alias("of_words"),
            F.length(_without(F.col("text"), _SPACE)).cast("long").alias("word_chars"),
            (F.length("text") - F.length(_without(F.col("text"), _SYMBOLS))).cast("long").alias("n_symbols"),
            bind(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("again"))).alias("of_lines"),
            (F.length("text") - F.length(_without(F.col("text"), _UPPER))).alias("upper"),
            (F.length("text") - F.length(_without(F.col("text"), "!?"))).alias("marks"),
        )
        .select("doc_id", F.col("of_words.n").alias("n_words"), "word_chars", "n_symbols", F.col("of_lines.again").alias("n_dup_lines"),
                F.col("of_words.again").alias("n_repeat_words"), "upper", "marks", F.col("of_words.distinct").alias("distinct"),
                F.col("of_lines.n").alias("lines"))
    )

    def share(part: str, whole: str) -> Column:
        return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")), F.lit(0.0))

    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share("word_chars", "n_words").alias("mean_word"), share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_dup_lines", "lines").alias("dup_line_share"), share("n_repeat_words", "n_words").alias("repeat_share"),
        share("upper", "word_chars").alias("upper_share"), share("marks", "word_chars").alias("mark_share"),
        share("distinct", "n_words").alias("distinct_share"),
    )


BASE_FAILED = "(n_words < 50 or 100 * n_repeat_words > 50 * n_words)"


@dataclass(frozen=True, order=True)
class Literal:
    feature: str
    above: bool
    bound: float

    def sql(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.bound!r}D"


Rule = tuple[Literal, ...]


def rule_sql(rule: Rule) -> str:
    return "(" + " and ".join(x.sql() for x in rule) + ")" if rule else "true"


def _counts(rows: DataFrame, conditions: list[str]) -> list[tuple[int, int]]:
    """(bad, good) rows under each condition, in one aggregate."""
    sums = [f"count_if({c} and {label}) as c{i}_{k}" for i, c in enumerate(conditions) for k, label in enumerate(("bad", "not bad"))]
    found = rows.selectExpr(*sums).first()
    return [(found[2 * i], found[2 * i + 1]) for i in range(len(conditions))]


def _gain(bad: int, good: int, before_bad: int, before_good: int) -> float:
    """Information gained about the bad rows still covered."""
    if not bad:
        return 0.0
    return bad * (math.log2(bad / (bad + good)) - math.log2(before_bad / (before_bad + before_good)))


def _worth(bad: int, good: int) -> float:
    return (bad - good) / (bad + good) if bad + good else -1.0


def learn(rows: DataFrame) -> list[Rule]:
    """Ordered rules for rejecting, from rows with the features, ``bad`` (boolean) and ``growing`` (boolean)."""
    bounds = rows.select(*(F.percentile_approx(f, list(QUANTILES), 10_000).alias(f) for f in FEATURES)).first()
    literals = sorted({Literal(f, above, float(v)) for f in FEATURES for v in (bounds[f] or ()) for above in (True, False)})
    rules: list[Rule] = []
    while literals and len(rules) < MOST_RULES:
        left = "not (" + " or ".join(rule_sql(r) for r in rules) + ")" if rules else "true"
        growing = f"growing and {left}"
        rule: Rule = ()
        ((bad, good),) = _counts(rows, [growing])
        while bad and good and len(rule) < MOST_LITERALS:
            found = _counts(rows, [f"{growing} and {rule_sql(rule)} and {x.sql()}" for x in literals])
            best = max(range(len(literals)), key=lambda i: (_gain(*found[i], bad, good), -i))
            if _gain(*found[best], bad, good) <= 1e-9:
                break
            rule, (bad, good) = (*rule, literals[best]), found[best]
        if not rule:
            break
        # Pruning: the shortest beginning of the rule that is worth most on the rows kept apart.
        heads = [rule[: k + 1] for k in range(len(rule))]
        found = _counts(rows, [f"not growing and {left} and {rule_sql(h)}" for h in heads])
        best = max(range(len(heads)), key=lambda k: (_worth(*found[k]), -k))
        bad, good = found[best]
        if bad < LEAST_COVERED or bad < PRECISION * (bad + good):
            break
        rules.append(heads[best])
    return rules


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> list[Rule]:
    chosen = labelled_sample(docs, labels, label, F.lit(True), sample)
    # Written before any condition on them: a filter would be moved below and compute the counts again.
    known = stored(statistics(chosen), "rule-statistics").join(chosen.select("doc_id", "label").distinct(), "doc_id")
    rows = known.where(f"not {BASE_FAILED}").select(
        *FEATURES, (F.col("label") == 0).alias("bad"), (F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(3)) > 0).alias("growing")
    )
    return learn(stored(rows, "rule-labels"))


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that holds, from 1; 0 if none does."""
    out = F.lit(0)
    for number, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(F.expr(rule_sql(rule)), F.lit(number)).otherwise(out)
    return out


def judged(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """(doc_id, statistics, base_failed, rule, kept) of every row; a narrow plan."""
    base = F.expr(BASE_FAILED)
    return statistics(docs).select("*", base.alias("base_failed"), verdict(rules).alias("rule")).withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
