"""Quality classifier: a sparse ensemble of rules over text statistics.

The byte pass of ``bytepass`` gives every whole text some twenty numbers (lengths,
shares of capitals, symbols and digits, how often words and lines repeat). A random
forest is grown over them on labelled rows, and every path from a root to a node
becomes a rule: a conjunction of intervals of statistics. An L1-penalised logistic
regression over the rules gives most of them weight zero; the penalty is the one
with the least loss on a part of the training rows kept for that. The rules
that are left are compiled into one Spark column expression, so scoring is the
statistics pass and an expression inside generated code; texts are never shuffled.

The fit uses at most about ``TRAIN_ROWS`` labelled rows, chosen by a hash of
their doc_id; statistics of other texts are not computed for it.

Edge cases: null and empty texts have the statistics of no words and are scored by the
same rules; a null doc_id counts as empty text for the fold and has no label;
null labels are none; a doc_id labelled more than once is good if any of its
labels says so; without labels of both classes every score is the share of good labels
(half without any); a statistic without a denominator is 0; repeated rows score
alike; an empty table gives no row. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from squall.llm import bytepass
from squall.llm.common import ship, slices, stage

FOLDS, HELD_OUT = 3, 1
TRAIN_ROWS = 20_000      # labelled rows that the fit may use
TUNING_SHARE = 5         # of which one in so many only chooses the penalty
TREES, DEPTH, BINS = 30, 4, 64
PENALTIES = (0.01, 0.003, 0.001, 0.0003)
SEED = 13
FIT_PARTITIONS = 4       # of the bounded training table
SLICE = 2 << 20          # bytes of text handled at once
STATISTICS = (
    "words", "code_points", "points_per_word", "longest_word", "distinct_share", "top_word_share", "repeat_share",
    "capital_share", "symbol_share", "digit_share", "stop_share", "symbol_words", "stop_words", "bare_symbols",
    "short_words", "lines", "words_per_line", "distinct_line_share", "wide_share", "longest_repeat")


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.where(whole > 0, part / np.maximum(whole, 1), 0.0)


def measure_texts(texts: pa.Array) -> np.ndarray:
    """The statistics of each text (n, len(STATISTICS))."""
    found = bytepass.run(texts)
    n = len(found.bounds) - 1
    per = lambda text, weight=None: np.bincount(text, weight, n)
    start, end = found.start, found.end
    text = found.text_of(start)
    words, points = per(text), found.points()
    # different words, and how often the commonest comes
    owner = bytepass.first_equal(found.data, start, end, text)
    uses = np.bincount(owner, minlength=len(owner))
    distinct, top = per(text[owner == np.arange(len(owner))]), np.zeros(n)
    np.maximum.at(top, text, uses)
    # runs of one word
    again = np.zeros(len(start), bool)
    again[1:] = (owner[1:] == owner[:-1])
    run = np.arange(len(start)) - np.maximum.accumulate(np.where(again, 0, np.arange(len(start))))
    longest_run, longest = np.zeros(n), np.zeros(n)
    np.maximum.at(longest_run, text, run)
    np.maximum.at(longest, text, end - start)
    capitals, symbols = found.count(bytepass.UPPER), found.count(bytepass.MARK)
    digits, stops = found.count(bytepass.FIGURE), found.count(bytepass.END_MARK)
    last = found.emitted[end - 1] if len(end) else found.emitted[:0]
    ends_symbol = (last & bytepass.MARK) > 0
    line_start, line_end = bytepass.lines(found)
    line_text = found.text_of(line_start)
    lines = per(line_text)
    same = bytepass.first_equal(found.data, line_start, line_end, line_text)
    different = per(line_text[same == np.arange(len(same))])
    size = np.diff(found.bounds)
    values = [
        words, points, _share(points, words), longest, _share(distinct, words), _share(top, words),
        _share(per(text, again), words), _share(capitals, points), _share(symbols, points), _share(digits, points),
        _share(stops, points), _share(per(text, ends_symbol), words),
        _share(per(text, (last & bytepass.END_MARK) > 0), words),
        _share(per(text, ends_symbol & (end - start == 1)), words), _share(per(text, end - start <= 3), words),
        lines, _share(words, lines), _share(different, lines), _share(size - points, size), longest_run]
    return np.stack([np.asarray(v, np.float64) for v in values], axis=1)


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and the statistics of each whole text."""
    ship(docs.sparkSession)
    schema = ", ".join(["doc_id long", *(f"{s} double" for s in STATISTICS)])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                values = measure_texts(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *map(pa.array, values.T.copy())],
                                                 names=["doc_id", *STATISTICS])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(measure, schema)


@dataclass(frozen=True)
class Rule:
    """A conjunction: (statistic, low, high) stands for low < statistic <= high."""

    terms: tuple[tuple[str, float, float], ...]

    def column(self) -> Column:
        met = F.lit(True)
        for name, low, high in self.terms:
            if low > -np.inf:
                met = met & (F.col(name) > low)
            if high < np.inf:
                met = met & (F.col(name) <= high)
        return met

    def __str__(self) -> str:
        return " and ".join(f"{low:g} < {name} <= {high:g}" for name, low, high in self.terms)


@dataclass
class RuleModel:
    rules: list[Rule]
    weights: list[float]
    intercept: float

    def evidence(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights):
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return total

    def score(self) -> Column:
        return 1 / (1 + F.exp(-F.greatest(F.least(self.evidence(), F.lit(60.0)), F.lit(-60.0))))


_BRANCH = re.compile(r"(If|Else) \(feature (\d+) (<=|>) ([^)]+)\)")


def tree_rules(described: str, names: tuple[str, ...] = STATISTICS) -> list[Rule]:
    """The rules of all paths in the printed form of a forest, each once.

    A branch's line is one step deeper than its parent's, so the stack of open
    branches at a line is the path to it.
    """
    rules: dict[tuple, None] = {}
    path: list[tuple[int, int, str, float]] = []
    for line in described.splitlines():
        depth = len(line) - len(line.lstrip())
        while path and path[-1][0] >= depth:
            path.pop()
        met = _BRANCH.search(line)
        if not met:
            continue
        path.append((depth, int(met[2]), met[3], float(met[4])))
        bounds: dict[int, tuple[float, float]] = {}
        for _, feature, side, at in path:
            low, high = bounds.get(feature, (-np.inf, np.inf))
            bounds[feature] = (low, min(high, at)) if side == "<=" else (max(low, at), high)
        rules[tuple(sorted((names[f], *b) for f, b in bounds.items()))] = None
    return [Rule(r) for r in rules]


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """Statistics of a bounded choice of labelled rows outside the held-out fold:
    doc_id, label, statistics."""
    good = F.col("quality").cast("int")
    marks = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), good.alias("label"))
             .where("doc_id IS NOT NULL AND label IN (0, 1)").where(fold(F.col("doc_id")) != HELD_OUT)
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    share = min(1.0, most / max(1, marks.count()))
    chosen = F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("long")), 1) <= F.lit(min(int(share * 2**63), 2**63 - 1))
    measured = statistics(docs.where((fold(F.col("doc_id").cast("long")) != HELD_OUT) & chosen))
    return measured.join(marks.where(chosen).hint("merge"), "doc_id")


def _different(rows: DataFrame, rules: list[Rule]) -> list[Rule]:
    """The first of the rules that hold for the same rows; none that hold for all or no row."""
    if not rules:
        return rules
    mark = F.xxhash64("doc_id").cast("decimal(20,0)")
    sums = rows.agg(F.sum(mark), *(F.sum(F.when(r.column(), mark)) for r in rules)).first()
    first = {}
    for rule, held in zip(rules, sums[1:]):
        if held is not None and held != sums[0]:
            first.setdefault(held, rule)
    return list(first.values())


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> RuleModel:
    """Grow the forest, take its paths as rules, weigh them."""
    rows = stage(training_rows(docs, labels, most).coalesce(FIT_PARTITIONS), "rules-training")
    seen = rows.agg(F.sum("label").cast("double"), F.count("*")).first()
    good, n = seen[0] or 0.0, seen[1]
    if good in (0.0, n):
        share = (good + 0.5) / (n + 1)
        return RuleModel([], [], float(np.log(share / (1 - share))))
    tuning = F.pmod(F.xxhash64(F.lit("tuning"), "doc_id"), F.lit(TUNING_SHARE)) == 0
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(
        rows.withColumns({"label": F.col("label").cast("double"), "tuning": tuning}))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, maxBins=BINS, seed=SEED, subsamplingRate=0.7,
                                    featureSubsetStrategy="onethird", minInstancesPerNode=5).fit(
        vectors.where(~F.col("tuning")).select("label", "features"))
    rules = _different(rows, tree_rules(forest.toDebugString))
    if not rules:
        return RuleModel([], [], float(np.log((good + 0.5) / (n - good + 0.5))))
    met = stage(vectors.select("label", "tuning", F.array(*(r.column().cast("double") for r in rules)).alias("rules")),
                "rules-met").select("label", "tuning", array_to_vector("rules").alias("features"))
    best = None
    for penalty in PENALTIES:
        fitted = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=60, standardization=True).fit(
            met.where(~F.col("tuning")))
        p = F.element_at(vector_to_array("probability"), 2)
        right = F.when(F.col("label") == 1, p).otherwise(1 - p)
        loss = fitted.transform(met.where("tuning")).agg(F.avg(-F.log(F.greatest(right, F.lit(1e-9))))).first()[0]
        if best is None or (loss is not None and loss < best[0]):
            best = (loss if loss is not None else np.inf, fitted)
    weights = best[1].coefficients.toArray()
    kept = np.flatnonzero(weights)
    return RuleModel([rules[i] for i in kept], [float(weights[i]) for i in kept], float(best[1].intercept))


def score_documents(docs: DataFrame, model: RuleModel) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    return statistics(docs).select(
        "doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), model.score().alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))
