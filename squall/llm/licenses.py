"""Licence scan: a trained paragraph classifier, confirmed by templates.

Paragraphs (lines; long ones in overlapping windows) are scored by a multinomial
logistic regression over sparse word one- and two-grams. It is trained on the
published notices of ``license_texts``, each in many variants that lose words
and stand among words of the corpus, against ``BACKGROUND`` paragraphs of the
corpus itself (a bounded sample of its different lines by hash). Lines that share
word pairs with a notice are no background, however common they are, so a corpus
full of licences does not teach that licences are ordinary. Probabilities are
tempered on variants that the regression has not seen, and a family is named only
above the least probability that keeps held-out notices of other licences out of it.
A named family must then be confirmed: the paragraph shares enough word pairs
with one of the family's notices. What is licence-like but falls below the
threshold, or is not confirmed, is ``unknown``.

Every window of every paragraph is weighed in its row, without a shuffle. A gram's
weight for a licence at best is its largest weight of any class over that of
``none``, so the sum of these bounds all classes at once: windows whose bound leaves
``none`` more likely than all licences together are done, the others are
scored by Spark ML's models. The bound drops nothing that the models would
keep (``bound`` tells why). Only windows that the regression takes for licences are kept
for the comparison with the notices. All of it is DataFrame work; weights and notices
are bounded by the notice list and the sample.

Edge cases: null and empty texts are ``none``; repeated rows give a row each;
ties go to the first paragraph; an empty table gives no row; other input columns
are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from squall.llm.common import placed, stage
from squall.llm.license_texts import NOTICES

BACKGROUND = 2000      # corpus paragraphs in the training set
VARIANTS = 12          # of each notice; the last quarter only calibrates
SLOTS = 48             # background paragraphs that variants stand in
FEATURES = 1 << 12
WINDOW, STEP = 32, 16  # words
CONFIRMED = 0.6        # share of word pairs
LIKELY = 0.5           # probability of being a licence at all
PRECISION = 0.99       # share of held-out foreign paragraphs that a family must keep out
LIKE = 0.5             # share of word pairs with a notice from which a line is no background
SLOTS_OF_GRAMS = 1 << 16
TOKEN = "[a-z0-9]+(?:[.+-][a-z0-9]+)*"
CLASSES = ["none", "unknown", *(f for f in NOTICES if f != "unknown")]


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def pairs(words: Column) -> Column:
    n = F.size(words)
    return F.when(n > 1, F.array_distinct(F.zip_with(F.slice(words, 1, F.greatest(n - 1, F.lit(0))), F.slice(words, 2, n),
                                                     lambda a, b: F.concat_ws(" ", a, b)))
                  ).otherwise(F.array().cast("array<string>"))


def grams(words: Column) -> Column:
    return F.array_union(words, pairs(words))


def paragraphs(docs: DataFrame) -> DataFrame:
    """(row, doc_id, paragraph, line) of all lines of all texts."""
    docs, place = placed(docs)
    rows = docs.select(place.alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # the outer form: explode would split every text twice, first for a filter on the number of lines
    return rows.select("row", "doc_id", F.posexplode_outer(F.split(F.coalesce("text", F.lit("")), "\n")).alias("paragraph", "line"))


@dataclass
class Scan:
    """Trained models (grams to features to class logits), temperature, least
    probability and notice pairs."""

    vocabulary: CountVectorizerModel
    model: LogisticRegressionModel
    temperature: float
    threshold: float
    notices: DataFrame


def _notices(spark: SparkSession) -> DataFrame:
    flat = [(i, family, text) for i, (family, text) in
            enumerate((f, t) for f, texts in NOTICES.items() for t in texts)]
    return spark.createDataFrame(flat, "notice int, family string, text string").coalesce(1)


def _notice_pairs(spark: SparkSession) -> DataFrame:
    words = _notices(spark).withColumn("words", tokens(F.col("text")))
    return stage(words.select("notice", "family", F.explode(pairs(F.col("words"))).alias("gram"),
                              F.size(pairs(F.col("words"))).alias("n")), "licence-pairs")


def resemblance(rows: DataFrame, key: list[str], notices: DataFrame) -> DataFrame:
    """Share of word pairs that ``words`` of each row have in common with each
    notice: key, family, similarity. Rows without a common pair are absent."""
    own = pairs(F.col("words"))
    shared = (rows.select(*key, F.explode(own).alias("gram"), F.size(own).alias("own")).join(F.broadcast(notices), "gram")
              .groupBy(*key, "notice", "family").agg(F.count("*").alias("both"), F.first("own").alias("own"), F.first("n").alias("n")))
    least = F.least("n", F.greatest("own", F.least("n", F.lit(4))))
    return shared.select(*key, "family", (F.col("both") / least).alias("similarity"))


def background_lines(docs: DataFrame, notices: DataFrame, most: int = BACKGROUND) -> DataFrame:
    """The words of at most ``most`` different lines of the corpus, by hash, that
    are not like a notice. Twice as many lines are read for it; where more than half
    of a corpus's different lines are like notices, there are fewer."""
    line = paragraphs(docs).where("line <> ''")
    mark = F.shiftrightunsigned(F.xxhash64("line"), 1)
    n = line.agg(F.approx_count_distinct(mark)).first()[0] or 1
    some = line.where(mark <= F.lit(min(2 * most * 2**63 // n, 2**63 - 1))).groupBy("line").agg(F.min(mark).alias("mark"))
    some = stage(some.select("mark", "line", tokens(F.col("line")).alias("words")), "licence-lines")
    like = resemblance(some, ["mark", "line"], notices).where(F.col("similarity") >= LIKE).select("mark", "line").distinct()
    return stage(some.join(like, ["mark", "line"], "left_anti").orderBy("mark", "line").limit(most).select("words").coalesce(1),
                 "licence-background")


def train(docs: DataFrame) -> Scan:
    spark = docs.sparkSession
    table = _notice_pairs(spark)
    notices = stage(_notices(spark).withColumn("words", tokens(F.col("text"))), "licence-notices")
    background = background_lines(docs, table)

    # variants: each word stays with probability 0.85, before some words of the background
    some = background.where(F.size("words") > 3).select(F.slice("words", 1, 20).alias("around"))
    some = some.withColumn("slot", F.row_number().over(Window.orderBy(F.xxhash64("around")))).where(F.col("slot") <= SLOTS)
    draw = lambda *c: F.pmod(F.xxhash64("notice", "variant", *c), F.lit(1000))
    base = (notices.withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))))
            .withColumn("slot", F.when(F.col("variant") % 3 == 1, F.pmod(draw(F.lit("around")), F.lit(SLOTS)) + 1))
            .join(some, "slot", "left"))
    kept = F.filter("words", lambda w, i: (F.col("variant") == 0) | (draw(i) < 850))
    around = F.col("around")
    examples = base.select("family", "variant", F.concat(kept, F.coalesce(around, F.array().cast("array<string>"))).alias("words"))
    negative = background.select(F.lit("none").alias("family"), F.pmod(F.xxhash64("words"), F.lit(VARIANTS)).cast("int").alias("variant"),
                                 "words")
    names = F.array(*map(F.lit, CLASSES))
    data = stage(examples.unionByName(negative).select((F.array_position(names, F.col("family")) - 1).cast("double").alias("label"),
                                                       "variant", grams(F.col("words")).alias("grams")).coalesce(2), "licence-examples")
    fitted = data.where(F.col("variant") < VARIANTS * 3 // 4)
    vocabulary = CountVectorizer(inputCol="grams", outputCol="features", vocabSize=FEATURES, minDF=2, binary=True).fit(fitted)
    model = LogisticRegression(regParam=0.002, maxIter=40, family="multinomial", standardization=False).fit(
        vocabulary.transform(fitted).select("label", "features"))
    held = vocabulary.transform(data.where(F.col("variant") >= VARIANTS * 3 // 4))
    temperature, threshold = _calibrate(spark, model, held)
    return Scan(vocabulary, model, temperature, threshold, table)


def _calibrate(spark: SparkSession, model, held: DataFrame) -> tuple[float, float]:
    """Temperature with the least held-out loss, and the probability that so
    many held-out paragraphs of no family stay below."""
    scored = stage(model.transform(held).select("label", vector_to_array("rawPrediction").alias("z")), "licence-held")
    grid = [0.5, 0.7, 1.0, 1.4, 2.0, 2.8]
    losses = scored.agg(*(F.avg(-F.log(F.element_at(_softmax("z", t), (F.col("label") + 1).cast("int")) + 1e-300))
                          .alias(f"t{i}") for i, t in enumerate(grid))).first()
    best = min(range(len(grid)), key=lambda i: losses[i] if losses[i] is not None else 0.0)
    p = _softmax("z", grid[best])
    top = scored.where(F.col("label") < 2).select(F.array_max(F.slice(p, 3, len(CLASSES))).alias("p"))
    bound = top.agg(F.percentile("p", PRECISION)).first()[0]
    return grid[best], min(max(bound or 0.0, 1.0 / len(CLASSES)), 0.5)


def _softmax(column: str | Column, temperature: float) -> Column:
    e = F.transform(column, lambda x: F.exp((x - F.array_max(column)) / temperature))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda s, y: s + y))


def windows_of(docs: DataFrame) -> DataFrame:
    """All windows of all paragraphs."""
    found = paragraphs(docs).withColumn("words", tokens(F.col("line"))).drop("line")
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (WINDOW - STEP), F.lit(1)), F.lit(STEP))
    windows = found.withColumn("start", F.explode_outer(starts))  # outer: as in ``paragraphs``
    return windows.select("row", "doc_id", "paragraph", "start", F.slice("words", F.col("start"), WINDOW).alias("words"))


def bound(scan: Scan) -> Column:
    """Whether ``words`` of a window may be a licence at all.

    With logits z, the window is a candidate if the sum of exp((z_c - z_none) / T)
    over the licence classes c exceeds (1 - LIKELY) / LIKELY. For every c,
    z_c - z_none is at most the largest difference of intercepts plus, for each
    different gram, its largest difference of weights; so the sum is at most the number of
    classes times the exponential of that. The grams' bounds stand in two arrays by
    hash; where grams of the vocabulary share a slot it holds their largest
    bound, not less than 0, for whatever falls there.
    """
    spark = scan.notices.sparkSession
    weights, intercepts = scan.model.coefficientMatrix.toArray(), scan.model.interceptVector.toArray()
    best = (weights[1:] - weights[0]).max(axis=0) / scan.temperature
    base = float((intercepts[1:] - intercepts[0]).max() / scan.temperature)
    listed = [(g.split(" ")[0], (g.split(" ") + [None])[1], float(u)) for g, u in zip(scan.vocabulary.vocabulary, best)]
    # as many rows as the vocabulary
    hashed = spark.createDataFrame(listed, "a string, b string, u double").select(
        F.when(F.col("b").isNull(), F.xxhash64("a")).otherwise(F.xxhash64("a", "b")), "u").collect()
    keys, values = [0] * SLOTS_OF_GRAMS, [0.0] * SLOTS_OF_GRAMS
    for h, u in hashed:
        at = h % SLOTS_OF_GRAMS
        if values[at] or keys[at]:
            keys[at], values[at] = -1, max(u, values[at], 0.0)
        else:
            keys[at], values[at] = h, u
    # literals of one array each, not of as many columns
    keys = F.from_json(F.lit(str(keys)), "array<bigint>")
    values = F.from_json(F.lit(str(values)), "array<double>")

    def worth(h: Column) -> Column:
        slot = F.pmod(h, F.lit(SLOTS_OF_GRAMS)).cast("int") + 1
        held = F.element_at(keys, slot)
        return F.when((held == h) | (held == -1), F.element_at(values, slot)).otherwise(0.0)

    def total(words: Column) -> Column:
        n = F.size(words)
        two = F.zip_with(F.slice(words, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(words, F.lit(2), F.greatest(n - 1, F.lit(0))),
                         lambda a, b: F.xxhash64(a, b))
        held = F.array_distinct(F.concat(F.transform(words, lambda w: F.xxhash64(w)), two))
        return F.when(n > 0, F.aggregate(held, F.lit(base), lambda s, h: s + worth(h))).otherwise(F.lit(float("-inf")))

    # bound in a lambda, so that the window's words are cut out once
    sums = F.element_at(F.transform(F.array("words"), total), 1)
    least = math.log((1 - LIKELY) / LIKELY / max(1, len(intercepts) - 1))
    return sums > F.lit(least - 1e-6)


def candidates(docs: DataFrame, scan: Scan) -> DataFrame:
    """The windows that are licences more likely than not, with the class
    probabilities ``p``."""
    windows = windows_of(docs).where(bound(scan)).withColumn("grams", grams(F.col("words")))
    missing = F.array_repeat(F.lit(-30.0), len(CLASSES) - scan.model.numClasses)  # classes without examples
    scored = scan.model.transform(scan.vocabulary.transform(windows))
    z = scored.select("row", "doc_id", "paragraph", "start", "words",
                      F.concat(vector_to_array("rawPrediction"), missing).alias("z"))
    # bound in a lambda, so that the models run once for a window and not once for each use of z
    p = F.element_at(F.transform(F.array("z"), lambda x: _softmax(x, scan.temperature)), 1)
    return z.withColumn("p", p).drop("z").where(F.element_at("p", 1) < 1 - LIKELY)


def scan_paragraphs(docs: DataFrame, scan: Scan) -> DataFrame:
    """Licence-like paragraphs: row, doc_id, paragraph, family, probability, similarity."""
    key = ["row", "doc_id", "paragraph", "start"]
    windows = stage(candidates(docs, scan), "licence-candidates")
    p = windows.select(*key, "p")
    names = F.array(*map(F.lit, CLASSES[2:]))
    families = F.slice("p", 3, len(CLASSES) - 2)
    p = p.select(*key, F.array_max(families).alias("probability"),
                 F.element_at(names, F.array_position(families, F.array_max(families)).cast("int")).alias("named"))
    shared = (resemblance(windows, key, scan.notices).groupBy(*key, F.col("family").alias("named"))
              .agg(F.max("similarity").alias("similarity")))
    scored = p.join(shared, [*key, "named"], "left").withColumn("similarity", F.coalesce("similarity", F.lit(0.0)))
    sure = (F.col("probability") >= scan.threshold) & (F.col("similarity") >= CONFIRMED)
    scored = scored.withColumn("family", F.when(sure, F.col("named")).otherwise("unknown"))
    best = F.max(F.struct((F.col("family") != "unknown").alias("sure"), "probability", "similarity", (-F.col("start")).alias("first"),
                          "family")).alias("b")
    return scored.groupBy("row", "doc_id", "paragraph").agg(best).select("row", "doc_id", "paragraph", "b.family", "b.probability",
                                                                         "b.similarity")


def scan_documents(docs: DataFrame, scan: Scan | None = None) -> DataFrame:
    """One row per document: doc_id, license (families in order, ``unknown`` or
    ``none``), paragraph, probability and similarity of the surest paragraph,
    and how many paragraphs are licence-like."""
    docs, place = placed(docs)
    scan = scan or train(docs)
    found = scan_paragraphs(docs, scan)
    best = F.max(F.struct((F.col("family") != "unknown").alias("sure"), "probability", (-F.col("paragraph")).alias("first"),
                          "similarity")).alias("b")
    known = F.array_sort(F.collect_set(F.when(F.col("family") != "unknown", F.col("family"))))
    per = (found.groupBy("row", "doc_id").agg(known.alias("known"), best, F.count("*").alias("n"))
           .withColumnsRenamed({"row": "r", "doc_id": "d"}))
    rows = docs.select(place.alias("row"), F.col("doc_id").cast("long"))
    return rows.join(per, (F.col("row") == F.col("r")) & F.col("doc_id").eqNullSafe(F.col("d")), "left").select(
        "doc_id", F.when(F.col("n").isNull(), "none").when(F.size("known") == 0, "unknown")
        .otherwise(F.array_join("known", ",")).alias("license"),
        (-F.col("b.first")).cast("int").alias("paragraph"), F.col("b.probability").alias("probability"),
        F.col("b.similarity").alias("similarity"), F.coalesce("n", F.lit(0)).cast("int").alias("paragraphs"))
