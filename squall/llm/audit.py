"""Filter interaction audit: what each quality filter removes in every order.

One pass of the byte transducer of ``bytepass`` over a whole text counts its
words, capitals, code points and symbols and inserts its word spans into a
verified hash table, which gives the number of different words. Filters are
conditions over these numbers, so the texts are read once, never shuffled, and a
document shrinks to one bit a filter. A filter that looks at the whole table
(the copy of a smaller doc_id's text) works on SHA-256 digests: rows are counted
per digest and combination before they meet, so a text that a third of all
documents share is a handful of rows.

What a filter does in an order depends only on which filters a document fails.
Documents are therefore counted per part and set of failed filters (at most
2**filters rows a part), and every order is worked out from these counts.

Edge cases: a null text is empty; a null lang is the part ``''``, the same as an
empty one; a row without doc_id is a document that copies nothing and that none
copies, and has no label; a doc_id on several rows is so many documents, none of
them a copy of another for that; a doc_id labelled more than once has a label if any of
its rows says so; null labels say nothing; an empty table gives no row. Other
columns of both tables are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from squall.llm import bytepass
from squall.llm.common import ship, slices

SLICE = 2 << 20  # bytes of text handled at once
COUNTS = ("words", "distinct_words", "capitals", "code_points", "symbols")

# failure conditions over the counts of a text
TEXT_FILTERS: dict[str, Column | str] = {
    "A": "words < 100",
    "B": "100 * distinct_words < 80 * words",
    "C": "100 * capitals > 10 * code_points",
    "D": "symbols > 0",
}
COPY_FILTER = "E"


def count_texts(texts: pa.Array) -> np.ndarray:
    """The counts of each text (n, 5) in the order of ``COUNTS``."""
    found = bytepass.run(texts)
    text = found.text_of(found.start)
    owner = bytepass.first_equal(found.data, found.start, found.end, text)
    first = found.start[owner == np.arange(len(owner))]
    return np.stack([found.per_text(found.start), found.per_text(first), found.count(bytepass.UPPER),
                     found.points(), found.count(bytepass.MARK)], axis=1)


def text_counts(docs: DataFrame, text: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """``keep`` and the counts of the whole text of each row."""
    ship(docs.sparkSession)
    keep = keep if keep is not None else [F.col("doc_id").cast("long").alias("doc_id")]
    rows = docs.select(*keep, F.col(text).cast("string").alias("audited_text"))
    fields = [f for f in rows.schema.fields if f.name != "audited_text"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"{c} long" for c in COUNTS])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "audited_text", SLICE):
                counts = count_texts(part.column("audited_text"))
                yield pa.RecordBatch.from_arrays([part.column(f.name) for f in fields] + [pa.array(c) for c in counts.T.copy()],
                                                 names=[f.name for f in fields] + list(COUNTS))

    return rows.mapInArrow(measure, schema)


def failures(docs: DataFrame, filters: dict[str, Column | str] | None = None) -> DataFrame:
    """doc_id, part, digest of the text and ``failed``, a bit for each filter in
    order, one row per document."""
    filters = TEXT_FILTERS if filters is None else filters
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    counted = text_counts(docs, keep=[F.col("doc_id").cast("long").alias("doc_id"),
                                      F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                                      F.unhex(F.sha2(text, 256)).alias("digest")])
    bits = F.lit(0)
    for i, condition in enumerate(filters.values()):
        condition = F.expr(condition) if isinstance(condition, str) else condition
        bits = bits + F.when(condition, F.lit(1 << i)).otherwise(F.lit(0))
    return counted.select("doc_id", "part", "digest", bits.alias("failed"))


def failure_counts(docs: DataFrame, labels: DataFrame, filters: dict[str, Column | str] | None = None) -> DataFrame:
    """Documents per part, set of failed filters (the copy filter has the highest
    bit) and label: part, failed, good, toxic, n."""
    filters = TEXT_FILTERS if filters is None else filters
    marks = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality").cast("int") == 1).alias("good"),
                           (F.col("toxic").cast("int") == 1).alias("toxic")).where("doc_id IS NOT NULL")
             .groupBy("doc_id").agg(F.max(F.coalesce("good", F.lit(False))).alias("good"),
                                    F.max(F.coalesce("toxic", F.lit(False))).alias("toxic")))
    group = ["digest", "part", "failed", "good", "toxic"]
    # labels grow with the documents, so the join is a shuffle at every size; equal rows are one from here on
    rows = (failures(docs, filters).groupBy("doc_id", "part", "digest", "failed").agg(F.count("*").alias("n"))
            .join(marks.hint("merge"), "doc_id", "left")
            .withColumns({"good": F.coalesce("good", F.lit(False)), "toxic": F.coalesce("toxic", F.lit(False))}))
    # per digest and group: all its documents, those without an id, and how many have its smallest id
    numbered = F.col("doc_id").isNotNull()
    per = rows.groupBy(*group).agg(F.sum("n").alias("n"), F.sum(F.when(~numbered, F.col("n")).otherwise(0)).alias("bare"),
                                   F.min(F.when(numbered, F.struct("doc_id", "n"))).alias("least"))
    # the groups of one digest: as many as its parts and labels differ, however many documents share it
    joined = per.withColumn("first_id", F.min("least.doc_id").over(Window.partitionBy("digest")))
    original = F.col("bare") + F.when(F.col("least.doc_id") == F.col("first_id"), F.col("least.n")).otherwise(0)
    split = F.explode(F.array(F.struct(F.lit(0).alias("bit"), original.alias("n")),
                              F.struct(F.lit(1 << len(filters)).alias("bit"), (F.col("n") - original).alias("n"))))
    return (joined.select("part", "failed", "good", "toxic", split.alias("s")).where("s.n > 0")
            .groupBy("part", (F.col("failed") + F.col("s.bit")).alias("failed"), "good", "toxic").agg(F.sum("s.n").alias("n")))


def interactions(counts: DataFrame, names: list[str]) -> DataFrame:
    """Every order of the filters over the rows of ``failure_counts``: one row per
    part, order and step."""
    sets, orders = 1 << len(names), factorial(len(names))
    # what a filter does after a set of others is the same in all orders that put these first
    at = F.explode(F.sequence(F.lit(0), F.lit(len(names) * sets - 1)))
    bit, before = F.expr(f"shiftleft(1, at div {sets})"), F.col("at") % sets
    rows = (counts.withColumn("at", at).select("*", bit.alias("bit"), before.cast("int").alias("before"))
            .where("(bit & before) = 0"))
    gone, fails = F.expr("(failed & before) != 0"), F.expr("(failed & bit) != 0")
    total = lambda which: F.sum(F.when(which, F.col("n")).otherwise(0))
    # a document's failed filters each come first among them in as many of the orders
    share = F.when(fails, F.floor(F.col("n") * orders / F.bit_count("failed"))).otherwise(0)
    steps = rows.groupBy("part", "bit", "before").agg(
        total(~gone & ~fails).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"),
        total(F.col("failed") == F.col("bit")).alias("unique_fails"), total(fails & ~gone & F.col("good")).alias("good_lost"),
        total(fails & ~gone & F.col("toxic")).alias("toxic_lost"), F.sum(share).alias("shapley"))
    where = {}
    for order in permutations(range(len(names))):
        for step, b in enumerate(order):
            where.setdefault((1 << b, sum(1 << x for x in order[:step])), []).append(("".join(names[x] for x in order), step + 1))
    flat = [(b, s, o, step) for (b, s), uses in where.items() for o, step in uses]
    # as many rows as orders have steps, whatever the data
    table = counts.sparkSession.createDataFrame(flat, "bit int, before int, filter_order string, step int")
    return steps.join(F.broadcast(table), ["bit", "before"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Column | str] | None = None) -> DataFrame:
    """The whole audit of ``filters`` and the copy filter, in all orders."""
    filters = TEXT_FILTERS if filters is None else filters
    return interactions(failure_counts(docs, labels, filters), [*filters, COPY_FILTER])


ORACLE = """
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, part, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
l AS (
  SELECT doc_id, max((coalesce(quality, 0) = 1)::INT) AS good, max((coalesce(toxic, 0) = 1)::INT) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (
  SELECT part,
    (len(words) < 100)::INT
    + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT
    + 16 * coalesce(doc_id > first_id, false)::INT AS failed,
    coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
o(filter_order, used, step, letter, before, bit) AS (
  SELECT '', 0, 0, '', 0, 0
  UNION ALL
  SELECT filter_order || chr(65 + i::INT), used + (1 << i::INT), step + 1, chr(65 + i::INT), used, 1 << i::INT
  FROM o, range(5) r(i) WHERE (used >> i::INT) & 1 = 0),
s AS (
  SELECT a.filter_order, b.step, b.before, b.bit FROM o a JOIN o b
  ON a.step = 5 AND b.step > 0 AND starts_with(a.filter_order, b.filter_order)),
r AS (
  SELECT part, filter_order, step, bit,
    sum(n) FILTER (failed & before = 0 AND failed & bit = 0) AS kept,
    sum(n) FILTER (failed & before = 0 AND failed & bit > 0) AS removed,
    sum(n) FILTER (failed & before > 0 AND failed & bit > 0) AS redundant,
    sum(n) FILTER (failed = bit) AS unique_fails,
    sum(good) FILTER (failed & before = 0 AND failed & bit > 0) AS good_lost,
    sum(toxic) FILTER (failed & before = 0 AND failed & bit > 0) AS toxic_lost
  FROM c, s GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  sum(coalesce(removed, 0)) OVER (PARTITION BY part, bit)::BIGINT AS shapley
FROM r
"""
