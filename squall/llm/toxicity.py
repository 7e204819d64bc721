"""Toxicity scores from two class-conditional Kneser-Ney character models.

Both classes (labelled toxic or not) have their own counts of five-character
events; all shorter contexts are shared: their continuation counts are pooled
over both classes. An expression too rare to be counted in a class is thus
smoothed by the same lower orders in both models and says little, while one that
a class uses often says much. Events are of two kinds that never mix (their code
points differ by ``RUNNING``): those that run over the whole text, word
boundaries included, and those of single words, which a document counts once.
A document has two statistics. The first is the signed difference of its two
log-likelihoods over all running events, divided by their number (plus a
constant), so every word and phrase counts for the class that it is likelier in.
The second keeps a few insults in a long text from being averaged away: what the
differences of the document's different words exceed ``MARGIN`` by, divided by
the number of these words (plus a constant). A logistic curve over both turns
them into a score; it is fitted on labelled rows that the counts have not seen
and so decides how much each says. Neither may lower the score by speaking for
the toxic class.

All counts come from distributed aggregation over every labelled training row.
The model is two tables, one row for every counted event and every context, and
grows with the corpus: continuation counts, discounts and totals are grouped and
joined in Spark, and neither driver nor tasks hold it whole. Texts are scored in
chunks of ``CHUNK_ROWS`` rows of a file: the different events of each chunk, as
contexts and what follows them, are joined to the tables and written to a folder
of the chunk, which the task that scores the chunk's rows reads.

Edge cases: null and empty texts have statistics 0 and thus the curve's score for
no evidence; null labels are no labels; a doc_id labelled more than once counts
as toxic if any of its labels says so; without labels of both classes every
score is 0; a null doc_id counts as empty text for the fold; repeated rows score
alike. Other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, functions as F

from squall.llm.common import file_place, folder_files, give_back, placed, release, scratch, ship, slices, stage, strings

ORDER = 5
CHUNK_ROWS = 1 << 13   # rows of a file whose events are looked up together
CHUNK_FILES = 8        # hashed parts of a chunk's events, so that tasks write alike
SLICE = 2 << 20        # bytes of text handled at once; an event takes some fifty
FOLDS = 5
CALIBRATION_FOLD = 1   # training rows kept from the counts and used for the curve
PRIOR_WORDS = 30.0     # added to a document's length
PRIOR_EVENTS = 100.0   # added to a text's running events
MARGIN = 3.0           # log-likelihood ratio above which a word stands out
RUNNING = 0x80000      # added to the code points of running events; no letter is there
BINS = 1024            # of each statistic, even on a scale that is linear up to SCALE, then logarithmic
SCALE = 0.001
STATISTICS = ("signed", "above")
BEGIN, END = "\x02", "\x03"
BREAK = r"[^\pL\pN]+"


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def plain_texts(texts: pa.Array) -> pa.Array:
    """Lower-case words with one space between."""
    return pc.utf8_trim(pc.replace_substring_regex(pc.utf8_lower(strings(texts)), BREAK, " "), " ")


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, one after the other, and the number of each."""
    data, ends = texts.buffers()[2], np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    every = data.slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes().decode() if len(texts) and data else ""
    return (np.frombuffer(every.encode("utf-32-le"), "<u4"),
            pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))


def padded_texts(before: str, texts: pa.Array, after: str) -> pa.Array:
    part = [pa.scalar(x, pa.large_string()) for x in (before, after, "")]
    return pc.binary_join_element_wise(part[0], texts, *part[1:])


def words(plain: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of plain texts, their number at each place, and the places
    at which documents begin and end."""
    parts = pc.split_pattern(plain, " ")
    flat = parts.flatten()
    real = pc.not_equal(flat, "")  # an empty text
    coded = flat.filter(real).dictionary_encode()
    upto = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return (coded.dictionary, coded.indices.to_numpy(zero_copy_only=False),
            upto[parts.offsets.to_numpy() - parts.offsets[0].as_py()])


def events(distinct: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of every event (n, ORDER) of the words, and the word of each."""
    codes, size = code_points(padded_texts(BEGIN * (ORDER - 1), strings(pa.array(distinct, pa.large_string())), END))
    word = np.repeat(np.arange(len(size)), size - (ORDER - 1))
    at = np.arange(len(word)) + word * (ORDER - 1)
    return np.lib.stride_tricks.sliding_window_view(codes, ORDER)[at] if len(at) else codes.reshape(0, ORDER), word


def running_events(plain: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The events that run over the words of plain texts, with one space before
    and behind: code points of all texts, the place of each event's first one,
    and the text of each event."""
    codes, size = code_points(pc.if_else(pc.equal(plain, ""), plain, padded_texts(BEGIN * (ORDER - 2) + " ", plain, " ")))
    n = np.maximum(size - (ORDER - 1), 0)
    text = np.repeat(np.arange(len(n)), n)
    return codes + np.uint32(RUNNING), np.arange(len(text)) + (np.cumsum(size) - size - np.cumsum(n) + n)[text], text


def running_hashes(codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes of running events, the code points of each (n, ORDER), and
    which of them stands at each place."""
    if not len(at):
        return np.empty(0, np.uint64), np.empty((0, ORDER), "<u4"), at
    windows = np.lib.stride_tricks.sliding_window_view(codes, ORDER)
    coded = pa.array(code_hash(windows)[at]).dictionary_encode()
    which = coded.indices.to_numpy(zero_copy_only=False)
    first = np.empty(len(coded.dictionary), np.int64)
    first[which[::-1]] = at[::-1]
    return coded.dictionary.to_numpy(), windows[first], which


def code_hash(codes: np.ndarray) -> np.ndarray:
    h = np.full(len(codes), 0x9E3779B97F4A7C15, np.uint64)
    for i in range(codes.shape[1]):
        h = (h ^ codes[:, i].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h


def in_documents(at: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each document's different words: (document, word) once each."""
    doc = np.repeat(np.arange(len(bounds) - 1, dtype=np.int64), np.diff(bounds))
    pairs = np.sort(doc * n + at)
    pairs = pairs[np.concatenate([[True], pairs[1:] != pairs[:-1]])] if len(pairs) else pairs
    return pairs // max(n, 1), pairs % max(n, 1)


def different(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes of the rows of ``codes``, one row of each, and which of
    them stands in each row."""
    coded = pa.array(code_hash(codes)).dictionary_encode()
    which = coded.indices.to_numpy(zero_copy_only=False)
    first = np.empty(len(coded.dictionary), np.int64)
    first[which[::-1]] = np.arange(len(codes))[::-1]
    return coded.dictionary.to_numpy(), codes[first], which


def count_events(texts: pa.Array, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct events of some texts as code points (n, ORDER), and their counts
    in ordinary and toxic texts (n, 2); a text counts each of its words once and
    every running event."""
    plain = plain_texts(texts)
    distinct, at, bounds = words(plain)
    doc, at = in_documents(at, bounds, len(distinct))
    label = toxic[doc]
    weight = np.stack([np.bincount(at[label == c], minlength=len(distinct)) for c in (0, 1)], axis=1)
    codes, word = events(distinct)
    seen, codes, place = different(codes)
    counts = np.stack([np.bincount(place, weight[word, c], len(seen)) for c in (0, 1)], axis=1)
    running, at, text = running_events(plain)
    seen, running, which = running_hashes(running, at)
    more = np.bincount(which * np.int64(2) + toxic[text], minlength=2 * len(seen)).reshape(-1, 2)
    return np.concatenate([codes, running]), np.concatenate([counts.astype(np.int64), more])


def text_events(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct events of some texts as code points (n, ORDER), and their hashes."""
    plain = plain_texts(texts)
    h, codes, _ = different(events(words(plain)[0])[0])
    running, at, _ = running_events(plain)
    seen, running, _ = running_hashes(running, at)
    return np.concatenate([codes, running]), np.concatenate([h, seen])


def text_statistics(texts: pa.Array, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Each text's length-normalised log-likelihood difference and what its words
    stand out by (n, 2), from the values of its events (others have 0)."""
    n = len(texts)
    plain = plain_texts(texts)
    running, at, text = running_events(plain)
    seen, _, which = running_hashes(running, at)
    distinct, at, bounds = words(plain)
    codes, word = events(distinct)
    found = _find(keys, values, np.concatenate([seen, code_hash(codes)]), np.float32(0))
    signed = np.bincount(text, found[:len(seen)][which], n) / (np.bincount(text, minlength=n) + PRIOR_EVENTS)
    value = np.bincount(word, found[len(seen):], len(distinct))
    doc, at = in_documents(at, bounds, len(distinct))
    above = np.bincount(doc, np.maximum(value - MARGIN, 0)[at], n) / (np.bincount(doc, minlength=n) + PRIOR_WORDS)
    return np.stack([signed, above], axis=1)


def followers_of_contexts(codes: np.ndarray) -> pa.RecordBatch:
    """Different events (n, ORDER) by what precedes their last character: every
    context once, and the code points that follow it."""
    h = code_hash(codes[:, :-1])
    order = np.argsort(h)
    first = np.flatnonzero(np.diff(h[order], prepend=~h[order[:1]]))
    ends = pa.array(np.append(first, len(order)), pa.int32())
    followers = pa.ListArray.from_arrays(ends, pa.array(codes[order, -1].astype(np.int32)))
    return pa.RecordBatch.from_arrays([event_names(codes[order[first], :-1]), followers], names=["context", "followers"])


def event_names(codes: np.ndarray) -> pa.Array:
    flat = np.ascontiguousarray(codes).ravel()
    size = (1 + (flat >= 0x80) + (flat >= 0x800) + (flat >= 0x10000)).reshape(codes.shape).sum(axis=1)
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    data = flat.tobytes().decode("utf-32-le").encode()
    return pa.StringArray.from_buffers(len(codes), pa.py_buffer(ends), pa.py_buffer(data))


@dataclass
class Model:
    """Log-likelihood differences (toxic minus ordinary) of counted events, and
    of any other event after a counted context, in memory."""

    events: np.ndarray
    event_value: np.ndarray
    contexts: np.ndarray
    context_value: np.ndarray

    def word_values(self, distinct: list[str]) -> np.ndarray:
        codes, word = events(distinct)
        value = _find(self.contexts, self.context_value, code_hash(codes[:, :-1]), np.float32(0))
        value = _find(self.events, self.event_value, code_hash(codes), value)
        return np.bincount(word, value, len(distinct))


@dataclass
class Tables:
    """The same as staged tables (event, value) and (context, value), and the
    curve; no tables if there were no labels of both classes."""

    events: DataFrame | None = None
    contexts: DataFrame | None = None
    curve: tuple[float, float, float] = field(default=(0.0, 0.0, -50.0))
    folders: list[str] = field(default_factory=list)  # values looked up for texts

    def valued(self, wanted: DataFrame) -> DataFrame:
        """``wanted`` (context, followers and other columns) with the value of each
        follower; contexts that were never counted are left out.

        An event is named by its context and one code point, and meets the model
        in one join: a chunk has several events of most contexts."""
        follower = F.struct(F.ascii(F.substring("event", ORDER, 1)), "value")
        counted = (self.events.groupBy(F.substring("event", 1, ORDER - 1).alias("context"))
                   .agg(F.map_from_entries(F.collect_list(follower)).alias("counted")))
        known = self.contexts.withColumnRenamed("value", "other").join(counted, "context")
        return (wanted.join(known, "context")
                .withColumn("values", F.transform("followers", lambda x: F.coalesce(F.try_element_at("counted", x), "other")))
                .drop("counted", "other"))

    def statistics(self, texts: pa.Array) -> np.ndarray:
        """Of a few texts on the driver."""
        keys, values = np.empty(0, np.uint64), np.empty(0, np.float32)
        if self.events is not None:
            wanted = pa.Table.from_batches([followers_of_contexts(text_events(texts)[0])])
            keys, values = _by_hash([self.valued(self.events.sparkSession.createDataFrame(wanted)).toArrow()])
        return text_statistics(texts, keys, values)

    def scores(self, statistics: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.evidence(statistics) + self.curve[2], -60, 60)))

    def evidence(self, statistics: np.ndarray) -> np.ndarray:
        return self.curve[0] * statistics[:, 0] + self.curve[1] * statistics[:, 1]


def _by_hash(tables: Iterable[pa.Table]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and values of the events in tables of context, followers and values."""
    h, value = [np.empty(0, np.uint64)], [np.empty(0, np.float32)]
    for batch in (b for t in tables for b in t.to_batches()):
        contexts = code_points(strings(batch.column("context")))[0].reshape(-1, ORDER - 1)
        followers = batch.column("followers")
        contexts = np.repeat(contexts, followers.value_lengths().to_numpy(), axis=0)
        h.append(code_hash(np.column_stack([contexts, followers.flatten().to_numpy().astype("<u4")])))
        value.append(batch.column("values").flatten().to_numpy())
    return np.concatenate(h), np.concatenate(value)


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default) -> np.ndarray:
    if not len(keys):
        return np.broadcast_to(default, wanted.shape).copy()
    at = pc.fill_null(pc.index_in(pa.array(wanted), value_set=pa.array(keys)), -1).to_numpy(zero_copy_only=False)
    return np.where(at >= 0, values[at], default)


def _discount(counts: np.ndarray) -> float:
    once, twice = int((counts == 1).sum()), int((counts == 2).sum())
    return once / (once + 2 * twice) if once and twice else 0.5


def _groups(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows: hashes, one row of each, and the group of every row."""
    h, first, group = np.unique(code_hash(codes), return_index=True, return_inverse=True)
    return h, codes[first], group


def estimate(codes: np.ndarray, counts: np.ndarray) -> Model:
    """The models from distinct events (n, ORDER) and class counts (n, 2) in
    memory; ``estimate_tables`` does the same in Spark."""
    # shared orders below the highest: how many different characters precede
    shared = []   # from the longest to the shortest: (group of each longer row, rows)
    rows = codes
    for _ in range(ORDER - 1):
        _, shorter, group = _groups(rows[:, 1:])
        shared.append((group, shorter, np.bincount(group, minlength=len(shorter))))
        rows = shorter
    below = None
    for group, rows, n in reversed(shared):
        if rows.shape[1] == 1:
            kind = (rows[:, 0] >= RUNNING).astype(int)
            below = (n + 0.5) / np.bincount(kind, n + 0.5)[kind]
        else:
            d = _discount(n)
            _, _, context = _groups(rows[:, :-1])
            total, types = np.bincount(context, n), np.bincount(context)
            below = np.maximum(n - d, 0) / total[context] + d * types[context] / total[context] * below
        below = below[group]
    # the highest order, each class by itself
    context_hash, _, context = _groups(codes[:, :-1])
    log = []
    back = []
    for c in (0, 1):
        n = counts[:, c]
        d = _discount(n)
        total = np.bincount(context, n)
        share = np.where(total > 0, d * np.bincount(context, n > 0) / np.maximum(total, 1), 1.0)
        log.append(np.log(np.maximum(n - d, 0) / np.maximum(total, 1)[context] + share[context] * below))
        back.append(np.log(share))
    keys = code_hash(codes)
    order = np.argsort(keys)
    return Model(keys[order], (log[1] - log[0])[order].astype(np.float32), context_hash,
                 (back[1] - back[0]).astype(np.float32))


def fit_curve(z: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression on two statistics given per bin (n, 2), by Newton steps
    with a weak pull towards zero weights; a weight below zero is left at zero."""
    n = toxic + ordinary
    mean = (n[:, None] * z).sum(axis=0) / n.sum()
    spread = np.sqrt((n[:, None] * (z - mean) ** 2).sum(axis=0) / n.sum())
    used = [i for i in range(2) if spread[i] > 0]
    while True:
        x = np.column_stack([z[:, used] / spread[used], np.ones(len(z))])
        pull = np.diag([1e-3] * len(used) + [1e-9])
        w = np.zeros(len(used) + 1)
        w[-1] = np.log((toxic.sum() + 0.5) / (ordinary.sum() + 0.5))
        for _ in range(200):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -60, 60)))
            step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + pull, x.T @ (toxic - n * p) - pull @ w)
            w = w + step / max(1.0, np.abs(step).max() / 2)
            if np.abs(step).max() < 1e-9:
                break
        if (w[:-1] >= 0).all():
            break
        used.pop(int(np.argmin(w[:-1])))
    weights = np.zeros(2)
    weights[used] = w[:-1] / spread[used]
    return float(weights[0]), float(weights[1]), float(w[-1])


def _table_discount(df: DataFrame, *columns: str) -> list[float]:
    """``_discount`` of columns of a table."""
    once, twice = ([F.sum((F.col(c) == k).cast("long")) for c in columns] for k in (1, 2))
    row = df.agg(*once, *twice).first()
    return [x / (x + 2 * y) if x and y else 0.5 for x, y in zip(row[:len(columns)], row[len(columns):])]


def estimate_tables(counted: DataFrame) -> Tables:
    """The models from the staged table of all events: event, ordinary, toxic."""
    # shared orders below the highest: how many different characters precede
    shared = {}
    rows, name = counted, "event"
    for order in range(ORDER - 1, 0, -1):
        rows = stage(rows.groupBy(F.substring(name, 2, order).alias("gram")).agg(F.count("*").alias("n")), "toxicity-order")
        shared[order], name = rows, "gram"
    running = F.col("gram") >= chr(RUNNING)
    sizes = shared[1].agg(*(F.sum(F.when(kind, F.col("n") + 0.5)) for kind in (running, ~running))).first()
    size = F.when(running, F.lit(sizes[0])).otherwise(F.lit(sizes[1]))
    below = shared[1].select(F.col("gram").alias("suffix"), ((F.col("n") + 0.5) / size).alias("below"))
    for order in range(2, ORDER):
        (d,) = _table_discount(shared[order], "n")
        rows = shared[order].withColumn("context", F.substring("gram", 1, order - 1)).withColumn("suffix", F.substring("gram", 2, order - 1))
        context = rows.groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("types"))
        p = F.greatest(F.col("n") - d, F.lit(0.0)) / F.col("total") + d * F.col("types") / F.col("total") * F.col("below")
        below = rows.join(context, "context").join(below, "suffix").select(F.col("gram").alias("suffix"), p.alias("below"))
    # the highest order, each class by itself
    rows = counted.withColumn("context", F.substring("event", 1, ORDER - 1)).withColumn("suffix", F.substring("event", 2, ORDER - 1))
    classes = ("ordinary", "toxic")
    discounts = dict(zip(classes, _table_discount(counted, *classes)))
    context = rows.groupBy("context").agg(*(F.sum(c).alias(f"{c}_total") for c in classes),
                                          *(F.sum((F.col(c) > 0).cast("long")).alias(f"{c}_types") for c in classes))
    for c, d in discounts.items():
        total = F.col(f"{c}_total")
        context = context.withColumn(f"{c}_share", F.when(total > 0, d * F.col(f"{c}_types") / total).otherwise(1.0))
    context = stage(context, "toxicity-contexts")
    log = {c: F.log(F.greatest(F.col(c) - d, F.lit(0.0)) / F.greatest(F.col(f"{c}_total"), F.lit(1))
                    + F.col(f"{c}_share") * F.col("below")) for c, d in discounts.items()}
    events = rows.join(context, "context").join(below, "suffix").select("event", (log["toxic"] - log["ordinary"]).cast("float").alias("value"))
    values = stage(events, "toxicity-events")
    release(counted.sparkSession, *shared.values())
    return Tables(values, context.select(
        "context", (F.log("toxic_share") - F.log("ordinary_share")).cast("float").alias("value")))


Labelled = Iterator[tuple[pa.Array, np.ndarray]]  # slices of texts, and whether each text is toxic


def own_labels(batches: Iterator[pa.RecordBatch]) -> Labelled:
    """Texts whose rows hold their labels."""
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            yield part.column("text"), part.column("toxic").to_numpy(zero_copy_only=False)


def count_table(texts: DataFrame, labelled: Callable[[Iterator[pa.RecordBatch]], Labelled] = own_labels) -> DataFrame:
    """Every event of labelled texts with its counts: event, ordinary, toxic.
    ``labelled`` takes texts and labels from batches of the table's rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for text, toxic in labelled(batches):
            codes, n = count_events(text, toxic)
            yield pa.RecordBatch.from_arrays([event_names(codes), pa.array(n[:, 0]), pa.array(n[:, 1])],
                                             names=["event", "ordinary", "toxic"])
        give_back()

    return stage(texts.mapInArrow(count, "event string, ordinary long, toxic long")
                 .groupBy("event").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")), "toxicity-counts")


def marked(labels: DataFrame) -> DataFrame:
    """doc_id and toxic of the labelled rows whose fold is not 0."""
    return (labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
            .where(F.col("toxic").isin(0, 1) & (fold(F.col("doc_id")) != 0))
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))


def place_labels(rows: DataFrame, labels: DataFrame) -> str:
    """Write the labels of ``rows`` (doc_id, chunk, mark); a folder for each chunk.

    Labels grow with the corpus, so the join is a shuffle at every size; texts
    take no part in it."""
    folder = scratch(rows.sparkSession, "toxicity-labels")
    (rows.select("doc_id", "chunk", "mark").join(marked(labels).hint("merge"), "doc_id").select("chunk", "mark", "toxic")
     .repartition("chunk").write.partitionBy("chunk").parquet(folder))
    return folder


def placed_labels(batches: Iterator[pa.RecordBatch], folder: str) -> Labelled:
    """The texts (text, chunk, mark) that have a label in their chunk's folder."""
    now, marks, toxic = None, pa.array([], pa.int64()), np.empty(0, np.int64)
    for batch in batches:
        for part, key in by_chunk(batch, "chunk"):
            if key != now:
                found = [pq.read_table(f, columns=["mark", "toxic"], partitioning=None)
                         for f in folder_files(f"{folder}/chunk={key}", ".parquet")]
                now, marks = key, pa.array(np.concatenate([t.column("mark").to_numpy() for t in found] or [np.empty(0, np.int64)]))
                toxic = np.concatenate([t.column("toxic").to_numpy() for t in found] or [np.empty(0, np.int64)])
            at = pc.index_in(part.column("mark"), value_set=marks)
            yield part.column("text").filter(pc.is_valid(at)), toxic[at.drop_null().to_numpy(zero_copy_only=False)]


def count_models(docs: DataFrame, labels: DataFrame) -> Tables:
    """Both models from the labelled rows that are neither held out nor kept for the curve."""
    ship(docs.sparkSession)
    docs, mark = placed(docs)
    rows = (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), chunk_of(docs).alias("chunk"), mark.alias("mark"))
            .where(~fold(F.col("doc_id")).isin(0, CALIBRATION_FOLD)))
    folder = place_labels(rows, labels)
    counted = count_table(rows.select("text", "chunk", "mark"), lambda batches: placed_labels(batches, folder))
    release(docs.sparkSession, folder)
    if not all(counted.agg(F.sum("ordinary"), F.sum("toxic")).first()):
        return Tables()
    model = estimate_tables(counted)
    release(docs.sparkSession, counted)
    return model


def calibrate(model: Tables, measured: DataFrame, labels: DataFrame) -> None:
    """Fit the model's curve on the statistics of the rows kept for it."""
    # only numbers meet the labels here
    scaled = [F.asinh(F.col(c) / SCALE) for c in STATISTICS]
    held = stage(measured.where(fold(F.col("doc_id")) == CALIBRATION_FOLD).join(marked(labels).hint("merge"), "doc_id")
                 .select("toxic", *(c.alias(n) for n, c in zip(STATISTICS, scaled))), "toxicity-held")
    ends = held.agg(*(f(c) for c in STATISTICS for f in (F.min, F.max))).first()
    if ends[0] is None:
        return
    low, high = np.array(ends[::2]), np.array(ends[1::2])
    width = np.maximum(high - low, 1e-9) / BINS
    place = [F.least(F.lit(BINS - 1), F.floor((F.col(c) - float(a)) / float(d)).cast("int")).alias(c)
             for c, a, d in zip(STATISTICS, low, width)]
    bins = (held.groupBy(*place).agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n"))
            .orderBy(*STATISTICS).toArrow())  # BINS * BINS rows at most
    toxic, n = (bins.column(c).to_numpy().astype(float) for c in ("toxic", "n"))
    if toxic.sum() and (n - toxic).sum():
        at = np.stack([bins.column(c).to_numpy() for c in STATISTICS], axis=1)
        model.curve = fit_curve(SCALE * np.sinh(low + (at + 0.5 * (high > low)) * width), toxic, n - toxic)


def train(docs: DataFrame, labels: DataFrame) -> Tables:
    """Models and curve, fitted on the labelled rows whose fold is not 0."""
    docs, _ = placed(docs)
    model = count_models(docs, labels)
    if model.events is not None:
        calibrate(model, statistics_of(docs.where(fold(F.col("doc_id").cast("long")) == CALIBRATION_FOLD), model), labels)
        release(docs.sparkSession, *model.folders)
    return model


def with_chunks(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column for the rows that are looked up together, the same
    in every scan, and its name."""
    docs, _ = placed(docs)
    name = "chunk"
    while name in (c.lower() for c in docs.columns):
        name += "_"
    return docs.select("*", chunk_of(docs).alias(name)), name


def chunk_of(docs: DataFrame) -> Column:
    path, index = file_place(docs)
    return F.xxhash64(path, F.floor(index / CHUNK_ROWS))


def look_up(docs: DataFrame, chunk: str, model: Tables) -> str:
    """Write the values of all events of ``docs``; a folder for each chunk."""

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seen = None, np.empty(0, np.uint64)
        for batch in batches:
            for part, key in by_chunk(batch, "chunk"):
                if key != now:
                    now, seen = key, np.empty(0, np.uint64)
                codes, h = text_events(part.column("text"))
                new = seen[np.minimum(np.searchsorted(seen, h), len(seen) - 1)] != h if len(seen) else np.ones(len(h), bool)
                if new.any():
                    # stable: the long sorted part is merged, not sorted again
                    seen = np.sort(np.concatenate([seen, np.sort(h[new])]), kind="stable")
                    found = followers_of_contexts(codes[new])
                    yield found.add_column(0, "chunk", pa.repeat(pa.scalar(key, pa.int64()), found.num_rows))

        give_back()

    folder = scratch(docs.sparkSession, "toxicity-values")
    rows = docs.select(F.col(chunk).alias("chunk"), F.col("text").cast("string")).mapInArrow(
        wanted, "chunk long, context string, followers array<int>")
    (model.valued(rows).select("chunk", "context", "followers", "values")
     .repartition("chunk", F.pmod(F.xxhash64("context"), F.lit(CHUNK_FILES))).write.partitionBy("chunk").parquet(folder))
    return folder


def by_chunk(batch: pa.RecordBatch, chunk: str) -> Iterator[tuple[pa.RecordBatch, int]]:
    """Runs of rows of one chunk, in slices."""
    keys = batch.column(chunk).to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
    for a, b in zip(cuts, cuts[1:]):
        for part in slices(batch.slice(a, b - a), "text", SLICE):
            yield part, int(keys[a])


def _measured(docs: DataFrame, model: Tables, answer, schema, columns: list | None = None) -> DataFrame:
    """What ``answer`` makes of each slice of ``docs`` and its statistics."""
    ship(docs.sparkSession)
    docs, chunk = with_chunks(docs)
    folder = look_up(docs, chunk, model) if model.events is not None else None
    model.folders += [folder] if folder else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, values = None, _by_hash([])
        for batch in batches:
            for part, key in by_chunk(batch, chunk):
                if folder and key != now:
                    now, values = key, _by_hash(pq.read_table(f, columns=["context", "followers", "values"], partitioning=None)
                                                for f in folder_files(f"{folder}/chunk={key}", ".parquet"))
                yield answer(part.drop_columns([chunk]), text_statistics(part.column("text"), *values))
        now, values = None, _by_hash([])
        give_back()

    return (docs if columns is None else docs.select(*columns, chunk)).mapInArrow(run, schema)


def statistics_of(docs: DataFrame, model: Tables) -> DataFrame:
    """doc_id and both statistics of every document."""
    return _measured(docs, model, lambda part, z: pa.RecordBatch.from_arrays(
        [part.column("doc_id"), *map(pa.array, z.T.copy())], names=["doc_id", *STATISTICS]),
        "doc_id long, signed double, above double", [F.col("doc_id").cast("long"), F.col("text").cast("string")])


def scored(measured: DataFrame, model: Tables) -> DataFrame:
    """doc_id, held_out, statistic (the weighted sum of both), score and
    predicted from doc_id and both statistics."""
    signed, above, constant = model.curve
    statistic = signed * F.col(STATISTICS[0]) + above * F.col(STATISTICS[1])
    z = F.greatest(F.least(statistic + constant, F.lit(60.0)), F.lit(-60.0))
    return measured.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), statistic.alias("statistic"),
                           (1 / (1 + F.exp(-z))).alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def score_documents(docs: DataFrame, model: Tables) -> DataFrame:
    """``scored`` for every document, with a model and its curve."""
    return scored(statistics_of(docs, model), model)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``scored`` for every document, with models and a curve from its own labelled
    rows: all texts are measured once, those kept for the curve among them."""
    docs, _ = placed(docs)
    model = count_models(docs, labels)
    measured = statistics_of(docs, model)
    if model.events is not None:
        measured = stage(measured, "toxicity-statistics")
        release(docs.sparkSession, *model.folders)
        calibrate(model, measured, labels)
    return scored(measured, model)


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not call toxic, all columns."""
    docs, _ = placed(docs)
    model = train(docs, labels)
    bare = Tables(curve=model.curve)
    return _measured(docs, model, lambda part, z: part.filter(pa.array(bare.scores(z) < 0.5)), docs.schema)
