"""Document fingerprints from closed syncmers.

A k-mer of code points is a closed syncmer if the smallest hash among its inner
s-mers is at its first or its last place (ties count). Whether a k-mer is chosen
depends on the k-mer alone, so shared passages give the same anchors in any
surroundings. A text's fingerprint is a bottom-k sketch of its anchors, each
numbered among equal ones so that repeated passages keep their weight; likeness
is the Jaccard estimate that two sketches give. ``anchors`` returns the chosen
k-mers with their places, and ``offset_votes`` matches two documents by place.

Texts of every length have anchors of this one kind: a fingerprint's k-mers run
over the text with ``K - 1`` marks before and behind it, so that the shortest
text has some too. Of them the first and the last are always chosen, and any
seven that follow each other hold a closed syncmer.

Edge cases: an empty or null text has the empty fingerprint, which is like another empty one (1.0) and
unlike any other (0.0); repeated rows follow each other in doc_id, then text
order, nulls first; a single row is its own neighbour; an empty table gives no
row. Other input columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from squall.llm.common import ship, slices

S = 5
WINDOW = 8            # inner s-mers of a k-mer; two of them are edges
K = S + WINDOW - 1
SKETCH = 128
EDGE = "\U0010ffff" * (K - 1)   # before and behind a text; no character
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

_HASH = np.uint64((1 << 48) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values."""
    x = x * _MIX[0]
    x ^= x >> np.uint64(30)
    x *= _MIX[1]
    x ^= x >> np.uint64(27)
    x *= _MIX[2]
    x ^= x >> np.uint64(31)
    return x


def _grams(codes: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of every run of n values."""
    base = np.uint64(0x100000001B3)
    h = codes[:len(codes) - n + 1].copy()
    for i in range(1, n):
        h *= base
        h += codes[i:len(codes) - n + 1 + i]
    return h


def closed_syncmers(codes: np.ndarray, s: int = S, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the closed syncmers of a run of code points."""
    k = s + window - 1
    if len(codes) < k:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    codes = codes.astype(np.uint64) + np.uint64(1)
    inner = mix(_grams(codes, s))
    n = len(codes) - k + 1
    least = inner
    width = 1
    while width < window:  # sliding minimum over doubling widths
        step = min(width, window - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    chosen = np.flatnonzero((inner[:n] == least) | (inner[window - 1:] == least))
    # the first and last inner s-mer cover the k-mer if they meet; else hash all of it
    whole = inner[chosen] * _MIX[1] + inner[chosen + window - 1]
    if k > 2 * s:
        for i in range(s, window - 1, s):
            whole = whole * _MIX[1] + inner[chosen + i]
    return chosen, mix(whole)


def _numbered(keys: np.ndarray) -> np.ndarray:
    """32-bit values of sorted (text, hash) keys, equal hashes of a text told
    apart by a number."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.arange(len(keys))
    count = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
    return mix((keys & _HASH) ^ (count * _MIX[2])) >> np.uint64(32)


def sketches(texts: list[str], size: int = SKETCH) -> list[np.ndarray]:
    """The ``size`` smallest anchors of each text, ascending (32 bits each)."""
    if len(texts) > 1 << 16:
        return sketches(texts[:1 << 16], size) + sketches(texts[1 << 16:], size)
    full = [i for i, t in enumerate(texts) if t]  # an empty text has no anchors
    ends = np.cumsum([len(EDGE) + len(texts[i]) for i in full], dtype=np.int64)
    # no k-mer reaches over the marks between two texts; one belongs to the text that it starts before or in
    codes = np.frombuffer("".join([*(EDGE + texts[i] for i in full), EDGE]).encode("utf-32-le"), "<u4")
    at, h = closed_syncmers(codes)
    text = np.array(full, np.uint64)[np.searchsorted(ends, at, "right")]
    # the text's number above 48 bits of the hash: one sort groups and orders
    keys = np.sort((text << np.uint64(48)) | (h >> np.uint64(16)))
    keys = np.sort((keys >> np.uint64(48) << np.uint64(32)) | _numbered(keys))
    bounds = np.searchsorted(keys, np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(32)).tolist()
    return [keys[a:min(b, a + size)].astype(np.uint32) for a, b in zip(bounds, bounds[1:])]


def likeness(a: np.ndarray, b: np.ndarray, size: int = SKETCH) -> float:
    """Share of the smallest anchors of both texts together that both have."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    # a value held twice in a sketch stands for two anchors that fell together
    merged, counts = np.unique(np.concatenate([np.unique(a), np.unique(b)]), return_counts=True)
    return float((counts[:size] == 2).mean())


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by the head of the next one."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


FINGERPRINTS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                "near_edited double, near_next double")
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                     ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                     ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _below(value: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds are smaller (null: none); binary search."""
    if not bounds:
        return F.lit(0)
    cuts = F.array(*(F.lit(b).cast("long") for b in bounds))
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))))
    return F.aggregate(steps, F.lit(0), lambda low, step: F.when(F.try_element_at(cuts, low + step) < value, low + step)
                       .otherwise(low))


def ranges(docs: DataFrame) -> tuple[DataFrame, int]:
    """``docs`` (doc_id, text) with a range number by doc_id and, at the end of
    each range, a copy of the first row of the next one (``guest``); the last
    range gets the first row of all, so every row is followed by its successor.

    Only range bounds and one doc_id per range pass the driver; their number is
    that of the shuffle partitions.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = sorted(set(rows.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.1 / n))) if n > 1 else []
    bounds = [int(b) for b in bounds]
    numbered = rows.withColumn("part", _below(F.col("doc_id"), bounds))
    least = (numbered.groupBy("part").agg(F.min("doc_id").alias("least"), F.max(F.col("doc_id").isNull()).alias("none"))
             .orderBy("part").collect())
    if not least:
        return numbered.withColumn("guest", F.lit(False)), 0
    before = {r["part"]: least[i - 1]["part"] for i, r in enumerate(least)}
    firsts = [(r["part"], None if r["none"] else r["least"], before[r["part"]]) for r in least]
    heads = spark.createDataFrame(firsts, "part int, doc_id long, home int")  # one row per range
    first = (numbered.alias("n").join(F.broadcast(heads).alias("h"),
                                      (F.col("n.part") == F.col("h.part")) & F.col("n.doc_id").eqNullSafe(F.col("h.doc_id")))
             .groupBy("h.home").agg(F.min(F.struct("n.doc_id", "n.text")).alias("r"))
             .select("r.doc_id", "r.text", F.col("home").alias("part"), F.lit(True).alias("guest")))
    return numbered.withColumn("guest", F.lit(False)).unionByName(first), len(least)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of their edited forms, with likenesses."""
    ship(docs.sparkSession)
    rows, parts = ranges(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []   # rows not yet answered; the last one waits for its successor
        for batch in batches:
            for piece in slices(batch, "text", 4 << 20):
                held += zip(*(piece.column(c).to_pylist() for c in ("part", "guest", "doc_id", "text")))
                if len(held) > 1:
                    yield from answer(held)
                    held = held[-1:]

    def answer(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        pairs = [(a, b) for a, b in zip(held, held[1:]) if not a[1] and a[0] == b[0]]
        if not pairs:
            return
        own = sketches([r[3] for r in held])
        at = {id(r): i for i, r in enumerate(held)}
        changed = [edited(a[3], b[3]) for a, b in pairs]
        out = []
        for (a, b), text, sketch in zip(pairs, changed, sketches(changed)):
            mine = own[at[id(a)]]
            out.append((a[2], len(a[3]), hashlib.sha256(text.encode()).hexdigest(), mine.astype(">u4").tobytes().hex(),
                        sketch.astype(">u4").tobytes().hex(), likeness(mine, sketch), likeness(mine, own[at[id(b)]])))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _SCHEMA)], schema=_SCHEMA)

    return (rows.repartitionById(max(1, parts), "part").sortWithinPartitions("part", "guest", "doc_id", "text")
            .select("part", "guest", "doc_id", "text").mapInArrow(run, FINGERPRINTS))


ANCHORS = "doc_id long, position long, anchor long"


def anchors(docs: DataFrame) -> DataFrame:
    """Every closed syncmer of every text: doc_id, position, anchor hash."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(*(c.to_pylist() for c in batch.columns)):
                at, h = closed_syncmers(np.frombuffer((text or "").encode("utf-32-le"), "<u4"))
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key] * len(at), pa.int64()), pa.array(at), pa.array(h.view(np.int64))],
                        names=["doc_id", "position", "anchor"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ANCHORS)


def offset_votes(a: str, b: str) -> dict[int, int]:
    """Anchors that two texts share, counted by how far apart their places are."""
    (pa_, ha), (pb, hb) = (closed_syncmers(np.frombuffer(t.encode("utf-32-le"), "<u4")) for t in (a, b))
    where: dict[int, list[int]] = {}
    for p, h in zip(pb.tolist(), hb.tolist()):
        where.setdefault(h, []).append(p)
    votes: dict[int, int] = {}
    for p, h in zip(pa_.tolist(), ha.tolist()):
        for q in where.get(h, ()):
            votes[q - p] = votes.get(q - p, 0) + 1
    return votes
