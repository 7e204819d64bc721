"""SimHash near-duplicate groups by pigeonring filtering.

A fingerprint has a bit set where over half the shingle hashes have it. Two
documents link when their fingerprints differ in at most ``max_bits`` bits, and
a component is everything reachable over links.

The 64 bits are a ring of ``max_bits + 1`` segments. If two fingerprints link,
there is a segment from which every run of consecutive segments (of length l)
holds at most ``l * max_bits / segments`` differences: none in the first, one in
the first two, two in the first three and so on. A pair is a candidate only
where that chain holds. The index key carries the first segment whole and one
half of the second (one of its halves must agree as well), so equal keys find
each linked pair at the segment where its chain starts; the rest of the chain is
checked before the full Hamming distance.

Equal fingerprints are one row throughout. Keys with many different fingerprints
are refined: of the bits outside the key one of ``max_bits + 1`` blocks must
agree too, so each such key splits into finer ones until they are small or no
bits are left to add; no link is lost. Within a key only a spanning forest of
the links is emitted, so rows stay linear in the size of a group.

Edge cases: null and empty texts have fingerprint zero and link like any other;
fewer words than a shingle give one shingle of all words; repeated rows share a
component; a component whose doc_ids are all null has a null component_id; an
empty table gives no row. Other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from squall.llm.common import placed, ship, stage
from squall.llm.components import connected

BITS = 64
HOT_KEY = 512          # different fingerprints under one key before it is refined
REFINEMENTS = 3
CHUNK = 1 << 16        # shingles counted at once
BROADCAST_KEYS = 50_000


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of a whole text: ASCII lower case, words between ASCII white
    space, repeated shingles counted each time."""
    from xxhash import xxh64_intdigest
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, CHUNK):
        run = words[at:at + CHUNK + shingle - 1]
        joined = map(b" ".join, zip(*(run[i:] for i in range(shingle)))) if len(run) >= shingle else [b" ".join(run)]
        h = np.fromiter(map(partial(xxh64_intdigest, seed=seed), joined), np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """``row`` (the place of the document in its table), doc_id and the
    fingerprint as a signed long."""
    ship(docs.sparkSession)
    docs, place = placed(docs)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle, seed) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), pa.array(fps.view(np.int64))],
                                             names=["row", "doc_id", "fp"])

    return (docs.select(place.alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
           .mapInArrow(of, "row long, doc_id long, fp long"))


def segments(max_bits: int) -> list[int]:
    """Masks of the ring's segments."""
    edges = [BITS * i // (max_bits + 1) for i in range(max_bits + 2)]
    return [_mask(range(a, b)) for a, b in zip(edges, edges[1:])]


def _mask(bits) -> int:
    return sum(1 << b for b in bits)


def _bits(mask: int) -> list[int]:
    return [b for b in range(BITS) if mask >> b & 1]


def key_masks(max_bits: int) -> list[tuple[int, int]]:
    """(segment at which the chain starts, mask of the key's bits)."""
    ring = segments(max_bits)
    if max_bits == 0:
        return [(0, ring[0])]
    out = []
    for i, first in enumerate(ring):
        second = _bits(ring[(i + 1) % len(ring)])
        half = len(second) // 2
        out += [(i, first | _mask(second[:half])), (i, first | _mask(second[half:]))]
    return out


def refined(mask: int, max_bits: int) -> list[int]:
    """Masks that add to a key each of ``max_bits + 1`` blocks of its other bits."""
    rest = _bits(~mask & (1 << BITS) - 1)
    n = max_bits + 1
    if len(rest) <= 2 * n:
        return [mask]
    return [mask | _mask(rest[len(rest) * i // n:len(rest) * (i + 1) // n]) for i in range(n)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def chain(differences: np.ndarray, start: int, max_bits: int) -> np.ndarray:
    """Where the pigeonring condition holds from ``start``, prefix by prefix;
    the last prefix is the whole ring, that is the full Hamming check."""
    ring = segments(max_bits)
    ok = np.ones(len(differences), bool)
    seen = 0
    for length in range(1, len(ring) + 1):
        seen |= ring[(start + length - 1) % len(ring)]
        budget = length * max_bits // len(ring)
        ok[ok] = np.bitwise_count(differences[ok] & np.uint64(seen)) <= budget
    return ok


def forest(fps: np.ndarray, start: int, max_bits: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among fingerprints that share a key."""
    edges = []
    waiting = fps
    while len(waiting) > 1:
        front, waiting = [waiting[0]], waiting[1:]
        while front and len(waiting):
            x = front.pop()
            ok = chain(waiting ^ x, start, max_bits)
            if ok.any():
                near = waiting[ok]
                edges += [(int(x), int(y)) for y in near]
                front += list(near)
                waiting = waiting[~ok]
    return edges


def links(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """Links (a, b) between different fingerprints: a spanning forest for each
    index key. ``fps`` has one column ``fp`` of distinct signed longs."""
    ship(fps.sparkSession)
    masks = key_masks(max_bits)
    rows = _keyed(fps, masks)
    found = []
    for level in range(REFINEMENTS + 1):
        hot = None
        if level < REFINEMENTS and max_bits:
            hot = stage(rows.groupBy("start", "mask", "value").count().where(F.col("count") > HOT_KEY)
                        .drop("count"), "simhash-hot")
            n = hot.count()
            if not n:
                hot = None
        key = ["start", "mask", "value"]
        cold = rows
        if hot is not None:
            side = F.broadcast(hot) if n <= BROADCAST_KEYS else hot
            cold = rows.join(side, key, "left_anti")
        found.append(_within(cold, max_bits))
        if hot is None:
            break
        children = {(i, m): refined(m, max_bits) for i, m in masks}
        rows = _finer(rows.join(side, key, "left_semi"), children)
        masks = [(i, f) for (i, _), finer in children.items() for f in finer]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _keyed(fps: DataFrame, masks: list[tuple[int, int]]) -> DataFrame:
    keys = F.array(*(F.struct(F.lit(i).alias("start"), F.lit(_signed(m)).cast("long").alias("mask"))
                     for i, m in masks))
    return (fps.select("fp", F.explode(keys).alias("k"))
            .select(F.col("k.start").alias("start"), F.col("k.mask").alias("mask"),
                    F.col("fp").bitwiseAND(F.col("k.mask")).alias("value"), "fp"))


def _finer(rows: DataFrame, children: dict[tuple[int, int], list[int]]) -> DataFrame:
    table = rows.sparkSession.createDataFrame(
        [(i, _signed(m), _signed(f)) for (i, m), fs in children.items() for f in fs],
        "start int, mask long, finer long")  # some hundred rows: masks, not data
    return (rows.join(F.broadcast(table), ["start", "mask"])
            .select("start", F.col("finer").alias("mask"), F.col("fp").bitwiseAND(F.col("finer")).alias("value"), "fp"))


def _within(rows: DataFrame, max_bits: int) -> DataFrame:
    """Compare the fingerprints under each key."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # rows of the last key so far; it may go on in the next batch
        for batch in (b for b in batches if b.num_rows):
            start, mask, value, fp = (c.to_numpy() for c in batch.columns)
            if rest is not None:
                start, mask, value, fp = (np.concatenate(x) for x in zip(rest, (start, mask, value, fp)))
            edge = (start[1:] != start[:-1]) | (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])
            first = np.concatenate([[0], np.flatnonzero(edge) + 1])
            last = first[-1]
            yield from _compared(start[:last], fp[:last], first[:-1], last, max_bits)
            rest = tuple(x[last:] for x in (start, mask, value, fp))
        if rest is not None:
            yield from _compared(rest[0], rest[3], np.array([0]), len(rest[3]), max_bits)

    return (rows.select("start", "mask", "value", "fp").repartition("start", "mask", "value")
            .sortWithinPartitions("start", "mask", "value").mapInArrow(compare, "a long, b long"))


def _compared(start: np.ndarray, fp: np.ndarray, first: np.ndarray, end: int,
              max_bits: int) -> Iterator[pa.RecordBatch]:
    fps = fp.view(np.uint64)
    sizes = np.diff(first, append=end)
    a, b = [], []
    two = first[sizes == 2]
    for i in np.unique(start[two]):  # keys with two fingerprints, all at once
        at = two[start[two] == i]
        ok = chain(fps[at] ^ fps[at + 1], int(i), max_bits)
        a.append(fps[at[ok]])
        b.append(fps[at[ok] + 1])
    edges = []
    for at, n in zip(first[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        edges += forest(fps[at:at + n], int(start[at]), max_bits)
    if edges:
        both = np.array(edges, np.uint64)
        a.append(both[:, 0])
        b.append(both[:, 1])
    if a and sum(map(len, a)):
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)],
                                         names=["a", "b"])


def near_duplicates(docs: DataFrame, max_bits: int = 3, shingle: int = 3, seed: int = 42) -> DataFrame:
    """One row per document: row, doc_id, fp, fingerprint as 16 hex digits, class
    label and component_id (smallest doc_id reachable)."""
    marked = stage(fingerprints(docs, shingle, seed), "simhash-fp")
    distinct = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    label = connected(links(distinct.select("fp"), max_bits))
    named = distinct.join(label.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "label", F.coalesce("label", "fp"))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    classes = stage(named.select("fp", "label").join(least, "label"), "simhash-classes")
    return (marked.join(classes, "fp")
            .withColumn("fingerprint", F.lower(F.lpad(F.hex("fp"), BITS // 4, "0"))))


def deduplicate(docs: DataFrame, max_bits: int = 3, shingle: int = 3, seed: int = 42) -> DataFrame:
    """Keep of each component the document with the smallest doc_id (nulls
    last; of repeated rows one)."""
    docs, place = placed(docs)
    marked = near_duplicates(docs, max_bits, shingle, seed)
    kept = marked.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row"))
                                       .alias("m")).select(F.col("m.row").alias("kept_row"), F.col("m.doc_id").alias("kept_id"))
    names = docs.columns  # any names may come in
    rows = docs.select(*(F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)), place.alias("kept_row"),
                       F.col("doc_id").cast("long").alias("own_id"))
    rows = rows.join(kept, (rows["kept_row"] == kept["kept_row"]) & F.col("own_id").eqNullSafe(F.col("kept_id")), "left_semi")
    return rows.select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names)))
