"""Exact top-k inner-product search on a pivot-distance index.

Components become floor(1024 * x). A few pivots are drawn from the vectors by
hash; each vector is keyed by its nearest pivot and its distance to it, and the
sorted keys are cut into annuli: blocks of one pivot with a least and a greatest
distance and a greatest norm. For a query q and an annulus around p the triangle
inequality gives d(q, x) >= gap, the distance of d(q, p) from the annulus, so

    <q, x> = (|q|^2 + |x|^2 - d(q, x)^2) / 2 <= (|q|^2 + norm^2 - gap^2) / 2.

A query's own annulus gives a first k-th best score. Groups of queries that are
neighbours in the index are paired with the annuli whose bound reaches it, the
annuli of a group are expanded in falling order of the bound, and a query leaves
the expansion where its bound falls below its k-th best score so far. The search
is exact; the pivots only decide how much work is saved.

Queries against rows is the one product here, taken in blocks: pairs of blocks
are rows, never pairs of vectors.

Edge cases: null vectors and those with null or non-finite components take no
part; shorter vectors are filled up with zeros; ties go to the smaller vec_id
(nulls last); equal vectors are rows of their own; rows that share a vec_id are
told apart by their place, so each is a candidate for the others; with fewer
rows than k all are returned; an empty table gives no row. Scores must fit 64
bits, else the search stops with an error. Other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from squall.llm.common import ship, stage

PIVOTS = 32       # the bounded sample behind the index
BLOCK = 512       # vectors in an annulus
GROUP = 32        # annuli whose queries are searched together
SALTS = 8
SLACK = 1e-9      # relative room for rounding in a bound
_LAST = np.iinfo(np.int64).max


def quantized(vectors: DataFrame) -> DataFrame:
    """vec_id, place and integer components of the vectors that take part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    e = F.col("embedding").cast("array<double>")
    return (vectors.select(F.col("vec_id").cast("long"), e.alias("e"), F.monotonically_increasing_id().alias("place"))
            .where(F.col("e").isNotNull() & F.forall("e", finite))
            .select("vec_id", "place", F.transform("e", lambda x: F.floor(x * 1024)).alias("v")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows filled up with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), np.int64)
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows (int64)."""
    largest = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if largest < 1 << 53:  # doubles hold every sum exactly
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if largest >= 1 << 63:
        raise ValueError("scores do not fit 64 bits")
    return a @ b.T


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    x, p = x.astype(np.float64), pivots.astype(np.float64)
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (p * p).sum(1) - 2 * x @ p.T, 0))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of one query, ties to the smaller id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


# one table for annuli and query groups: ``kind`` is 'annulus' or 'queries'
INDEX = ("kind string, number long, pivot int, low double, high double, norm double, near array<double>, "
         "far array<double>, least double, ids array<long>, places array<long>, floors array<double>, data binary")
_INDEX = pa.schema([("kind", pa.string()), ("number", pa.int64()), ("pivot", pa.int32()), ("low", pa.float64()),
                    ("high", pa.float64()), ("norm", pa.float64()), ("near", pa.list_(pa.float64())),
                    ("far", pa.list_(pa.float64())), ("least", pa.float64()), ("ids", pa.list_(pa.int64())),
                    ("places", pa.list_(pa.int64())), ("floors", pa.list_(pa.float64())), ("data", pa.binary())])


def _ids(values: list) -> np.ndarray:
    return np.array([_LAST if v is None else v for v in values], np.int64)


def build(rows: DataFrame, pivots: np.ndarray, k: int, every: int) -> DataFrame:
    """The staged index of ``rows`` (vec_id, place, v)."""
    width = pivots.shape[1]

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = _distances(_matrix(batch.column("v"), width), pivots)
            near = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near]), *batch.columns],
                names=["pivot", "distance", *batch.schema.names])

    keyed = rows.mapInArrow(key, "pivot int, distance double, vec_id long, place long, v array<long>")

    def annulus(number: int, part: list) -> tuple[dict, dict | None]:
        pivot, distance, ids, places, v = (np.concatenate(x) for x in zip(*part))
        row = {"kind": "annulus", "number": number, "pivot": int(pivot[0]), "low": distance[0], "high": distance[-1],
               "norm": float(np.sqrt((v.astype(float) ** 2).sum(1).max())), "ids": _named(ids), "places": places,
               "data": v.astype("<i8").tobytes()}
        asks = (ids != _LAST) & (ids % every == 0)
        if not asks.any():
            return row, None
        own = products(v[asks], v).astype(np.float64)
        own[np.arange(len(own)), np.flatnonzero(asks)] = -np.inf
        floors = np.sort(own, axis=1)[:, -k] if len(v) > k else np.full(len(own), -np.inf)
        d = _distances(v[asks], pivots)
        return row, {"near": d, "floors": floors, "ids": ids[asks], "places": places[asks], "v": v[asks]}

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        number, held, n, groups = first, [], 0, []

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal number, held, n
            row, queries = annulus(number, held)
            number, held, n = number + 1, [], 0
            if queries:
                groups.append(queries)
            yield pa.RecordBatch.from_pylist([row], schema=_INDEX)

        def grouped() -> Iterator[pa.RecordBatch]:
            nonlocal groups
            if groups:
                q = {c: np.concatenate([g[c] for g in groups]) for c in groups[0]}
                groups = []
                yield pa.RecordBatch.from_pylist([{
                    "kind": "queries", "number": number, "norm": float(np.sqrt((q["v"].astype(float) ** 2).sum(1).max())),
                    "near": q["near"].min(0), "far": q["near"].max(0), "least": q["floors"].min(), "ids": q["ids"],
                    "places": q["places"], "floors": q["floors"], "data": q["v"].astype("<i8").tobytes()}], schema=_INDEX)

        for batch in batches:
            pivot, distance = batch.column("pivot").to_numpy(), batch.column("distance").to_numpy()
            ids, places = _ids(batch.column("vec_id").to_pylist()), batch.column("place").to_numpy()
            v = _matrix(batch.column("v"), width)
            at = 0
            while at < len(ids):
                if held and held[0][0][0] != pivot[at]:
                    yield from close()
                same = int(np.searchsorted(pivot[at:], pivot[at], "right"))
                end = at + min(same, BLOCK - n)
                held.append(tuple(x[at:end] for x in (pivot, distance, ids, places, v)))
                n, at = n + end - at, end
                if n == BLOCK:
                    yield from close()
                if len(groups) >= GROUP:
                    yield from grouped()
        if held:
            yield from close()
        yield from grouped()

    return stage(keyed.repartitionByRange("pivot", "distance", "place").sortWithinPartitions("pivot", "distance", "place")
                 .mapInArrow(pack, INDEX), "pivot-index")


def _named(ids: np.ndarray) -> list:
    return [None if i == _LAST else int(i) for i in ids]


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, pivots: int = PIVOTS) -> DataFrame:
    """The k best rows for each query (vec_id divisible by ``every``):
    query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    ship(spark)
    rows = stage(quantized(vectors), "pivot-rows")
    width = max(1, rows.agg(F.max(F.size("v"))).first()[0] or 0)
    chosen = rows.orderBy(F.xxhash64("vec_id", "place"), "place").limit(pivots).select("v").collect()
    points = np.zeros((max(1, len(chosen)), width), np.int64)
    for i, r in enumerate(chosen):
        points[i, :len(r["v"])] = r["v"]
    index = build(rows, points, k, every)

    q = index.where("kind = 'queries'").select(F.col("number").alias("group"), F.col("norm").alias("q_norm"), "near", "far",
                                               "least")
    a = index.where("kind = 'annulus'").select(F.col("number").alias("annulus"), "pivot", "low", "high", "norm")
    at = F.col("pivot") + 1
    gap = F.greatest(F.lit(0.0), F.col("low") - F.element_at("far", at), F.element_at("near", at) - F.col("high"))
    bound = (F.col("q_norm") ** 2 + F.col("norm") ** 2 - gap ** 2) / 2
    slack = (F.col("q_norm") ** 2 + F.col("norm") ** 2) * SLACK
    # numbers and bounds only; blocks of queries against blocks of rows
    pairs = stage(q.crossJoin(a).withColumn("bound", bound + slack).where(F.col("bound") >= F.col("least"))
                  .select("group", "annulus", "bound", F.pmod(F.xxhash64("annulus"), F.lit(SALTS)).alias("salt")), "pivot-pairs")

    asked = index.where("kind = 'queries'").select(F.col("number").alias("group"), F.col("ids").alias("q_ids"),
                                                   F.col("places").alias("q_places"), "floors", F.col("data").alias("q_data"))
    held = index.where("kind = 'annulus'").select(F.col("number").alias("annulus"), "pivot", "low", "high", "norm", "ids",
                                                  "places", "data")
    work = pairs.join(held, "annulus").join(asked, "group")

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if state is None or state.key != (r["group"], r["salt"]):
                    if state is not None:
                        yield from state.result()
                    state = Expansion((r["group"], r["salt"]), r, points, k)
                state.visit(r)
        if state is not None:
            yield from state.result()

    # group and salt by number: an expansion is one run of rows
    found = (work.repartition("group", "salt").sortWithinPartitions("group", "salt", F.desc("bound"))
             .mapInArrow(expand, "query_id long, query_place long, vec_id long, score long"))
    order = Window.partitionBy("query_place").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


class Expansion:
    """The best rows so far of one group of queries."""

    def __init__(self, key: tuple, r: dict, pivots: np.ndarray, k: int) -> None:
        self.key, self.k = key, k
        self.ids, self.places = np.array(r["q_ids"], np.int64), np.array(r["q_places"], np.int64)
        self.v = np.frombuffer(r["q_data"], "<i8").reshape(len(self.ids), -1)
        self.floors = np.array(r["floors"], np.float64)
        self.squares = (self.v.astype(float) ** 2).sum(1)
        self.distances = _distances(self.v, pivots)
        self.found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in self.ids]

    def visit(self, r: dict) -> None:
        d = self.distances[:, r["pivot"]]
        gap = np.maximum(0, np.maximum(r["low"] - d, d - r["high"]))
        whole = self.squares + r["norm"] ** 2
        open_ = np.flatnonzero((whole - gap ** 2) / 2 + whole * SLACK >= self.floors)
        if not len(open_):
            return
        ids, places = _ids(r["ids"]), np.array(r["places"], np.int64)
        scores = products(self.v[open_], np.frombuffer(r["data"], "<i8").reshape(len(ids), -1))
        for q, s in zip(open_, scores):
            ok = (s >= self.floors[q]) & (places != self.places[q])
            if ok.any():
                s = np.concatenate([self.found[q][0], s[ok]])
                i = np.concatenate([self.found[q][1], ids[ok]])
                at = best(s, i, self.k)
                self.found[q] = s[at], i[at]
                if len(at) == self.k:
                    self.floors[q] = max(self.floors[q], s[at[-1]])

    def result(self) -> Iterator[pa.RecordBatch]:
        n = [len(s) for s, _ in self.found]
        if sum(n):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(self.ids, n)), pa.array(np.repeat(self.places, n)),
                 pa.array(_named(np.concatenate([i for _, i in self.found])), pa.int64()),
                 pa.array(np.concatenate([s for s, _ in self.found]))],
                names=["query_id", "query_place", "vec_id", "score"])


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
