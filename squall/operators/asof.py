"""J2 — nearest as-of join with a tolerance, as a composition of DataFrame ops.

For every left row, pick the right row whose time is nearest to the left time,
if the distance is at most ``tolerance``; equidistant candidates resolve to
the earlier right row; the tolerance is inclusive. There is no equality key.

Plan (linear in the input, no pair enumeration, no single-task step):

1. Right side reduced to one row per right instant (``min_by`` on a
   tie-break order; partial aggregation, so a hot instant collapses map-side).
2. Left side reduced to its distinct instants (the match depends only on the
   instant, so a hot instant costs one row from here on).
3. Approximate quantiles of all instants give balanced, literal segment
   bounds (one small aggregate job; the bound list is as long as the number
   of segments, which is set from the shuffle width, not from the data).
4. Distinct left instants and right rows are unioned, shuffled by segment and
   sorted by time; a running ``last(..., ignorenulls)`` gives the previous
   right row, the same over descending time gives the next one.
5. Rows whose previous/next lies in another segment take it from a carry
   table (last/first right row per segment, one row per segment, broadcast).
6. Pick within tolerance, then equi-join back to the left rows on the instant
   (AQE splits a hot instant on the left side).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from squall.functions.timefn import epoch_micros

_T = "__asof_t"
_SEG = "__asof_seg"
_SIDE = "__asof_side"
_ROW = "__asof_row"
_MATCH = "__asof_match"


# Upper bound on segments: the broadcast carry table has one row per segment.
MAX_SEGMENTS = 100_000

# Broadcast plan (no shuffle of the left side) only when the right side is
# proven small: at most this many right rows (counted) ...
BROADCAST_RIGHT_MAX_ROWS = 250_000
# ... and at most this many right rows within any window of three tolerance
# buckets (counted). Beyond either bound the segment plan runs (also exact).
BROADCAST_MAX_CANDIDATES = 256
# ... and at most this many bytes in the broadcast (every right row stands in
# three windows), measured on the rows' text form.
BROADCAST_MAX_BYTES = 128 * 1024 * 1024
_ROW_OVERHEAD = 64


def default_segments(spark) -> int:
    try:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    except (TypeError, ValueError):
        parts = 200
    return max(1, 2 * parts)


def segment_bounds(times: DataFrame, column: str, segments: int) -> list[float]:
    """Approximate quantile cut points of ``column`` (one aggregate job).

    Returns at most ``segments - 1`` strictly increasing values; the list size
    is bounded by the requested segment count, never by the data.
    """
    if segments <= 1:
        return []
    probs = [i / segments for i in range(1, segments)]
    accuracy = max(10_000, 20 * segments)
    row = times.agg(F.percentile_approx(F.col(column), probs, accuracy).alias("q")).first()
    values = row["q"] if row is not None else None
    return sorted({float(v) for v in (values or []) if v is not None})


def _with_segment(df: DataFrame, bounds: list[float]) -> DataFrame:
    if not bounds:
        return df.withColumn(_SEG, F.lit(0))
    splits = [-math.inf, *bounds, math.inf]
    tmp = _SEG + "_d"
    b = Bucketizer(splits=splits, inputCol=_T + "_d", outputCol=tmp, handleInvalid="keep")
    out = b.transform(df.withColumn(_T + "_d", F.col(_T).cast("double")))
    return out.withColumn(_SEG, F.col(tmp).cast("int")).drop(tmp, _T + "_d")


def asof_nearest(left: DataFrame, right: DataFrame, left_on: str, right_on: str,
                 tolerance_seconds: float, *, right_order: Sequence[str | Column] | None = None,
                 how: str = "inner", segments: int | None = None,
                 right_unique: bool = False, broadcast_right: bool | None = None,
                 windows: DataFrame | None = None) -> DataFrame:
    """Attach to each left row the nearest right row within ``tolerance_seconds``.

    ``left_on`` / ``right_on`` are timestamp (or timestamp_ntz) columns. The
    result has all left columns followed by all right columns. ``how='inner'``
    drops left rows without a match (and with a null time); ``'left'`` keeps
    them with null right columns. Rows of ``right`` sharing one instant are
    reduced to the first by ``right_order`` then by the row's own values;
    ``right_unique=True`` skips that step when the caller already guarantees
    one row per instant; if that promise is broken the row taken at a repeated
    instant is unspecified and may differ between the plans.

    Two exact plans. When the right side is proven small (rows, bytes and
    candidates per tolerance window measured against the ``BROADCAST_*``
    bounds) the candidate windows are broadcast and the left side is never
    shuffled (``_broadcast_plan``); otherwise the segment plan above runs, at
    any size over ``default_segments`` segments. ``broadcast_right`` forces (True) or forbids
    (False) the broadcast plan's attempt; the bounds are always checked.

    Both inputs are read up to three times; pass materialised frames when
    they are expensive to recompute. ``windows`` is what ``candidate_windows``
    gave for this right side and tolerance: joins against one right side then
    neither measure nor group it again.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"rename overlapping columns before the as-of join: {sorted(clash)}")
    spark = left.sparkSession
    tol = int(round(tolerance_seconds * 1_000_000))
    rcols = list(right.columns)
    order = [F.col(c) if isinstance(c, str) else c for c in (right_order or [])]

    if windows is not None:
        return _broadcast_plan(left, left_on, windows, rcols, tol, how)

    # 1. one right row per instant
    r = right.withColumn(_T, epoch_micros(right_on)).where(F.col(_T).isNotNull())
    if right_unique:
        r = r.select(_T, F.struct(*[F.col(c) for c in rcols]).alias(_ROW))
    else:
        # first row per instant by (order, row): one struct carries keys and payload;
        # without an explicit order the row itself is the order
        lead = [F.struct(*order).alias("__o")] if order else []
        keyed = F.min(F.struct(*lead, *[F.col(c) for c in rcols])).alias("__best")
        r = (r.groupBy(_T).agg(keyed)
              .select(_T, F.struct(*[F.col("__best").getField(c).alias(c) for c in rcols]).alias(_ROW)))
    row_type = r.schema[_ROW].dataType

    if broadcast_right is not False:
        windows = _candidate_windows(right, right_on, r, tol)
        if windows is not None:
            return _broadcast_plan(left, left_on, windows, rcols, tol, how)

    # 2. distinct left instants
    lt = left.select(epoch_micros(left_on).alias(_T)).where(F.col(_T).isNotNull())

    # 3. balanced segment bounds over both sides
    times = lt.unionByName(right.select(epoch_micros(right_on).alias(_T)).where(F.col(_T).isNotNull()))
    n = max(1, min(default_segments(spark) if segments is None else segments, MAX_SEGMENTS))
    bounds = segment_bounds(times, _T, n)
    nseg = len(bounds) + 1

    ls = _with_segment(lt.distinct(), bounds).select(
        _T, _SEG, F.lit(0).alias(_SIDE), F.lit(None).cast(row_type).alias(_ROW))
    rs = _with_segment(r, bounds).select(_T, _SEG, F.lit(1).alias(_SIDE), _ROW)

    cand_type = f"struct<t:bigint,r:{row_type.simpleString()}>"
    cand = F.when(F.col(_SIDE) == 1, F.struct(F.col(_T).alias("t"), F.col(_ROW).alias("r")))

    # 4. previous / next right row inside the segment (running frames only: O(n))
    w_prev = (Window.partitionBy(_SEG).orderBy(F.col(_T).asc(), F.col(_SIDE).desc())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    w_next = (Window.partitionBy(_SEG).orderBy(F.col(_T).desc(), F.col(_SIDE).desc())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    u = (ls.unionByName(rs)
         .withColumn("__prev", F.last(cand, ignorenulls=True).over(w_prev))
         .withColumn("__next", F.last(cand, ignorenulls=True).over(w_next))
         .where(F.col(_SIDE) == 0))

    # 5. carry across segments: one row per segment (bounded by nseg)
    # instants are unique on the right, and ``t`` leads the struct, so max/min of
    # the struct are the last/first right row of the segment
    tr = F.struct(F.col(_T).alias("t"), F.col(_ROW).alias("r"))
    per_seg = rs.groupBy(_SEG).agg(F.max(tr).alias("__last"), F.min(tr).alias("__first"))
    seg_ids = spark.range(nseg).select(F.col("id").cast("int").alias(_SEG))
    wc_prev = Window.orderBy(F.col(_SEG).asc()).rowsBetween(Window.unboundedPreceding, -1)
    wc_next = Window.orderBy(F.col(_SEG).desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = (seg_ids.join(per_seg, _SEG, "left")
             .select(_SEG,
                     F.last("__last", ignorenulls=True).over(wc_prev).cast(cand_type).alias("__cprev"),
                     F.last("__first", ignorenulls=True).over(wc_next).cast(cand_type).alias("__cnext")))

    prev = F.coalesce(F.col("__prev"), F.col("__cprev"))
    nxt = F.coalesce(F.col("__next"), F.col("__cnext"))
    dp = F.col(_T) - prev.getField("t")
    dn = nxt.getField("t") - F.col(_T)
    ok_p = prev.isNotNull() & (dp <= F.lit(tol))
    ok_n = nxt.isNotNull() & (dn <= F.lit(tol))
    pick = (F.when(ok_p & (~ok_n | (dp <= dn)), prev.getField("r"))
            .when(ok_n, nxt.getField("r")))
    matches = (u.join(F.broadcast(carry), _SEG, "left")
               .select(F.col(_T), pick.alias(_MATCH))
               .where(F.col(_MATCH).isNotNull()))

    # 6. back to the left rows
    joined = left.withColumn(_T, epoch_micros(left_on)).join(matches, _T, how)
    return joined.select(*[F.col(c) for c in left.columns],
                         *[F.col(_MATCH).getField(c).alias(c) for c in rcols])


def _bucket(t: Column, width: int) -> Column:
    """Exact floor(t / width) on integers (also before 1970)."""
    w = F.lit(width)
    return F.call_function("div", t - F.pmod(t, w), w)


def candidate_windows(right: DataFrame, right_on: str, tolerance_seconds: float) -> DataFrame | None:
    """The broadcast plan's windows over a right side with one row per instant,
    or None when it is not proven small. Materialise them to use them often."""
    tol = int(round(tolerance_seconds * 1_000_000))
    r = (right.withColumn(_T, epoch_micros(right_on)).where(F.col(_T).isNotNull())
         .select(_T, F.struct(*[F.col(c) for c in right.columns]).alias(_ROW)))
    return _candidate_windows(right, right_on, r, tol)


def _candidate_windows(right: DataFrame, right_on: str, r: DataFrame, tol: int) -> DataFrame | None:
    """Window table for the broadcast plan, or None when the right side is not
    provably small. Window ``w`` holds every right row of buckets w-1, w, w+1
    (bucket width = tolerance), which contains all rows within tolerance of
    any instant in bucket ``w``. All bounds are measured before anything is
    collected or broadcast."""
    width = max(tol, 1)
    raw = right.select(epoch_micros(right_on).alias(_T)).where(F.col(_T).isNotNull())
    row_bytes = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in right.columns]))) + _ROW_OVERHEAD
    size = right.where(F.col(right_on).isNotNull()).agg(F.count(F.lit(1)).alias("n"),
                                                        F.sum(row_bytes.cast("long")).alias("b")).first()
    if size["n"] > BROADCAST_RIGHT_MAX_ROWS or 3 * (size["b"] or 0) > BROADCAST_MAX_BYTES:
        return None
    spread = F.explode(F.array(*[_bucket(F.col(_T), width) + F.lit(k) for k in (-1, 0, 1)])).alias("__w")
    widest = raw.select(spread).groupBy("__w").count().agg(F.max("count").alias("m")).first()
    if widest is not None and (widest["m"] or 0) > BROADCAST_MAX_CANDIDATES:
        return None
    cand = F.struct(F.col(_T).alias("t"), F.col(_ROW).alias("r"))
    return (r.select(spread, cand.alias("__c"))
             .groupBy("__w").agg(F.collect_list("__c").alias("__cands")))


def _broadcast_plan(left: DataFrame, left_on: str, windows: DataFrame, rcols: list[str], tol: int,
                    how: str) -> DataFrame:
    """Each left row looks up its bucket's window in the broadcast table and
    takes the smallest (distance, later-than-left, time) candidate within
    tolerance: ties go to the earlier right row. No shuffle of the left side.
    Candidates are compared by twice the distance, plus one if later than left,
    which no two instants share; only the one chosen is read as a row."""
    width = max(tol, 1)
    lt = F.col(_T)
    keyed = left.withColumn(_T, epoch_micros(left_on)).withColumn("__w", _bucket(lt, width))
    joined = keyed.join(F.broadcast(windows), "__w", how)
    rank = F.array_min(F.transform(F.col("__cands.t"), lambda t: F.when(t > lt, 2 * (t - lt) + 1).otherwise(2 * (lt - t))))
    near = F.when(rank <= F.lit(2 * tol + 1), rank)
    # an array of the best rank or of none: scored once per left row
    found = F.filter(F.array(near), lambda x: x.isNotNull())
    rank = F.col("__rank")
    half = F.shiftright(rank, 1)
    at = F.array_position(F.col("__cands.t"), F.when(rank % 2 == 1, lt + half).otherwise(lt - half))
    out = (joined.withColumn("__rank", (F.explode if how == "inner" else F.explode_outer)(found))
           .withColumn(_MATCH, F.element_at(F.col("__cands.r"), F.when(at > 0, at.cast("int")))))
    return out.select(*[F.col(c) for c in left.columns],
                      *[F.col(_MATCH).getField(c).alias(c) for c in rcols])
