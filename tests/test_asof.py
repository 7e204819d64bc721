"""J2 nearest as-of join: exact semantics and a brute-force property check."""

import datetime as dt
import random

from squall.operators.asof import asof_nearest

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def at(**kw):
    return T0 + dt.timedelta(**kw)


def run(spark, left, right, tol=7200, **kw):
    """Both plans (broadcast windows and segments) must give the same answer."""
    l = spark.createDataFrame(left, "lid int, t timestamp")
    r = spark.createDataFrame(right, "rid int, rt timestamp")
    segs = kw.pop("segments", 3)
    seg = asof_nearest(l, r, "t", "rt", tol, segments=segs, broadcast_right=False, **kw)
    bc = asof_nearest(l, r, "t", "rt", tol, segments=segs, broadcast_right=True, **kw)
    got = {row.lid: row.rid for row in seg.collect()}
    assert {row.lid: row.rid for row in bc.collect()} == got
    return got


def test_tolerance_is_inclusive(spark):
    got = run(spark, [(1, T0), (2, at(hours=10))], [(10, at(hours=2)), (11, at(hours=12, seconds=1))])
    assert got == {1: 10}


def test_two_hours_one_second_misses(spark):
    assert run(spark, [(1, T0)], [(10, at(hours=2, seconds=1)), (11, at(hours=-2, seconds=-1))]) == {}


def test_equidistant_takes_earlier(spark):
    assert run(spark, [(1, T0)], [(10, at(minutes=30)), (11, at(minutes=-30))]) == {1: 11}


def test_exact_match_wins(spark):
    assert run(spark, [(1, T0)], [(10, T0), (11, at(seconds=1))]) == {1: 10}


def test_duplicate_right_instant_uses_order(spark):
    l = spark.createDataFrame([(1, T0)], "lid int, t timestamp")
    r = spark.createDataFrame([(10, T0, 2), (11, T0, 1)], "rid int, rt timestamp, pri int")
    out = asof_nearest(l, r, "t", "rt", 60, right_order=["pri"]).collect()
    assert [(x.lid, x.rid) for x in out] == [(1, 11)]


def test_left_keeps_unmatched_and_null_times(spark):
    l = spark.createDataFrame([(1, T0), (2, None), (3, at(days=3))], "lid int, t timestamp")
    r = spark.createDataFrame([(10, T0)], "rid int, rt timestamp")
    out = {x.lid: x.rid for x in asof_nearest(l, r, "t", "rt", 60, how="left").collect()}
    assert out == {1: 10, 2: None, 3: None}


def test_empty_sides(spark):
    assert run(spark, [(1, T0)], []) == {}
    assert run(spark, [], [(10, T0)]) == {}


def test_duplicate_left_instants_all_matched(spark):
    left = [(i, T0) for i in range(50)]
    assert run(spark, left, [(10, at(minutes=1))]) == {i: 10 for i in range(50)}


def brute(left, right, tol):
    exp = {}
    for lid, lt in left:
        if lt is None:
            continue
        best = None
        for rid, rt in right:
            if rt is None:
                continue
            d = abs((lt - rt).total_seconds())
            if d > tol:
                continue
            k = (d, rt > lt, rt, rid)
            if best is None or k < best[0]:
                best = (k, rid)
        if best:
            exp[lid] = best[1]
    return exp


def test_matches_brute_force_on_random_inputs(spark):
    rnd = random.Random(11)
    base = dt.datetime(1969, 12, 31, 18, 0, 0)  # crosses 1970
    for trial in range(4):
        span = rnd.choice([120, 600, 3000])
        left = [(i, base + dt.timedelta(minutes=rnd.randint(0, span))) for i in range(rnd.randint(50, 250))]
        left += [(9000 + i, None) for i in range(3)]
        right = []
        for j in range(rnd.randint(1, 60)):
            right.append((j, base + dt.timedelta(minutes=rnd.randint(0, span))))
        # unique right instants (duplicates resolved by id, tested separately)
        seen, uniq = set(), []
        for rid, rt in sorted(right, key=lambda x: x[0]):
            if rt not in seen:
                seen.add(rt)
                uniq.append((rid, rt))
        tol = rnd.choice([60, 900, 7200])
        got = run(spark, left, uniq, tol, segments=rnd.choice([1, 2, 7]))
        assert got == brute(left, uniq, tol), f"trial {trial}"


def test_hot_instant_and_segment_count_do_not_change_results(spark):
    from pyspark.sql import functions as F
    n = 200_000
    base = F.lit(1_700_000_000_000_000)
    # a third of the left rows share one instant; the rest spread over ~2 days
    left = spark.range(n).select(
        F.col("id").alias("lid"),
        F.timestamp_micros(F.when(F.col("id") % 3 == 0, base)
                           .otherwise(base + (F.col("id") * 7919 % 172_800) * 1_000_000)).alias("t"))
    right = spark.range(20_000).select(
        F.col("id").alias("rid"),
        F.timestamp_micros(base + F.col("id") * 8_640_000 - 3_600_000_000).alias("rt"))
    one = asof_nearest(left, right, "t", "rt", 300, segments=1, broadcast_right=False)
    many = asof_nearest(left, right, "t", "rt", 300, segments=16, broadcast_right=False)
    bc = asof_nearest(left, right, "t", "rt", 300)
    assert one.count() == many.count() == bc.count() > n // 3
    assert one.exceptAll(many).count() == 0
    assert one.exceptAll(bc).count() == 0


def test_zero_tolerance_is_exact_match(spark):
    got = run(spark, [(1, T0), (2, at(seconds=1))], [(10, T0), (11, at(seconds=3))], tol=0)
    assert got == {1: 10}


def test_broadcast_plan_ranks_candidates_without_their_rows(spark):
    """Candidates are compared as numbers; ties, ends of the tolerance and instants before 1970 as before."""
    import datetime as dt
    at = lambda us: dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=us)
    left = [(i, at(us)) for i, us in enumerate([-10, -5, 0, 5, 10, 13, 17, 18, 40])] + [(9, None)]
    l_df = spark.createDataFrame(left, "i int, l timestamp_ntz")
    r_df = spark.createDataFrame([(at(us), f"r{us}") for us in (-15, 0, 10, 24)], "r timestamp_ntz, v string")
    out = asof_nearest(l_df, r_df, "l", "r", 7e-6, how="left")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "late" not in plan and "BroadcastHint" not in plan
    assert {r.i: r.v for r in out.collect()} == {0: "r-15", 1: "r0", 2: "r0", 3: "r0", 4: "r10", 5: "r10", 6: "r10", 7: "r24", 8: None, 9: None}
