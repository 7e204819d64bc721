"""Mixing sources to target weights by a splitting tree over block quotas.

Every source is cut into ``BLOCKS`` hashed blocks of whole documents. A source's
target decides how often each of its blocks is drawn: the whole source as often
as it fits, then the permuted blocks one by one, each that still fits in what is
left. Then one exchange, if any comes nearer to the target than what is left: an
undrawn block goes in, for a drawn block or for none. These draws are its block
quota.

The output shards get their part of the quotas by a tree: a node holds a number
of draws of each source and hands to its left half an exact share of all of
them, taken without order or replacement, so the counts by source follow the
multivariate hypergeometric law; the right half keeps the others. At the leaves
every shard has an exact quota by source. The drawn blocks of a source, in an
order of their own, are then dealt out by these quotas, so shards hold disjoint
draws, and each shard is shuffled by itself. What a document contributes is the
sum over the shards that its block was dealt to.

The plan is a table of ``BLOCKS`` rows per source however many documents there
are; documents only meet it in one join on (source, block), which spreads a
source over all its blocks. Everything is DataFrame work on seeded MD5 values,
so reruns agree.

Edge cases: a null text has size 0; a null source is a source of its own, the
last one; a source of size 0 has target 0; null doc_ids and repeated rows share
the block of their doc_id and are drawn together; an empty table gives no row;
columns of the input may have any names.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window, functions as F

from squall.llm.common import WORD, release, stage

BLOCKS = 1024
SHARDS = 8
PART = 3    # leading hex digits of a ticket's hash that rank it among the parts of its node
WEIGHTS = (3, 1, 2)
SHARE = 1.5    # of all sizes
MOST = 2       # times a source's size
SEED = "mix-1"


def _md5(*parts: Column | str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(SEED), *(F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit(""))
                                                 for p in parts)))


def block_of(doc_id: Column) -> Column:
    return F.pmod(F.conv(F.substring(_md5("block", doc_id), 1, 15), 16, 10).cast("long"), F.lit(BLOCKS)).cast("int")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words) and block of every document."""
    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"),
                       F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       block_of(F.col("doc_id")).alias("block"))


def targets(blocks: DataFrame) -> DataFrame:
    """Size and target of each source. One row per source passes these windows.

    With sources in the order of (greatest target / weight), the first ones stop
    at their greatest target; from the first that does not, all share what is
    left by weight. That share per weight is the largest among those which each
    place in the order would give."""
    order = Window.orderBy(F.col("source").isNull(), "source")
    sums = blocks.groupBy("source").agg(F.sum("words").alias("source_size"))
    index = F.row_number().over(order) - 1
    sums = sums.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)),
                                                  F.pmod(index, F.lit(len(WEIGHTS))).cast("int") + 1).cast("double"))
    sums = sums.withColumn("limit", F.col("source_size") * F.lit(float(MOST)))
    rank = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source")
    everything = Window.partitionBy()
    sums = (sums.withColumn("all", F.sum("source_size").over(everything) * F.lit(SHARE))
            .withColumn("rest", F.col("all") - F.sum("limit").over(rank) + F.col("limit"))
            .withColumn("open", F.sum("weight").over(everything) - F.sum("weight").over(rank) + F.col("weight"))
            .withColumn("level", F.col("rest") / F.col("open")))
    sums = sums.withColumn("level", F.max("level").over(everything))
    return sums.select("source", "source_size", F.least("limit", F.coalesce(F.col("level") * F.col("weight"), "limit"))
                       .alias("target"))


def draws(blocks: DataFrame, sources: DataFrame) -> DataFrame:
    """Block draws (source, block, copy, draw): ``draw`` numbers the draws of a
    source in permuted order. ``blocks`` has (source, block, words).

    The blocks of a source, at most ``BLOCKS``, are one array, in permuted order;
    a fold takes each that fits, so no undrawn block fits in what is left."""
    size, target = F.col("source_size"), F.col("target")
    b = blocks.join(sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    b = b.withColumn("times", F.when(size > 0, F.floor(target / size)).otherwise(0).cast("int"))
    # nothing fits where the source is drawn as often as it may be
    b = (b.withColumn("rest", F.when(F.col("times") < MOST, target - F.col("times") * size).otherwise(-1.0))
         .groupBy("source").agg(F.first("times").alias("times"), F.first("rest").alias("rest"), F.array_sort(F.collect_list(
             F.struct(_md5("order", F.col("source"), F.col("block")).alias("key"), "block", "words"))).alias("ordered")))
    nothing = F.struct(F.col("rest").alias("rest"), F.array().cast("array<int>").alias("taken"))

    def take(state: Column, x: Column) -> Column:
        return F.when(x["words"] <= state["rest"],
                      F.struct((state["rest"] - x["words"]).alias("rest"),
                               F.concat(state["taken"], F.array(x["block"])).alias("taken"))).otherwise(state)

    b = b.withColumn("fold", F.aggregate("ordered", nothing, take))
    no_block = F.struct(F.lit("").alias("key"), F.lit(-1).alias("block"), F.lit(0).cast("long").alias("words"))
    b = b.select("source", "times", F.col("fold.rest").alias("rest"), F.col("fold.taken").alias("taken"),
                 F.explode(F.concat("ordered", F.array(no_block))).alias("x")).select("source", "times", "rest", "taken", "x.*")
    b = b.withColumn("drawn", (F.col("block") == -1) | F.array_contains("taken", F.col("block"))).drop("taken")
    b = _exchanged(b)
    copies = F.col("times") + F.col("extra")
    drawn = (b.where((F.col("block") >= 0) & (copies > 0))
             .select("source", "block", F.explode(F.sequence(F.lit(1), copies)).alias("copy")))
    order = Window.partitionBy("source").orderBy(_md5("draw", F.col("source"), F.col("block"), F.col("copy")), "block", "copy")
    return drawn.withColumn("draw", F.row_number().over(order))


def _exchanged(b: DataFrame) -> DataFrame:
    """``extra``: 1 for the drawn blocks after at most one exchange per source.

    An undrawn block of ``w`` words in place of a drawn one of ``v`` changes what is
    left by ``w - v``; the best partner of each undrawn block is its neighbour in the
    order of (undrawn: words, drawn: words + rest). Block -1, of no words, counts as
    drawn, so a block may also go in for none."""
    value = F.when(F.col("drawn"), F.col("words") + F.col("rest")).otherwise(F.col("words").cast("double"))
    b = b.withColumn("value", value)
    source = Window.partitionBy("source")
    along = source.orderBy("value", F.col("drawn").desc(), "key", "block")
    partner = F.when(F.col("drawn"), F.struct("value", "block"))
    b = (b.withColumn("below", F.last(partner, True).over(along.rowsBetween(Window.unboundedPreceding, 0)))
         .withColumn("above", F.first(partner, True).over(along.rowsBetween(0, Window.unboundedFollowing))))
    down, up = F.col("value") - F.col("below.value"), F.col("above.value") - F.col("value")
    b = (b.withColumn("miss", F.least(down, up))
         .withColumn("other", F.when(up.isNull() | (down <= up), F.col("below.block")).otherwise(F.col("above.block"))))
    best = F.min(F.when(~F.col("drawn") & (F.col("miss") < F.col("rest")), F.struct("miss", "key", "block", "other")))
    b = b.withColumn("best", best.over(source))
    extra = (F.when(F.col("block") == F.col("best.block"), 1).when(F.col("block") == F.col("best.other"), 0)
             .otherwise(F.col("drawn").cast("int")))
    return b.withColumn("extra", extra)


def shard_quotas(quotas: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Split quotas (source, quota) among shards: (shard, source, quota).

    A quota is unfolded into tickets. A node with ``n`` tickets for ``k`` shards
    gives the share of its left half of them to the left, in hash order. A ticket's
    place in its node is the number of tickets in earlier parts, by the first digits
    of the hash, plus its place in its own part, so no task orders a whole node."""
    t = quotas.select("source", F.explode(F.sequence(F.lit(1), F.col("quota").cast("int"))).alias("ticket"))
    t = t.withColumn("low", F.lit(0)).withColumn("high", F.lit(shards))
    spark = quotas.sparkSession
    before = None
    for level in range(max(0, (shards - 1).bit_length())):
        t = t.withColumn("hash", _md5(f"tree{level}", F.col("source"), F.col("ticket")))
        t = stage(t.withColumn("part", F.substring("hash", 1, PART)), "mix-tickets")
        if before is not None:
            release(spark, before)
        before = t
        node = Window.partitionBy("low", "high")
        counts = t.groupBy("low", "high", "part").agg(F.count("*").alias("n"))
        counts = counts.select("low", "high", "part", (F.sum("n").over(node.orderBy("part")) - F.col("n")).alias("earlier"),
                               F.sum("n").over(node).alias("tickets"))
        t = t.join(counts, ["low", "high", "part"])
        inside = F.row_number().over(Window.partitionBy("low", "high", "part").orderBy("hash", "source", "ticket"))
        place = F.col("earlier") + inside
        middle = F.floor((F.col("low") + F.col("high") + 1) / 2).cast("int")
        left = place <= F.round(F.col("tickets") * (middle - F.col("low")) / (F.col("high") - F.col("low")))
        t = t.withColumn("middle", middle).withColumn("left", left | (F.col("high") - F.col("low") == 1))
        t = t.select("source", "ticket", F.when(F.col("left"), F.col("low")).otherwise(F.col("middle")).alias("low"),
                     F.when(F.col("left"), F.least("middle", "high")).otherwise(F.col("high")).alias("high"))
    return t.groupBy(F.col("low").alias("shard"), "source").agg(F.count("*").alias("quota"))


def plan(docs: DataFrame, shards: int = SHARDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sized documents, sources with targets, and the draws of every shard
    (source, block, copy, shard)."""
    rows = stage(sized(docs), "mix-sized")
    blocks = stage(rows.groupBy("source", "block").agg(F.sum("size").alias("words")), "mix-blocks")
    sources = stage(targets(blocks), "mix-sources")
    drawn = stage(draws(blocks, sources), "mix-draws")
    quotas = shard_quotas(drawn.groupBy("source").agg(F.count("*").alias("quota")), shards)
    upto = F.sum("quota").over(Window.partitionBy("source").orderBy("shard"))
    ranges = quotas.select(F.col("source").alias("s"), "shard", upto.alias("last"), (upto - F.col("quota") + 1).alias("first"))
    dealt = drawn.join(ranges, F.col("source").eqNullSafe(F.col("s")) & F.col("draw").between(F.col("first"), F.col("last")))
    return rows, sources, dealt.select("source", "block", "copy", "shard")


def mixed_sizes(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken and
    shard_copies, how often each shard holds it (numbers joined by commas)."""
    rows, sources, dealt = plan(docs, shards)
    per_shard = [F.sum(F.when(F.col("shard") == i, 1).otherwise(0)).alias(f"n{i}") for i in range(shards)]
    names = [f"n{i}" for i in range(shards)]
    copies = dealt.groupBy(F.col("source").alias("cs"), F.col("block").alias("cb")).agg(*per_shard)
    per_source = sources.select(F.col("source").alias("s"), "source_size", "target")
    out = rows.join(copies, F.col("source").eqNullSafe(F.col("cs")) & (F.col("block") == F.col("cb")), "left").na.fill(0, names)
    out = out.join(per_source, F.col("source").eqNullSafe(F.col("s")))
    held = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * held).alias("taken"),
                      F.concat_ws(",", *names).alias("shard_copies"))


def mix(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The mixture itself: each drawn copy of a document is a row with all its
    columns, shard by shard and shuffled within each."""
    _, _, dealt = plan(docs, shards)
    names = docs.columns
    inner = docs.toDF(*(f"c{i}" for i in range(len(names))))  # any names may come in
    at = {n: F.col(f"c{i}") for i, n in enumerate(names)}
    inner = inner.withColumn("block", block_of(at["doc_id"].cast("long")))
    drawn = dealt.select(F.col("source").alias("s"), F.col("block").alias("b"), "copy", "shard")
    rows = inner.join(drawn, at["source"].cast("string").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
    rows = rows.withColumn("key", _md5("shuffle", F.col("shard"), at["source"], at["doc_id"], F.col("copy")))
    rows = rows.repartitionByRange("shard", "key").sortWithinPartitions("shard", "key")
    return rows.select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names)))


def _tree() -> str:
    """The splitting tree level by level, tickets ranked within their node."""
    steps = [f"t0 AS (SELECT source, unnest(range(1, quota + 1)) AS ticket, 0 AS low, {SHARDS} AS high FROM q)"]
    levels = (SHARDS - 1).bit_length()
    for i in range(levels):
        steps.append(f"""r{i} AS (SELECT *, (low + high + 1) // 2 AS middle, count(*) OVER (PARTITION BY low, high) AS tickets,
  row_number() OVER (PARTITION BY low, high ORDER BY md5('{SEED}|tree{i}|' || coalesce(source, '') || '|' || ticket),
                     source NULLS FIRST, ticket) AS place FROM t{i})""")
        left = "(place <= round(tickets * (middle - low) / (high - low)::DOUBLE) OR high - low = 1)"
        steps.append(f"""t{i + 1} AS (SELECT source, ticket, CASE WHEN {left} THEN low ELSE middle END AS low,
  CASE WHEN {left} THEN least(middle, high) ELSE high END AS high FROM r{i})""")
    steps.append(f"quota AS (SELECT source, low AS shard, count(*) AS n FROM t{levels} GROUP BY source, low)")
    return ",\n".join(steps)


_CASES = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(WEIGHTS))
_COUNTS = "concat_ws(',', " + ", ".join(f"count(*) FILTER (shard = {i})" for i in range(SHARDS)) + ")"
_NONE = ",".join("0" * SHARDS)
ORACLE = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         ('0x' || substr(md5('{SEED}|block|' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {BLOCKS} AS block
  FROM documents),
bl AS (SELECT source, block, sum(size)::BIGINT AS words FROM d GROUP BY source, block),
s0 AS (SELECT source, sum(words)::BIGINT AS source_size FROM bl GROUP BY source),
s1 AS (SELECT *, (CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} {_CASES} END)::DOUBLE AS weight,
              source_size * {float(MOST)}::DOUBLE AS lim FROM s0),
s2 AS (SELECT *, sum(source_size) OVER () * {SHARE}::DOUBLE
                 - sum(lim) OVER (ORDER BY lim / weight, source NULLS LAST) + lim AS rest,
              sum(weight) OVER () - sum(weight) OVER (ORDER BY lim / weight, source NULLS LAST) + weight AS opened FROM s1),
s3 AS (SELECT *, max(rest / opened) OVER () AS level FROM s2),
s AS (SELECT source, source_size, least(lim, coalesce(level * weight, lim)) AS target FROM s3),
b AS (SELECT bl.source, block, words, target, source_size,
             CASE WHEN source_size > 0 THEN floor(target / source_size)::INTEGER ELSE 0 END AS times,
             md5('{SEED}|order|' || coalesce(bl.source, '') || '|' || block) AS key
      FROM bl JOIN s ON bl.source IS NOT DISTINCT FROM s.source),
o AS (SELECT *, CASE WHEN times < {MOST} THEN target - times * source_size ELSE -1 END AS rest,
             row_number() OVER (PARTITION BY source ORDER BY key, block) AS n FROM b),
walk AS (
  SELECT DISTINCT source, 0::BIGINT AS n, -1 AS block, '' AS key, 0::BIGINT AS words, times, rest::DOUBLE AS rest, true AS drawn FROM o
  UNION ALL
  SELECT o.source, o.n, o.block, o.key, o.words, o.times,
         CASE WHEN o.words <= w.rest THEN w.rest - o.words ELSE w.rest END, o.words <= w.rest
  FROM walk w JOIN o ON o.source IS NOT DISTINCT FROM w.source AND o.n = w.n + 1),
ended AS (SELECT * REPLACE (arg_max(rest, n) OVER (PARTITION BY source) AS rest) FROM walk),
valued AS (SELECT *, CASE WHEN drawn THEN words + rest ELSE words::DOUBLE END AS value FROM ended),
near AS (SELECT *,
  last_value(CASE WHEN drawn THEN {{'value': value, 'block': block}} END IGNORE NULLS) OVER (
    PARTITION BY source ORDER BY value, drawn DESC, key, block ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS below,
  first_value(CASE WHEN drawn THEN {{'value': value, 'block': block}} END IGNORE NULLS) OVER (
    PARTITION BY source ORDER BY value, drawn DESC, key, block ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS above
  FROM valued),
missed AS (SELECT *, least(value - below.value, above.value - value) AS miss,
  CASE WHEN above IS NULL OR value - below.value <= above.value - value THEN below.block ELSE above.block END AS other FROM near),
swap AS (SELECT source, block, other FROM missed WHERE NOT drawn AND miss < rest
         QUALIFY row_number() OVER (PARTITION BY source ORDER BY miss, key, block) = 1),
p AS (SELECT m.source, m.block, m.times + CASE WHEN m.block = x.block THEN 1 WHEN m.block = x.other THEN 0
                                               ELSE m.drawn::INTEGER END AS copies
      FROM missed m LEFT JOIN swap x ON m.source IS NOT DISTINCT FROM x.source WHERE m.block >= 0),
c AS (SELECT source, block, unnest(range(1, copies + 1)) AS copy FROM p),
drawn AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY
            md5('{SEED}|draw|' || coalesce(source, '') || '|' || block || '|' || copy), block, copy) AS draw FROM c),
q AS (SELECT source, count(*) AS quota FROM drawn GROUP BY source),
{_tree()},
ranges AS (SELECT *, sum(n) OVER (PARTITION BY source ORDER BY shard) AS upto FROM quota),
dealt AS (SELECT drawn.source, block, shard FROM drawn JOIN ranges
          ON drawn.source IS NOT DISTINCT FROM ranges.source AND draw > upto - n AND draw <= upto),
held AS (SELECT source, block, count(*) AS copies, {_COUNTS} AS shard_copies FROM dealt GROUP BY source, block)
SELECT d.doc_id, d.size, s.source_size, s.target, (d.size * coalesce(h.copies, 0))::BIGINT AS taken,
       coalesce(h.shard_copies, '{_NONE}') AS shard_copies
FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source
LEFT JOIN held h ON d.source IS NOT DISTINCT FROM h.source AND d.block = h.block
"""
