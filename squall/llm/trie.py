"""Prefix trie of conversations: shared first turns as nodes, aggregated upwards.

A conversation is one row of turn ids (128 bits of a digest of role and text, as
two numbers) and word counts; texts stay behind. Rows are range-sharded by their
whole id sequence and then by conv_id, so each shard is a stretch of the sorted
corpus, and equal conversations, however many, spread over shards. Inside a shard
ids stand in padded matrices of ``BAND`` turns; rows that go on deeper form the
next band, so one long conversation does not widen the matrix of all. A lexsort
puts equal prefixes side by side, change masks between neighbours, OR-accumulated
over the columns, mark where the nodes of each depth start, and ``reduceat`` over
these starts aggregates members and, from the deepest level back, subtrees.

Only nodes on the path of a shard's first or last row can go on in another shard.
How many turns neighbouring shards share is found beforehand (one number a
boundary), so a shard counts a node only if it starts there and a leaf only if it
ends there, and the parts of a boundary node simply add up. Its key is the shard
where it starts and its depth. Member lists of boundary nodes are blocks in
order, hashed as a stream.

Edge cases: null role or text is empty; null turns come first; rows of one turn go by
the digest of role and text; equal rows are turns of their own; rows without conv_id
belong to no conversation; a conversation that rebuilds to no turn is a member of
the root only; an empty table has no nodes; other columns are ignored. A
conversation is one row of 20 bytes a turn, so its length must fit in a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from squall.llm.common import WORD, ship, stage

BAND = 16                  # turns in one matrix
SHARD_TURNS = 1 << 18      # in a shard, on average
PAD = -(2**63)             # below every id: shorter sequences come first
FEW_NODES = 200_000        # boundary nodes (20 bytes each) that may be broadcast
NOTHING = hashlib.sha256(b"").hexdigest()
NODE = ("origin int, depth long, conv_id long, parent_origin int, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string, shard int, ends string")
FIELDS = [f.split()[0] for f in NODE.split(", ")]


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, and of its turns in order the ids (two numbers each) and words."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # the length of the role keeps its end apart from the text's begin
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("int").alias("words"))

    def number(at: int) -> Column:
        high, low = (F.conv(F.substring("digest", at + d, 8), 16, 10).cast("long") for d in (0, 8))
        return F.greatest(F.shiftleft(high, 32).bitwiseOR(low), F.lit(PAD + 1))

    turn = F.struct("turn", number(1).alias("a"), number(17).alias("b"), "words")
    listed = (rows.where("conv_id IS NOT NULL").groupBy("conv_id")
              .agg(F.sort_array(F.collect_list(turn)).alias("turns")))  # nulls first
    return listed.select("conv_id", F.flatten(F.transform("turns", lambda t: F.array(t["a"], t["b"]))).alias("ids"),
                         F.transform("turns", lambda t: t["words"]).alias("words"))


def with_shared_starts(own: DataFrame, every: int, most: int) -> DataFrame:
    """Each conversation with its first h = crc32(conv_id) % most turns replaced
    by the first h of the conversation conv_id - conv_id % every, all if that has
    fewer, none if it does not exist."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    base = own.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.slice("ids", 1, 2 * most).alias("base_ids"), F.slice("words", 1, most).alias("base_words"))
    rows = own.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % every}).join(base, "base", "left")

    def spliced(name: str, each: int) -> Column:
        column = F.col(name)
        start = F.coalesce(F.slice(f"base_{name}", F.lit(1), F.col("h") * each), F.slice(column, 1, 0))
        return F.concat(start, F.slice(column, F.col("h") * each + 1, F.size(column))).alias(name)

    return rows.select("conv_id", spliced("ids", 2), spliced("words", 1))


def levels(conv: np.ndarray, ids: np.ndarray, words: np.ndarray, offsets: np.ndarray) -> list[dict]:
    """The nodes of some conversations, a dictionary of arrays for each depth, in
    the order of their prefixes: parent (place in the level above), n members,
    conv (the smallest), words of the last turn, and the conv_ids that end there,
    ascending within a node, with their number. ``ids`` has a row of two numbers
    for each turn; ``offsets`` counts turns."""
    length = np.diff(offsets)
    found: list[dict] = []

    def add(parent, n, smallest, last_words, rows):
        node = np.repeat(np.arange(len(n)), n)
        done = length[rows] == len(found)
        rows, node = rows[done], node[done]
        order = np.lexsort((conv[rows], node))
        found.append({"parent": parent, "n": n, "conv": smallest, "words": last_words, "ends": conv[rows[order]],
                      "n_ends": np.bincount(node, minlength=len(n))})

    rows = np.arange(len(conv))
    node = np.zeros(len(conv), np.int64)  # of each row, at the depth reached
    add(np.zeros(1, np.int64), np.array([len(conv)]), conv.min(keepdims=True), np.zeros(1, np.int64), rows)
    for at in range(0, int(length.max()), BAND):
        deeper = length[rows] > at
        rows, node = rows[deeper], node[deeper]
        place = offsets[rows][:, None] + at + np.arange(BAND)
        inside = place < offsets[rows + 1][:, None]
        place[~inside] = 0
        matrix = np.where(inside[:, :, None], ids[place], PAD).reshape(len(rows), -1)
        count = words[place]
        order = np.lexsort((*matrix.T[::-1], node))
        rows, node, matrix, count, inside = rows[order], node[order], matrix[order], count[order], inside[order]
        change = np.ones((len(rows), BAND), bool)
        change[1:] = (matrix[1:] != matrix[:-1]).reshape(-1, BAND, 2).any(axis=2)
        change[1:, 0] |= node[1:] != node[:-1]
        changed = np.logical_or.accumulate(change, axis=1)
        for k in range(BAND):
            here = np.flatnonzero(inside[:, k])
            if not len(here):
                break
            starts = np.flatnonzero(changed[here, k])
            which = np.cumsum(changed[here, k]) - 1
            add(node[here[starts]], np.add.reduceat(np.ones(len(here), np.int64), starts),
                np.minimum.reduceat(conv[rows[here]], starts), count[here[starts], k].astype(np.int64), rows[here])
            node[here] = which
    return found


def origins(shared: list[int], inner: list[int], shard: int) -> list[int]:
    """For each depth that the first row of a shard shares with the row before it:
    the shard in which that node starts. ``shared[i]`` is the number of turns that
    neighbours i - 1 and i share, -1 before the first and after the last,
    ``inner[i]`` how many the first and the last row of shard i share."""
    at, found = shard, []
    for depth in range(shared[shard], -1, -1):
        while shared[at] >= depth and (at == shard or inner[at] >= depth):
            at -= 1
        found.append(at)
    return found[::-1]


def shard_nodes(found: list[dict], shard: int, shared: list[int], inner: list[int], open_end: bool) -> Iterator[pa.RecordBatch]:
    """The nodes of one shard in rows of ``NODE``. ``open_end`` tells that the next
    shard's first sequence equals the last one here or goes on from it."""
    start = origins(shared, inner, shard)
    for depth, now in enumerate(found):
        size = len(now["n"])
        now["fresh"], now["closed"] = np.ones(size, bool), np.ones(size, bool)
        now["origin"] = np.full(size, -1, np.int32)
        # in the order of prefixes the last row's path has the last nodes, the first row's path the first
        if depth <= shared[shard + 1]:
            now["origin"][-1] = shard
            now["closed"][-1] = not (open_end and depth == shared[shard + 1])
        if depth < len(start):
            now["origin"][0], now["fresh"][0] = start[depth], False
    for depth in range(len(found) - 1, -1, -1):
        now = found[depth]
        now["saved"] = (now["n"] - now["fresh"]) * now["words"]
        now["children"] = np.zeros(len(now["n"]), np.int64)
        now["leaves"] = now["closed"].astype(np.int64)
        if depth + 1 < len(found):
            below = found[depth + 1]  # children of one parent lie side by side
            starts = np.flatnonzero(np.diff(below["parent"], prepend=-1))
            up = below["parent"][starts]
            now["children"][up] = np.add.reduceat(below["fresh"].astype(np.int64), starts)
            now["leaves"][up] = np.add.reduceat(below["leaves"], starts)
            now["saved"][up] += np.add.reduceat(below["saved"], starts)
    for depth, now in enumerate(found):
        size = len(now["n"])
        boundary = now["origin"] >= 0
        above = found[depth - 1] if depth else None
        upper = above["origin"][now["parent"]] if depth else np.full(size, -1, np.int32)
        parent = above["conv"][now["parent"]] if depth else np.zeros(size, np.int64)
        hashes: list = [None if b else NOTHING for b in boundary.tolist()]
        blocks: list = [None] * size
        cuts = np.concatenate([[0], np.cumsum(now["n_ends"])])
        for i in np.flatnonzero(now["n_ends"]).tolist():
            text = ",".join(map(str, now["ends"][cuts[i]:cuts[i + 1]].tolist()))
            if boundary[i]:
                blocks[i] = text
            else:
                hashes[i] = hashlib.sha256(text.encode()).hexdigest()
        yield pa.record_batch([
            pa.array(now["origin"], mask=~boundary), pa.array(np.full(size, depth, np.int64)), pa.array(now["conv"]),
            pa.array(upper, mask=upper < 0), pa.array(parent, mask=(upper >= 0) | (depth == 0)),
            pa.array(now["n"]), pa.array(now["children"]), pa.array(now["leaves"]), pa.array(now["saved"]),
            pa.array(hashes, pa.string()), pa.array(np.full(size, shard, np.int32)), pa.array(blocks, pa.string())], names=FIELDS)


def _sharded(sequences: DataFrame, shards: int) -> tuple[DataFrame, list[int], list[int], list[bool]]:
    """The staged sequences with the number of their shard among those that hold
    rows, how much neighbours share, how much each shard's ends, and whether
    the next shard goes on from the last row."""
    placed = stage(sequences.repartitionByRange(shards, "ids", "conv_id").withColumn("shard", F.spark_partition_id()),
                   "trie-shards")
    ends = placed.groupBy("shard").agg(F.min("ids").alias("first"), F.max("ids").alias("last"))
    # one row a shard
    before = F.lag("last").over(Window.orderBy("shard"))

    def turns_shared(one: str, other: str) -> Column:
        differ = F.array_position(F.zip_with(one, other, lambda a, b: ~a.eqNullSafe(b)), F.lit(True))
        return F.floor(F.when(differ > 0, differ - 1).otherwise(F.size(other)) / 2).cast("int")

    both = turns_shared("before", "first")
    rows = (ends.withColumn("before", before).select("shard", both.alias("shared"), turns_shared("first", "last").alias("inner"),
                                                     (both * 2 == F.size("before")).alias("goes_on"))
            .orderBy("shard").collect())
    number = {r["shard"]: i for i, r in enumerate(rows)}
    table = sequences.sparkSession.createDataFrame(list(number.items()) or [(0, 0)], "shard int, number int")
    placed = placed.join(F.broadcast(table), "shard").drop("shard").withColumnRenamed("number", "shard")
    return placed, [-1, *(r["shared"] for r in rows[1:]), -1], [r["inner"] for r in rows], [*(r["goes_on"] for r in rows[1:]), False]


def trie(sequences: DataFrame, shards: int | None = None) -> DataFrame:
    """One row for each node of the prefix trie of ``sequences`` (conv_id, ids,
    words): conv_id (the smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = sequences.sparkSession
    ship(spark)
    if shards is None:
        total = sequences.agg(F.sum(F.size("words"))).first()[0] or 0
        shards = max(total // SHARD_TURNS + 1, spark.sparkContext.defaultParallelism)
    placed, shared, inner, goes_on = _sharded(sequences, shards)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[pa.RecordBatch]] = {}
        for batch in batches:
            numbers = batch.column("shard").to_numpy()
            for shard in np.unique(numbers).tolist():
                parts.setdefault(shard, []).append(batch.filter(pa.array(numbers == shard)))
        for shard, pieces in parts.items():
            table = pa.Table.from_batches(pieces).combine_chunks()
            words = table.column("words").combine_chunks()
            words = words if isinstance(words, pa.ListArray) else words.chunk(0)
            ids = table.column("ids").combine_chunks()
            ids = ids if isinstance(ids, pa.ListArray) else ids.chunk(0)
            sizes = words.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            found = levels(table.column("conv_id").to_numpy(), ids.flatten().to_numpy().reshape(-1, 2),
                           words.flatten().to_numpy(), np.concatenate([[0], np.cumsum(sizes)]))
            yield from shard_nodes(found, shard, shared, inner, goes_on[shard])

    parts = max(1, len(goes_on))
    nodes = stage(placed.repartitionById(parts, "shard").mapInArrow(build, NODE), "trie-nodes")
    # the same boundary node, from all shards that it reaches over
    edge = nodes.where("origin IS NOT NULL")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = edge.groupBy("origin", "depth").agg(F.min("conv_id").alias("conv_id"), F.max("parent_origin").alias("parent_origin"), *sums)
    merged = stage(merged.join(_hashed(edge.where("ends IS NOT NULL").select("origin", "depth", "shard", "ends")),
                               ["origin", "depth"], "left"), "trie-edges")
    columns = ["depth", "conv_id", "parent_origin", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    whole = nodes.where("origin IS NULL").select(*columns).unionByName(
        merged.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))
        .withColumn("parent_conv_id", F.lit(None).cast("long")).select(*columns))
    parents = merged.select(F.col("origin").alias("parent_origin"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("upper"))
    if merged.count() <= FEW_NODES:
        parents = F.broadcast(parents)
    return whole.join(parents, ["parent_origin", "depth"], "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "upper").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", "ends_sha256")


def _hashed(blocks: DataFrame) -> DataFrame:
    """SHA-256 of each boundary node's blocks (origin, depth, shard, ends), joined
    by commas in the order of shards: one block in memory at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None

        def done():
            return pa.RecordBatch.from_pydict({"origin": pa.array([key[0]], pa.int32()), "depth": [key[1]],
                                               "ends_sha256": [digest.hexdigest()]})
        for batch in batches:
            for origin, depth, ends in zip(*(batch.column(c) for c in ("origin", "depth", "ends"))):
                now = (origin.as_py(), depth.as_py())
                if now != key:
                    if key is not None:
                        yield done()
                    key, digest = now, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ends.as_buffer())
        if key is not None:
            yield done()

    ordered = blocks.repartition("origin", "depth").sortWithinPartitions("origin", "depth", "shard")
    return ordered.mapInArrow(run, "origin int, depth long, ends_sha256 string")


def conversation_trie(conversations: DataFrame, every: int = 20, most: int = 4, shards: int | None = None) -> DataFrame:
    """The prefix trie of conversations that share the starts of every
    ``every``-th one."""
    own = stage(turns(conversations), "trie-turns")
    return trie(with_shared_starts(own, every, most), shards)


ORACLE = """
WITH t AS (
  SELECT conv_id, turn, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS w
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list(k ORDER BY turn NULLS FIRST, k) AS ks, list(w ORDER BY turn NULLS FIRST, k) AS ws FROM t GROUP BY conv_id),
h AS (
  SELECT *, (xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''),
    lambda x: ascii(x)::BIGINT), lambda c, b: list_reduce([xor(c, b)] || range(8),
    lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) % 4)::BIGINT AS h FROM own),
r AS (
  SELECT h.conv_id, list_concat(coalesce(b.ks[1:h.h], []), h.ks[h.h + 1:]) AS ks,
         list_concat(coalesce(b.ws[1:h.h], []), h.ws[h.h + 1:]) AS ws
  FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 20),
m AS (
  SELECT conv_id, d AS depth, array_to_string(ks[1:d], ' ') AS p, CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS w, len(ks) = d AS ends,
         array_to_string(ks[1:d - 1], ' ') AS up
  FROM r, unnest(range(len(ks) + 1)) u(d)),
n AS (
  SELECT depth, p, any_value(CASE WHEN depth > 0 THEN up END) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM m GROUP BY depth, p),
c AS (SELECT depth - 1 AS depth, up AS p, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
f AS (SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM n LEFT JOIN c ON c.depth = n.depth AND c.p = n.p),
a AS (
  SELECT a.depth, a.p, sum((f.n_children = 0)::INT) AS n_leaves, sum((f.n_convs - 1) * f.w) AS saved_tokens
  FROM f JOIN m a ON a.conv_id = f.conv_id AND a.depth <= f.depth GROUP BY ALL)
SELECT f.conv_id, f.depth::BIGINT AS depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children, a.n_leaves::BIGINT AS n_leaves,
       a.saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
FROM f JOIN a ON a.depth = f.depth AND a.p = f.p LEFT JOIN n q ON q.depth = f.depth - 1 AND q.p = f.up
"""
