"""Token-id files with Re-Pair grammar compression.

Documents are encoded and laid end to end in ascending doc_id order (nulls
first, ties by text). The stream is cut into shards of a fixed number of ids;
in each shard frequent neighbouring pairs are replaced by nonterminals, round
after round. A shard file stores its documents' places, the rules with their
expansion lengths, the remaining symbols and the id position of every
``INDEX_STEP``-th symbol, so any range of ids is decoded without the rest.

Each round counts all pairs of the shard, ranks them by count and replaces an
occurrence where no overlapping occurrence ranks higher (runs of one symbol
pair up from the left). Pairs left with fewer than ``MIN_USES`` replacements
keep no rule. Symbols are numbered per shard in 16 bits: the ids present, then
the rules; pairs beyond that room simply stay unreplaced.

Edge cases: null text counts as empty (its document is the end id alone); an
empty table gives no shard and no row; repeated rows each get their place; a
document longer than a shard runs on through the next shards of its partition.
Other input columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from squall.llm.common import (attempt_token, read_file, scratch, ship, slices, stage, task_file,
                               write_file)
from squall.llm.tokens import default_tokenizer, encoder

SHARD_IDS = 1 << 20
INDEX_STEP = 1024
MIN_USES = 4
MAX_ROUNDS = 16
SYMBOLS = 1 << 16
MAGIC = b"SQREPAIR"
_NONE = np.int32(2**31 - 1)
_HEAD = struct.Struct("<8s7Q")


@dataclass
class Grammar:
    terminals: np.ndarray  # uint32 ids behind symbols 0..t-1
    left: np.ndarray       # uint16, rule i is symbol t+i
    right: np.ndarray
    lengths: np.ndarray    # uint32 ids that a rule expands to
    levels: np.ndarray     # rules made up to each round
    symbols: np.ndarray    # uint16

    def sizes(self) -> np.ndarray:
        return np.concatenate([np.ones(len(self.terminals), np.int64), self.lengths.astype(np.int64)])


def compress(ids: np.ndarray, min_uses: int = MIN_USES, max_rounds: int = MAX_ROUNDS) -> Grammar:
    """Re-Pair grammar of a run of ids (uint32)."""
    present = np.zeros(int(ids.max()) + 1 if len(ids) else 1, bool)
    present[ids] = True
    terminals = np.flatnonzero(present).astype(np.uint32)
    if len(terminals) > SYMBOLS:
        raise ValueError("a shard holds more distinct ids than 16-bit symbols; use smaller shards")
    s = (np.cumsum(present) - 1).astype(np.uint32)[ids]
    n, sizes = len(terminals), np.ones(len(terminals), np.int64)
    left, right, lengths, levels = [], [], [], []
    for _ in range(max_rounds):
        if len(s) < 2 or n >= SYMBOLS:
            break
        keys = (s[:-1] << np.uint32(16)) | s[1:]
        pairs = _frequent(keys, min_uses)[: SYMBOLS - n]
        if not len(pairs):
            break
        at, rank = _occurrences(keys, pairs)
        keep = np.bincount(rank, minlength=len(pairs)) >= min_uses
        if not keep.any():
            break
        chosen = keep[rank]
        at, rank = at[chosen], rank[chosen]
        a, b = pairs[keep] >> np.uint32(16), pairs[keep] & np.uint32(0xFFFF)
        s[at] = (n + np.cumsum(keep) - 1).astype(np.uint32)[rank]
        before = len(s)
        rest = np.ones(before, bool)
        rest[at + 1] = False
        s = s[rest]
        left.append(a), right.append(b), lengths.append(sizes[a] + sizes[b])
        sizes = np.concatenate([sizes, lengths[-1]])
        n += len(a)
        levels.append(n - len(terminals))
        if len(s) > 0.99 * before:
            break
    join = lambda x, t: np.concatenate(x).astype(t) if x else np.empty(0, t)
    return Grammar(terminals, join(left, np.uint16), join(right, np.uint16), join(lengths, np.uint32),
                   np.array(levels, np.uint32), s.astype(np.uint16))


def _frequent(keys: np.ndarray, least: int) -> np.ndarray:
    """Pairs seen at least so often, the most frequent first."""
    ordered = np.sort(keys)
    first = np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1])
    counts = np.diff(first, append=len(ordered))
    often = counts >= least
    return ordered[first[often]][np.argsort(-counts[often], kind="stable")]


def _occurrences(keys: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places to replace and the rank of the pair there; no two overlap.

    The rank is looked up in a hashed table in which the more frequent of two
    pairs with one slot stays; the other gets its turn in a later round."""
    bits = max(10, int(np.ceil(np.log2(len(pairs) * 4))))
    slot = lambda k: (k * np.uint32(2654435761)) >> np.uint32(32 - bits)
    held, ranks = np.zeros(1 << bits, np.uint32), np.full(1 << bits, _NONE, np.int32)
    own = slot(pairs)[::-1]
    held[own], ranks[own] = pairs[::-1], np.arange(len(pairs), dtype=np.int32)[::-1]
    of = slot(keys)
    best = held[of] == keys
    rank = ranks[of]
    rank[~best] = _NONE
    best[1:] &= rank[1:] < rank[:-1]
    best[:-1] &= rank[:-1] <= rank[1:]
    at = np.flatnonzero(best)
    return at, rank[at]


def expand(g: Grammar, symbols: np.ndarray | None = None) -> np.ndarray:
    """The ids behind a run of symbols (all of them by default)."""
    if symbols is None:
        symbols = g.symbols
    if len(symbols) * 4 < len(g.left):  # a short range: unfold only what it uses
        t = len(g.terminals)
        s = symbols.astype(np.int64)
        while (rule := s >= t).any():
            n = np.where(rule, 2, 1)
            ends = np.cumsum(n)
            out = np.repeat(s, n)
            at = s[rule] - t
            out[ends[rule] - 2], out[ends[rule] - 1] = g.left[at], g.right[at]
            s = out
        return g.terminals[s]
    flat, sizes, made = g.terminals, g.sizes(), len(g.terminals)
    start = np.cumsum(sizes) - sizes
    for a, b in zip([0, *g.levels[:-1]], g.levels):
        both = np.stack([g.left[a:b], g.right[a:b]], axis=1).ravel()
        flat = np.concatenate([flat, flat[_runs(start, sizes, both)]])
    return flat[_runs(start, sizes, symbols)]


def _runs(start: np.ndarray, sizes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    n = sizes[symbols]
    upto = np.cumsum(n)
    return np.repeat(start[symbols] - upto + n, n) + np.arange(upto[-1] if len(upto) else 0)


class ShardFile:
    """One shard: ``docs`` holds (doc_id, valid, start, n_tokens) of the
    documents that begin in it, ``start`` counted from the shard's first id."""

    def __init__(self, data: bytes) -> None:
        magic, *n = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        docs, self.n_ids, terminals, rules, levels, symbols, index = n
        at = _HEAD.size
        parts = []
        for kind, count in (("<i8", docs), ("u1", docs), ("<i8", docs), ("<i8", docs), ("<u4", terminals),
                            ("<u2", rules), ("<u2", rules), ("<u4", rules), ("<u4", levels), ("<u2", symbols),
                            ("<i8", index)):
            parts.append(np.frombuffer(data, kind, count, at))
            at += parts[-1].nbytes
        if zlib.crc32(memoryview(data)[:at]) != struct.unpack_from("<I", data, at)[0]:
            raise ValueError("damaged token shard")
        self.docs, self.grammar, self.index = parts[:4], Grammar(*parts[4:10]), parts[10]

    def read(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard."""
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        if start == 0 and stop == self.n_ids:
            return expand(self.grammar)
        first = max(0, int(np.searchsorted(self.index, start, "right")) - 1)
        last = int(np.searchsorted(self.index, stop, "left"))
        ids = expand(self.grammar, self.grammar.symbols[first * INDEX_STEP:last * INDEX_STEP])
        at = int(self.index[first]) if len(self.index) else 0
        return ids[start - at:stop - at]


def pack_shard(ids: np.ndarray, docs: list[tuple]) -> bytes:
    g = compress(ids)
    at = np.concatenate([[0], np.cumsum(g.sizes()[g.symbols])])
    index = at[:-1][::INDEX_STEP]
    doc_ids = np.array([d[0] or 0 for d in docs], "<i8")
    arrays = [doc_ids, np.array([d[0] is not None for d in docs], "u1"), np.array([d[1] for d in docs], "<i8"),
              np.array([d[2] for d in docs], "<i8"), g.terminals.astype("<u4"), g.left.astype("<u2"),
              g.right.astype("<u2"), g.lengths.astype("<u4"), g.levels.astype("<u4"), g.symbols.astype("<u2"),
              index.astype("<i8")]
    body = _HEAD.pack(MAGIC, len(docs), len(ids), len(g.terminals), len(g.left), len(g.levels), len(g.symbols),
                      len(index)) + b"".join(a.tobytes() for a in arrays)
    return body + struct.pack("<I", zlib.crc32(body))


MANIFEST = "pid int, seq int, path string, first long, n_ids long, n_docs long"


def write_token_files(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 2,
                      shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode documents (doc_id, text) and write the shard files below ``folder``.

    Returns the staged manifest, one row per file: partition, number in it,
    path, first id (counted in the whole corpus) and sizes.
    """
    tokenizer = tokenizer or default_tokenizer()
    ship(docs.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, token, enc = TaskContext.get().partitionId(), attempt_token(), encoder(tokenizer)
        buffer: list[np.ndarray] = []
        held = seq = first = 0   # ids in the buffer, files written, ids before the buffer
        places: list[tuple] = []  # documents that begin in the buffer

        def flush(n: int):
            nonlocal buffer, held, seq, first, places
            ids = np.concatenate(buffer)
            path = task_file(folder, ".rpr", pid, seq, token)
            own = [p for p in places if p[1] < n]
            write_file(path, pack_shard(ids[:n], own))
            row = (pid, seq, path, first, n, len(own))
            places = [(d, at - n, k) for d, at, k in places[len(own):]]
            buffer, held, seq, first = [ids[n:]], held - n, seq + 1, first + n
            return pa.RecordBatch.from_pylist([dict(zip(("pid", "seq", "path", "first", "n_ids", "n_docs"), row))],
                                              schema=_MANIFEST)

        for batch in batches:
            for part in slices(batch, "text"):
                ids, counts = enc.encode(part.column("text"))
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, np.uint32(end_id))
                starts = held + np.cumsum(counts + 1) - counts - 1
                places += zip(part.column("doc_id").to_pylist(), starts.tolist(), (counts + 1).tolist())
                buffer.append(ids)
                held += len(ids)
                while held >= shard_ids:
                    yield flush(shard_ids)
        if held:
            yield flush(held)

    ordered = (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    files = stage(ordered.mapInArrow(write, MANIFEST), "tokens-manifest")
    # one row per partition here, so one task sums it
    before = (files.groupBy("pid").agg(F.sum("n_ids").alias("n"))
              .withColumn("before", F.sum("n").over(Window.orderBy("pid")) - F.col("n")).drop("n"))
    return files.join(before, "pid").withColumn("first", F.col("first") + F.col("before")).drop("before")


_MANIFEST = pa.schema([("pid", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("first", pa.int64()),
                       ("n_ids", pa.int64()), ("n_docs", pa.int64())])
_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                   ("ids_crc32", pa.int64()), ("shard_path", pa.string())])


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Decode the shard files: one row per document with its place in the
    corpus, its number of ids and the CRC-32 of them (little-endian uint32)."""

    ship(manifest.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = ShardFile(read_file(row["path"]))
                ids = shard.read().astype("<u4")
                doc_ids, valid, start, count = shard.docs
                crc = []
                for a, n in zip(start.tolist(), count.tolist()):
                    value = zlib.crc32(ids[a:a + n])
                    left = n - (len(ids) - a)
                    path, seq = row["path"], row["seq"]
                    while left > 0:  # it runs on in the next file of this partition
                        stem, number = path.rsplit("-", 1)
                        seq += 1
                        more = ShardFile(read_file(f"{stem}-{seq:06d}.rpr")).read(0, left).astype("<u4")
                        value, left = zlib.crc32(more, value), left - len(more)
                    crc.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, mask=valid == 0), pa.array(row["first"] + start), pa.array(count),
                     pa.array(crc, pa.int64()), pa.array([row["path"]] * len(crc), pa.string())], schema=_DOCS)

    # few small rows stand for large files: spread them by number, not by size
    tasks = max(1, min(manifest.count(), 10_000))
    return manifest.repartition(tasks, "path").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long, shard_path string")


def token_files_roundtrip(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """Write a corpus as token files in the shared folder and read it back."""
    folder = scratch(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, folder, tokenizer, end_id))
