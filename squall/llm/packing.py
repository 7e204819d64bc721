"""Vector bin packing of tokenized examples into training sequences.

An example asks for three amounts at once: tokens, one segment, and the tokens
that bear loss. A sequence has a limit on each. Sequences are filled one after
the other: among the examples that still fit, the one whose demand has the
largest dot product with the sequence's remaining room (both as shares of the
limits) goes in next. Documents may be cut, so the last place of a sequence is
filled with the head of a further document; the rest of it stays in the queue.

Every task packs its own input partition with a bounded queue of open examples,
so there is no shuffle and no group that grows with the data. The last examples
of a task that cannot fill a sequence go into sequences whose lengths are powers
of two, which need no padding.

Edge cases: null or empty text is the end id alone; repeated rows are packed one
by one; an empty table gives no row; a null doc_id is kept; other input columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from squall.llm.common import give_back, ship, slices
from squall.llm.tokens import TextEncoder, default_tokenizer, encoder

QUEUE_TOKENS = 2 << 20  # ids waiting in a task before a round of packing
SLICE = 4 << 20         # bytes of text encoded at once; a byte takes some thirty


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 64
    loss: int = 2048


class Example:
    """A run of a document's ids that is still to be placed. ``loss`` marks the
    ids that bear loss; None means all of them."""

    __slots__ = ("key", "ids", "start", "total", "loss")

    def __init__(self, key, ids: np.ndarray, start: int, total: int, loss: np.ndarray | None = None) -> None:
        self.key, self.ids, self.start, self.total, self.loss = key, ids, start, total, loss

    def demand(self) -> tuple[int, int]:
        return len(self.ids), len(self.ids) if self.loss is None else int(self.loss.sum())

    def split(self, n: int) -> tuple["Example", "Example"]:
        cut = lambda a, b: None if self.loss is None else self.loss[a:b]
        return (Example(self.key, self.ids[:n], self.start, self.total, cut(0, n)),
                Example(self.key, self.ids[n:], self.start + n, self.total, cut(n, None)))

    def fitting(self, tokens: int, loss: int) -> int:
        """Length of the longest head within the given room."""
        n = min(tokens, len(self.ids))
        if self.loss is None:
            return min(n, loss)
        return int(np.searchsorted(np.cumsum(self.loss[:n]), loss, "right"))


class Queue:
    """Waiting examples by their demand, so equal ones are compared once."""

    def __init__(self) -> None:
        self.by_demand: dict[tuple[int, int], list[Example]] = {}
        self.tokens = 0
        self._table()

    def _table(self) -> None:
        self.demands = [k for k, v in self.by_demand.items() if v]
        self.by_demand = {k: self.by_demand[k] for k in self.demands}
        self.sizes = np.array(self.demands, np.float64).reshape(-1, 2)
        self.left = np.array([len(self.by_demand[k]) for k in self.demands], np.int64)
        self.row = {k: i for i, k in enumerate(self.demands)}

    def put(self, examples: list[Example]) -> None:
        fresh = False
        for e in examples:
            k = e.demand()
            self.by_demand.setdefault(k, []).append(e)
            self.tokens += k[0]
            if k in self.row:
                self.left[self.row[k]] += 1
            else:
                fresh = True
        if fresh:
            self._table()

    def take(self, row: int) -> Example:
        e = self.by_demand[self.demands[row]].pop()
        self.left[row] -= 1
        self.tokens -= len(e.ids)
        return e

    def best(self, limits: Limits, tokens: int, segments: int, loss: int) -> int:
        """The fitting demand with the largest dot product with the room, or -1."""
        ok = (self.left > 0) & (self.sizes[:, 0] <= tokens) & (self.sizes[:, 1] <= loss)
        if segments < 1 or not ok.any():
            return -1
        score = (self.sizes[:, 0] / limits.tokens * (tokens / limits.tokens)
                 + 1 / limits.segments * (segments / limits.segments)
                 + self.sizes[:, 1] / limits.loss * (loss / limits.loss))
        return int(np.argmax(np.where(ok, score, -1.0)))


def fill(queue: Queue, limits: Limits, cut: bool) -> list[Example]:
    """The examples of one sequence."""
    out: list[Example] = []
    tokens, loss = limits.tokens, limits.loss
    while tokens and (row := queue.best(limits, tokens, limits.segments - len(out), loss)) >= 0:
        out.append(e := queue.take(row))
        used = e.demand()
        tokens, loss = tokens - used[0], loss - used[1]
    if cut and tokens and loss and len(out) < limits.segments and (queue.left > 0).any():
        e = queue.take(int(np.argmax(np.where(queue.left > 0, queue.sizes[:, 0], -1.0))))
        n = e.fitting(tokens, loss)
        if n:
            head, e = e.split(n)
            out.append(head)
        queue.put([e])
    return out


def powers_of_two(examples: list[Example]) -> Iterator[list[Example]]:
    """Cut a run of examples into sequences with powers of two as lengths."""
    waiting = list(examples)[::-1]
    left = sum(len(e.ids) for e in waiting)
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        out = []
        while room:
            e = waiting.pop()
            if len(e.ids) > room:
                e, rest = e.split(room)
                waiting.append(rest)
            room -= len(e.ids)
            out.append(e)
        yield out


def pack_stream(examples: Iterator[Example], limits: Limits = Limits(), cut: bool = True,
                queue_tokens: int = QUEUE_TOKENS) -> Iterator[list[Example]]:
    """Sequences over a stream of examples. With ``cut`` all but the last few
    sequences are full; without it an example longer than a sequence is an error."""
    queue = Queue()

    def rounds(last: bool) -> Iterator[list[Example]]:
        short: list[list[Example]] = []
        while queue.tokens and (last or queue.tokens >= limits.tokens):
            chosen = fill(queue, limits, cut)
            if not chosen:
                raise ValueError("an example exceeds a limit by itself")
            if sum(len(e.ids) for e in chosen) == limits.tokens or (not cut and (last or queue.tokens)):
                yield chosen
            elif last:
                yield from powers_of_two(chosen)
            else:  # limited by segments or loss: later examples fill it better
                short.append(chosen)
        if sum(len(e.ids) for s in short for e in s) > queue_tokens // 4:
            for s in short:  # unless all are like these
                yield from powers_of_two(s)
        else:
            queue.put([e for s in short for e in s])

    waiting: list[Example] = []
    held = 0
    for e in examples:
        n = len(e.ids)
        if cut and e.loss is None and limits.loss >= limits.tokens:
            while len(e.ids) >= limits.tokens:  # fills a sequence alone
                head, e = e.split(limits.tokens)
                yield [head]
        if len(e.ids):
            waiting.append(e)
            held += n
        if held >= queue_tokens:
            queue.put(waiting)
            waiting, held = [], 0
            yield from rounds(False)
    queue.put(waiting)
    yield from rounds(True)


PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, segment int")
_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
                     ("offset", pa.int64()), ("segment", pa.int32())])


def document_examples(batches: Iterator[pa.RecordBatch], enc: TextEncoder, end_id: int) -> Iterator[Example]:
    """Batches of documents (doc_id, text) as examples, encoded ``SLICE`` bytes at a time."""
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            ids, counts = enc.encode(part.column("text"))
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, np.uint32(end_id)).astype("<u4", copy=False)
            stops = np.cumsum(counts + 1).tolist()
            give_back()
            at = 0
            for key, stop in zip(part.column("doc_id").to_pylist(), stops):
                yield Example(key, ids[at:stop], 0, stop - at)
                at = stop


def pack_documents(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1,
                   limits: Limits = Limits(), with_ids: bool = False) -> DataFrame:
    """Pack whole documents (doc_id, text), all ids bearing loss.

    One row per piece: its document and place in it, the sequence and the
    gapless offset there; ``with_ids`` adds the piece's ids themselves.
    ``sequence_id`` is the task's number and the sequence's number in it.
    """
    tokenizer = tokenizer or default_tokenizer()
    ship(docs.sparkSession)
    schema = _PIECES.append(pa.field("ids", pa.list_(pa.int32()))) if with_ids else _PIECES

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        for sequence in pack_stream(document_examples(batches, encoder(tokenizer), end_id), limits):
            offset = 0
            for k, e in enumerate(sequence):
                row = (e.key, e.start, len(e.ids), zlib.crc32(np.ascontiguousarray(e.ids)), e.total, number, offset, k)
                rows.append((*row, e.ids.tolist()) if with_ids else row)
                offset += len(e.ids)
            number += 1
            if len(rows) > 8192:
                yield _batch(rows, schema)
                rows = []
        if rows:
            yield _batch(rows, schema)

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(pack, PIECES + (", ids array<int>" if with_ids else "")))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def pack_examples(examples: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Pack whole instruction examples (key long, ids array<int>, loss
    array<boolean>) without cutting them; padding is what no example fits.

    Null ids count as an empty example, which takes no place and gives no row;
    a null loss mask means that every id bears loss.
    """
    ship(examples.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[Example]:
        for batch in batches:
            for key, ids, loss in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.array(ids or [], "<u4")
                yield Example(key, ids, 0, len(ids), None if loss is None else np.array(loss, bool))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for sequence in pack_stream(read(batches), limits, cut=False):
            offset, rows = 0, []
            for k, e in enumerate(sequence):
                rows.append((e.key, e.start, len(e.ids), zlib.crc32(e.ids), e.total, number, offset, k))
                offset += len(e.ids)
            number += 1
            yield _batch(rows, _PIECES)

    chosen = examples.select(F.col("key").cast("long"), F.col("ids").cast("array<int>"),
                             F.col("loss").cast("array<boolean>"))
    return chosen.mapInArrow(pack, PIECES)
