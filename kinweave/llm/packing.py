"""Mixture-controlled packing of whole documents into training sequences.

**Queues.** Each source is a queue of tokens: its documents one after another, each
followed by an end token. The ``QUEUES - 1`` sources with most rows have queues of their own, all
others share queue 0, so whatever the input no more queues exist.

**Deficit round-robin.** A window of ``length`` tokens is filled in cells of ``cell``
tokens. With every cell that is dealt a queue's deficit grows by its target share and the
queue whose deficit reaches a whole cell first (of equal ones the first queue) sends one
and pays for it. A queue that is too small for a cell in this window keeps its deficit for the
next. Queues that are empty drop out and the others go on in their proportions. By default the
target is each queue's share of all tokens, so queues end together and every window has the
corpus's mixture to within a cell per queue; ``mixture`` sets other weights.

**Across partitions.** The cell ``i`` of a queue of weight ``w`` is due when ``(i + 1) / w``
cells were dealt per unit of weight, and the round-robin deals cells in order of (due, queue).
So the deficits that all windows before some window left follow from the queues' totals
alone: a task that holds any part of a queue finds the windows of its cells without the
windows before (:class:`Schedule`; tested against the sequential loop). Nothing is
shuffled for packing: encoded documents are written once, the tokens of a task's queues are
summed (tasks x queues numbers), and each task places its own documents. Cells of a
window stand in order of their queue, so what a document has in a window is mostly one piece.

What is left of the queues, less than a cell each, follows in order of the queues. All
sequences but the last are full; what is left for the last is cut into sequences of
descending powers of two, so nothing is padded.

A null text is empty: its end token alone is packed. A null source is a source.
Repeated rows, equal and null ids are documents of their own. A text of any length
is encoded whole. An empty table gives no rows. Other columns, clashing ones too, are
dropped. Sequence numbers depend on the order in which encoded documents were written.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import _util, bpe

LENGTH, CELL, QUEUES, END = 2048, 256, 64, 1
DISTANT = 1 << 62


class Schedule:
    """Where each token of each queue goes, from the queues' totals and weights."""

    def __init__(self, tokens: list[int], weights: list[float] | None = None, length: int = LENGTH, cell: int = CELL):
        if length % cell:
            raise ValueError("cells must fill a window")
        self.length, self.cell = length, cell
        self.cells = np.array([t // cell for t in tokens], np.int64)
        tails = np.array([t % cell for t in tokens], np.int64)
        self.full, total = int(self.cells.sum()), int(sum(tokens))
        #: place of each queue's tail, and of its first token there
        self.tail_at = self.full * cell + np.concatenate([[0], np.cumsum(tails)[:-1]]).astype(np.int64)
        # integer weights, small enough for exact products with the number of any cell
        wanted = np.array(self.cells if weights is None else weights, np.float64)
        if (wanted < 0).any():
            raise ValueError("weights are not negative")
        scale = min(1 << 22, DISTANT // (int(self.cells.max(initial=0)) + 1))
        self.weight = np.maximum(1, np.round(wanted / max(wanted.max(initial=0), 1e-300) * scale)).astype(np.int64)
        # the rest of the last window as powers of two: sequence starts
        rest = total % length
        powers = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        self.starts = total - rest + np.concatenate([[0], np.cumsum(powers)]).astype(np.int64)
        self.whole = total // length

    def dealt(self, queue: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Cells of each queue that are dealt when cell ``i`` of ``queue`` was: a row for each."""
        own = self.weight[queue]
        out = np.empty((len(i), len(self.cells)), np.int64)
        for r, (w, most) in enumerate(zip(self.weight, self.cells, strict=True)):
            due = (i + 1) * w
            out[:, r] = np.minimum(most, np.where(r <= queue, due, due - 1) // own)
        return out

    def moved(self, dealt: np.ndarray, steps: np.ndarray, back: bool) -> np.ndarray:
        """``dealt`` so many steps of the round-robin on, or back; due times are compared exactly."""
        dealt = dealt.copy()
        rows = np.flatnonzero(steps > 0)
        for step in range(int(steps.max(initial=0))):
            rows = rows[steps[rows] > step]
            best, cell = np.full(len(rows), -1), np.zeros(len(rows), np.int64)
            for r, (w, most) in enumerate(zip(self.weight, self.cells, strict=True)):
                c = dealt[rows, r] + (0 if back else 1)
                here, there = c * self.weight[best], cell * w
                better = (best < 0) | ((here >= there) if back else (here < there))
                better &= (c > 0) if back else (c <= most)
                best[better], cell[better] = r, c[better]
            dealt[rows, best] += -1 if back else 1
        return dealt

    def place(self, queue: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where in the row of all windows cell ``i`` of ``queue`` begins."""
        per = self.length // self.cell
        after = self.dealt(queue, i)
        windows, one, which = np.unique((after.sum(1) - 1) // per, return_index=True, return_inverse=True)
        state = after[one]
        n = state.sum(1)
        first = self.moved(state, n - windows * per, True)
        held = self.moved(state, np.minimum(windows * per + per, self.full) - n, False) - first
        slot = (np.cumsum(held, 1) - held)[which, queue] + i - first[which, queue]
        return (windows[which] * per + slot) * self.cell

    def sequence(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sequence, offset in it, and tokens up to its end, of places in the row of windows."""
        last = np.searchsorted(self.starts, at, "right") - 1
        tail = at >= self.starts[0]
        start = np.where(tail, self.starts[np.maximum(last, 0)], at - at % self.length)
        end = np.where(tail, self.starts[np.clip(last + 1, 0, len(self.starts) - 1)], start + self.length)
        return np.where(tail, self.whole + last, at // self.length), at - start, end - at

    def pieces(self, queue: np.ndarray, first: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
        """Pieces of documents that begin at ``first`` of ``queue`` and have ``n`` tokens:
        ``doc`` (number), ``start``, ``length``, ``sequence``, ``offset``."""
        cell_a, cell_b = first // self.cell, (first + n - 1) // self.cell
        counts = cell_b - cell_a + 1
        doc = np.repeat(np.arange(len(n)), counts)
        i = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts) + cell_a[doc]
        q = queue[doc]
        lo, hi = np.maximum(first[doc], i * self.cell), np.minimum((first + n)[doc], (i + 1) * self.cell)
        tail = i >= self.cells[q]
        at = self.tail_at[q] + lo - i * self.cell
        at[~tail] = self.place(q[~tail], i[~tail]) + (lo - i * self.cell)[~tail]
        start, size = lo - first[doc], hi - lo
        # tails may stand on several sequences
        found = []
        while len(at):
            sequence, offset, room = self.sequence(at)
            take = np.minimum(size, room)
            found.append((doc, start, take, sequence, offset))
            more = size > take
            doc, start, size, at = doc[more], (start + take)[more], (size - take)[more], (at + take)[more]
        doc, start, size, sequence, offset = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 5
        order = np.lexsort((start, doc))
        doc, start, size, sequence, offset = (c[order] for c in (doc, start, size, sequence, offset))
        # what follows on in the same document and sequence is one piece
        begins = np.ones(len(doc), bool)
        begins[1:] = (doc[1:] != doc[:-1]) | (sequence[1:] != sequence[:-1]) | (offset[1:] != offset[:-1] + size[:-1])
        at = np.flatnonzero(begins)
        length = np.add.reduceat(size, at) if len(at) else size
        return {"doc": doc[at], "start": start[at], "length": length, "sequence": sequence[at], "offset": offset[at]}


def queue_of(docs: DataFrame, source_col: str, queues: int = QUEUES) -> tuple[Column, list]:
    """The queue of each row, and the sources of queues 1, 2 and so on."""
    source = F.col(source_col).cast("string")
    most = docs.groupBy(source.alias("s")).count().orderBy(F.desc("count"), "s").limit(queues - 1).collect()
    named = [r.s for r in most]
    queue = F.lit(0)
    for k, s in enumerate(named, 1):
        queue = F.when(source.eqNullSafe(F.lit(s)), k).otherwise(queue)
    return queue, named


def encoded(docs: DataFrame, path: str, queue: Column, id_col: str, text_col: str) -> DataFrame:
    """(id, queue, n, tokens, before, part), written once: every document's ids and end token
    as little-endian integers, and the tokens of its queue before it in its task."""
    wide = "<u2" if len(bpe.pieces_of(path)) <= 1 << 16 else "<u4"

    def finish(lists):
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        ends = np.cumsum(counts)
        out = np.full(int(ends[-1]) if len(ends) else 0, END, wide)
        inside = np.ones(len(out), bool)
        inside[ends - 1] = False
        out[inside] = lists.flatten().to_numpy(zero_copy_only=False)
        offsets = (np.concatenate([[0], ends]) * out.itemsize).astype(np.int32)
        return [pa.array(counts, pa.int64()), pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(out)])]

    keyed = docs.select(F.struct(F.col(id_col).alias("id"), queue.cast("int").alias("queue")).alias("key"), F.col(text_col).alias("text"))
    got = bpe.encode(keyed, path, "key", "text", None, finish, "n long, tokens binary").select("key.id", "key.queue", "n", "tokens")

    def summed(batches):
        part, total = TaskContext.get().partitionId(), np.zeros(QUEUES, np.int64)
        for batch in batches:
            queue, n = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (1, 2))
            if queue.max(initial=0) >= len(total):
                total = np.concatenate([total, np.zeros(int(queue.max()) + 1 - len(total), np.int64)])
            before = np.empty(len(n), np.int64)
            for q in np.unique(queue):
                own = queue == q
                before[own] = total[q] + np.cumsum(n[own]) - n[own]
                total[q] += n[own].sum()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before), pa.array(np.full(len(n), part, np.int32))], names=["id", "queue", "n", "tokens", "before", "part"])

    return _util.saved(got.mapInArrow(_util.lean(summed), _util.extended(got, before="long", part="int")), compression="zstd")


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, cell: int = CELL, mixture: dict | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", queues: int = QUEUES, digests: bool = False) -> DataFrame:
    """One row for each piece: id, source, start, length, doc_tokens, sequence_id, offset,
    and its ``token_ids`` (or with ``digests`` their checksum ``ids_crc32``).

    ``mixture``: relative weights of sources, 1 for one that isn't named; without it
    each source's share of all tokens."""
    path = path or bpe.vocabulary_path()
    queue, named = queue_of(docs, source_col, queues)
    rows = encoded(docs, path, queue, id_col, text_col)
    by_task = rows.groupBy("part", "queue").agg(F.sum("n").alias("held"))
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = _util.saved(by_task.withColumn("ahead", F.coalesce(F.sum("held").over(earlier), F.lit(0))))
    tokens = [0] * (len(named) + 1)
    for r in offsets.groupBy("queue").agg(F.sum("held").alias("t")).collect():  # a number for each queue
        tokens[r.queue] = r.t
    weights = None if mixture is None else [1.0, *(float(mixture.get(s, 1.0)) for s in named)]
    schedule = Schedule(tokens, weights, length, cell)
    wide = "<u2" if len(bpe.pieces_of(path)) <= 1 << 16 else "<u4"
    sources = pa.array([None, *named], pa.string())

    def place(batches):
        for batch in batches:
            ids, queue, n, blob, first = batch.columns
            queue = queue.to_numpy(zero_copy_only=False).astype(np.int64)
            n = n.to_numpy(zero_copy_only=False)
            got = schedule.pieces(queue, first.to_numpy(zero_copy_only=False), n)
            doc = pa.array(got["doc"])
            data, ends = blob.buffers()[2], np.frombuffer(blob.buffers()[1], np.int32)[blob.offset : blob.offset + len(blob) + 1]
            data = np.frombuffer(data, wide) if data else np.zeros(0, wide)
            a = ends[got["doc"]] // data.itemsize + got["start"]
            b = a + got["length"]
            if digests:
                last = pa.array([zlib.crc32(data[x:y].astype("<u4")) for x, y in zip(a, b, strict=True)], pa.int64())
            else:
                last = pa.array([data[x:y].astype(np.int32) for x, y in zip(a, b, strict=True)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(doc), sources.take(pa.array(queue[got["doc"]])), pa.array(got["start"]), pa.array(got["length"]), pa.array(n[got["doc"]]),
                    pa.array(got["sequence"]), pa.array(got["offset"]), last,
                ],
                names=names,
            )

    kind = dict(rows.dtypes)["id"]
    names = [id_col, "source", "start", "length", "doc_tokens", "sequence_id", "offset", "ids_crc32" if digests else "token_ids"]
    schema = f"`{id_col}` {kind}, source string, start long, length long, doc_tokens long, sequence_id long, offset long, " + ("ids_crc32 long" if digests else "token_ids array<int>")
    # no hint: the offsets are broadcast where their written size allows, else joined by a shuffle
    placed = rows.join(offsets.select("part", "queue", "ahead"), ["part", "queue"]).select("id", "queue", "n", "tokens", (F.col("before") + F.col("ahead")).alias("first"))
    return placed.mapInArrow(_util.lean(place), schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, token_ids, lengths): whole sequences of :func:`pack`, and the lengths of
    their pieces, which attention masks need. A group holds one sequence."""
    got = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "length", "token_ids"))).alias("p"))
    return got.select("sequence_id", F.flatten(F.transform("p", lambda x: x["token_ids"])).alias("token_ids"), F.transform("p", lambda x: x["length"]).alias("lengths"))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source of each piece."""
    got = pack(docs, digests=True)
    return got.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source")
