"""Packing tokenised documents into sequences by multiway differencing.

Each document's whole blocks of ``capacity`` tokens are sequences of their
own. The remainders of some hundred documents at a time are dealt whole to
windows by the Karmarkar-Karp method: a partial partition is a tuple of window
sums; the two with the largest spread are merged again and again, the largest
sums of one meeting the smallest of the other, until one partition with
near-equal windows is left. If a window exceeds the capacity, the window count
rises and the remainders are dealt again.

What then lies in the windows beyond those that the batch can fill, the
emptiest ones, is what no other window holds whole: it is cut and poured into
the room of the others, and what is left, less than a window for a batch, into
sequences of powers of two, which are not padded. So only these documents are
cut, and nothing is wasted.

There is no shuffle: a batch is a run of rows within one partition, and a
sequence belongs to the partition that made it. A lost task is rerun whole.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wtprof.llm import bpe
from wtprof.llm.common import importable, text_or_empty

CAPACITY = 2048
END_ID = 1             # closes every document
BATCH_WINDOWS = 32     # windows' worth of tokens dealt together; bounds memory and work of a batch
SCHEMA = ("start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, sequence_length long")


def differencing(sizes: list[int], windows: int) -> np.ndarray:
    """Karmarkar-Karp: the window of each item, with near-equal window sums.

    A partial partition holds its window sums in ascending order and, for
    each window, the node of a binary tree whose leaves are its items
    (-1: none)."""
    if windows <= 1 or not sizes:
        return np.zeros(len(sizes), np.int64)
    left, right, heap = [], [], []
    n = len(sizes)
    for k, x in enumerate(sizes):
        sums = np.zeros(windows, np.int64)
        nodes = np.full(windows, -1, np.int64)
        sums[-1], nodes[-1] = x, k
        heap.append((-x, k, sums, nodes))
    heapq.heapify(heap)
    made, tick = n, n
    while len(heap) > 1:
        _, _, sums_a, nodes_a = heapq.heappop(heap)
        _, _, sums_b, nodes_b = heapq.heappop(heap)
        sums = sums_a + sums_b[::-1]
        nodes_b = nodes_b[::-1]
        both = np.flatnonzero((nodes_a >= 0) & (nodes_b >= 0))
        nodes = np.maximum(nodes_a, nodes_b)
        if len(both):
            left.append(nodes_a[both])
            right.append(nodes_b[both])
            nodes[both] = np.arange(made, made + len(both))
            made += len(both)
        order = np.argsort(sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        sums -= sums[0]
        tick += 1
        heapq.heappush(heap, (-int(sums[-1]), tick, sums, nodes))
    window = np.full(made, -1, np.int64)
    roots = heap[0][3]
    window[roots[roots >= 0]] = np.flatnonzero(roots >= 0)
    if left:
        a, b = np.concatenate(left), np.concatenate(right)
        for k in range(made - 1, n - 1, -1):  # parents come after their children
            window[a[k - n]] = window[b[k - n]] = window[k]
    return window[:n]


def deal(sizes: list[int], capacity: int) -> tuple[np.ndarray, int]:
    """Window of each item and the window count: the fewest windows that can
    hold all, more as long as one exceeds the capacity. As windows are near
    equal, the excess of the fullest tells how many are short."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        window = differencing(sizes, windows)
        excess = int(np.bincount(window, sizes, windows).max(initial=0)) - capacity
        if excess <= 0:
            return window, windows
        windows += max(1, windows * excess // (2 * capacity))


class Pieces(NamedTuple):
    """Pieces of a batch in window order."""

    item: np.ndarray     # number of the item a piece is of
    start: np.ndarray    # where in the item it starts
    length: np.ndarray
    window: np.ndarray   # numbered from 0 without gaps
    offset: np.ndarray   # where in the window it starts


def pack_batch(sizes: list[int], capacity: int) -> Pieces:
    """Deal items of at most ``capacity``, then cut those of the emptiest
    windows, beyond the number that can be filled, into the room of the others
    and into windows of powers of two."""
    window, count = deal(sizes, capacity)
    size = np.array(sizes, np.int64)
    sums = np.bincount(window, size, count).astype(np.int64)
    filled, over = divmod(int(size.sum()), capacity)
    fullest = np.argsort(-sums, kind="stable")
    place = np.empty(count, np.int64)
    place[fullest] = np.arange(count)
    window = place[window]
    room = np.append(capacity - sums[fullest[:filled]], [1 << b for b in range(over.bit_length() - 1, -1, -1) if over >> b & 1])
    room = room.astype(np.int64)
    whole = np.flatnonzero(window < filled)
    rows = [(whole, np.zeros(len(whole), np.int64), size[whole], window[whole])]
    cut = np.flatnonzero(window >= filled)
    if len(cut):
        # items and rooms laid end to end: a piece lies between two ends of either
        item_end, room_end = np.cumsum(size[cut]), np.cumsum(room)
        ends = np.unique(np.concatenate([item_end, room_end]))
        ends = ends[ends > 0]
        begin = np.concatenate([[0], ends[:-1]])
        item, to = np.searchsorted(item_end, begin, "right"), np.searchsorted(room_end, begin, "right")
        rows.append((cut[item], begin - (item_end - size[cut])[item], ends - begin, to))
    item, start, length, window = (np.concatenate(c) for c in zip(*rows))
    order = np.argsort(window, kind="stable")
    item, start, length, window = item[order], start[order], length[order], window[order]
    before = np.cumsum(length) - length
    return Pieces(item, start, length, window, before - before[np.searchsorted(window, window)])


def pack(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID, batch_windows: int = BATCH_WINDOWS) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    A document is the BPE ids of its whole text (null: empty) and ``end_id``.
    Returns one row per piece: id_col, start (ids of the document before the
    piece), length, ids_crc32 (of the ids as little-endian unsigned 32-bit),
    doc_tokens, sequence_id, offset (gapless in the sequence), and
    sequence_length. Each id lies in exactly one piece. Rows are packed one by
    one: repeated rows and null ids are packed like any other; ties between
    sizes are broken by the order of rows; an empty table gives no pieces;
    other columns are ignored.
    """
    importable(df.sparkSession)
    id_type = df.schema[id_col].dataType.simpleString()
    names = ["_id", *(x.split()[0] for x in SCHEMA.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = bpe.load(vocabulary)
        end = np.uint32(end_id).astype("<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 32
        docs: list[tuple] = []            # (id, ids as bytes, whole blocks, remainder) of a batch
        held = 0                          # tokens of the remainders

        def close(id_type: pa.DataType) -> pa.RecordBatch:
            nonlocal sequence, held
            ids, raw, blocks, rest = zip(*docs)
            blocks, rest = np.array(blocks, np.int64), np.array(rest, np.int64)
            with_rest = np.flatnonzero(rest)
            p = pack_batch(rest[with_rest].tolist(), capacity) if len(with_rest) else None
            # whole blocks first, each a sequence, then the pieces of the remainders
            doc = np.repeat(np.arange(len(docs)), blocks)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * capacity
            length, place, offset = np.full(len(doc), capacity), np.arange(len(doc)), np.zeros(len(doc), np.int64)
            if p is not None:
                own = with_rest[p.item]
                doc, start = np.append(doc, own), np.append(start, blocks[own] * capacity + p.start)
                length, place = np.append(length, p.length), np.append(place, len(place) + p.window)
                offset = np.append(offset, p.offset)
            full = np.bincount(place, length).astype(np.int64)
            sums = [crc32(memoryview(raw[d])[4 * s:4 * (s + n)]) for d, s, n in zip(doc.tolist(), start.tolist(), length.tolist())]
            out = pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type).take(pa.array(doc)), *(pa.array(c, pa.int64()) for c in (
                    start, length, sums, (blocks * capacity + rest)[doc], sequence + place, offset, full[place]))], names)
            sequence += len(full)
            held = 0
            docs.clear()
            return out

        for batch in batches:
            kind = batch.schema.field("_id").type
            for doc, text in zip(batch.column("_id").to_pylist(), batch.column("_text").to_pylist()):
                raw = codec.encode(text).astype("<u4").tobytes() + end
                blocks, rest = divmod(len(raw) // 4, capacity)
                docs.append((doc, raw, blocks, rest))
                held += rest + blocks * capacity
                if held >= batch_windows * capacity:
                    yield close(kind)
        if docs:
            yield close(kind)

    src = df.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    return src.mapInArrow(run, f"_id {id_type}, {SCHEMA}").withColumnRenamed("_id", id_col)
