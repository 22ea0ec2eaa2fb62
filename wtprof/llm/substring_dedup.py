"""Exact substring removal with fixed-block anchors.

A document is cut into non-overlapping blocks of ``(window + 1) // 2`` words;
any ``window`` consecutive words hold a whole block of it. All blocks are
indexed and probed with the rolling windows of that length of every document.
A block that another place shares is an anchor. Anchors are extended: every
``window``-word sequence around one is looked up for the smallest document it
starts in, and the words of all sequences that a smaller document has are
removed, which are the words of the maximal exact repeats.

How it runs. Documents are packed into batches, one compressed row each.
1. A batch sends its distinct rolling hashes, sorted and delta-coded, with a
   bit for those that are blocks, to hash buckets. Within a batch a frequent
   passage is one entry, however many documents have it.
2. A bucket answers each batch with one bit for each entry: is it in two
   batches or more, and a block in some?
3. With its answers a batch finds its anchors (adding those it can tell
   alone) and sends the distinct sequences around them with the smallest
   document each starts in, again to buckets, which answer with one bit: does
   a smaller document of another batch have it?
4. The batch removes the covered words.
So what is shuffled is the compressed texts, twice, about two bytes for each
word, and ten for each sequence around an anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wtprof.llm.common import importable, shuffle_width, worker_state, written
from wtprof.llm.words import Words

WINDOW = 13
BATCH_BYTES = 4 << 20        # text of a batch
BUCKET_WORDS = 1 << 22       # rolling windows a bucket should hold
KEY_BITS = 28                # bits of an anchor hash within its bucket; a false anchor only costs a look-up
MORE = 0xFFFF                # delta code: add this and go on
LAST = np.iinfo(np.int64).max


# -- batches ------------------------------------------------------------------

def _pack(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[pa.RecordBatch]:
    """Rows → batches of about BATCH_BYTES of text, one compressed row each."""
    worker_state("substring", dict)
    base, made = TaskContext.get().partitionId() << 32, 0
    held: list[pa.RecordBatch] = []
    size = 0

    def row() -> pa.RecordBatch:
        nonlocal made, size
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema) as out:
            for b in held:
                out.write_batch(b)
        blob = zstandard.ZstdCompressor(level=3).compress(sink.getvalue())
        made += 1
        rows = sum(map(len, held))
        held.clear()
        done, size = size, 0
        return pa.RecordBatch.from_pydict({"batch": pa.array([base + made]), "rows": pa.array([rows]),
                                           "bytes": pa.array([done]), "blob": pa.array([blob], pa.binary())})

    for b in batches:
        sizes = np.cumsum(_lengths(b.column(text_at)))
        at = 0
        while at < len(b):
            room = (sizes[at - 1] if at else 0) + BATCH_BYTES - size
            end = min(len(b), max(at + 1, int(np.searchsorted(sizes, room, "right"))))
            held.append(b.slice(at, end - at))
            size += int(sizes[end - 1] - (sizes[at - 1] if at else 0))
            at = end
            if size >= BATCH_BYTES or at < len(b):
                yield row()
    if held:
        yield row()


def _lengths(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _unpack(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(blob)).read_all()


class _Batch:
    """Documents and words of one batch."""

    def __init__(self, blob: bytes, id_at: int, text_at: int):
        self.table = _unpack(blob)
        self.texts = [(t or "").encode() for t in self.table.column(text_at).to_pylist()]
        self.ids = np.array([LAST if i is None else i for i in self.table.column(id_at).to_pylist()], np.int64)
        self.words = Words(self.texts)


# -- anchors ------------------------------------------------------------------

def _rolling(w: Words, block: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word of each rolling window, entry of each, entries, is an entry a
    block, places of an entry); an entry is bucket and key of a hash."""
    at = np.flatnonzero(w.window_starts(block))
    h = w.windows(block)[at]
    bucket = (h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    key = bucket << np.uint64(KEY_BITS) | h & np.uint64((1 << KEY_BITS) - 1)
    entries, of, places = np.unique(key, return_inverse=True, return_counts=True)
    aligned = np.zeros(len(entries), bool)
    aligned[of[(at - w.first[w.doc[at]]) % block == 0]] = True
    return at, of, entries, aligned, places


def encode_sorted(keys: np.ndarray) -> tuple[bytes, bool]:
    """Ascending keys as 16-bit deltas (MORE: add and go on), or as plain
    32-bit numbers (True) where that is shorter."""
    delta = np.diff(keys, prepend=0).astype(np.int64)
    more = delta // MORE
    if (more.sum() + len(keys)) * 2 > len(keys) * 4:
        return keys.astype(np.uint32).tobytes(), True
    code = np.full(int(more.sum()) + len(keys), MORE, np.uint16)
    code[np.cumsum(more + 1) - 1] = (delta - more * MORE).astype(np.uint16)
    return code.tobytes(), False


def decode_sorted(raw: bytes, wide: bool) -> np.ndarray:
    if wide:
        return np.frombuffer(raw, np.uint32).astype(np.int64)
    code = np.frombuffer(raw, np.uint16)
    return np.cumsum(code, dtype=np.int64)[code != MORE]


def _bucket_slices(entries: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    bucket = (entries >> np.uint64(shift)).astype(np.int64)
    ids, begin = np.unique(bucket, return_index=True)
    return ids, np.append(begin, len(entries))


CELL = pa.schema([("bucket", pa.int64()), ("batch", pa.int64()), ("keys", pa.binary()), ("wide", pa.bool_()),
                  ("marks", pa.binary())])
ANSWER = pa.schema([("batch", pa.int64()), ("bucket", pa.int64()), ("bits", pa.binary())])


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def _by_cell(parts: list[np.ndarray]) -> np.ndarray:
    return np.repeat(np.arange(len(parts)), [len(p) for p in parts])


def shared_entries(cells: pa.Table) -> pa.Table:
    """Answer one bucket: which entries are in two batches or more and are
    blocks somewhere."""
    keys = [decode_sorted(k, w) for k, w in zip(cells.column("keys").to_pylist(), cells.column("wide").to_pylist())]
    marks = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=len(k)) for m, k in
                            zip(cells.column("marks").to_pylist(), keys)])
    flat = np.concatenate(keys)
    _, of, places = np.unique(flat, return_inverse=True, return_counts=True)
    block = np.bincount(of, marks, len(places)) > 0
    return _answers(cells, keys, (block & (places > 1))[of])


def _answers(cells: pa.Table, parts: list[np.ndarray], bits: np.ndarray) -> pa.Table:
    ends = np.cumsum([len(p) for p in parts])
    rows = []
    for batch, bucket, end, part in zip(cells.column("batch").to_pylist(), cells.column("bucket").to_pylist(), ends, parts):
        own = bits[end - len(part):end]
        if own.any():
            rows.append((batch, bucket, np.packbits(own).tobytes()))
    return _rows(ANSWER, rows)


def _spread(answers: list | None, ids: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Bits of all entries of a batch from its buckets' answers."""
    bits = np.zeros(begin[-1], bool)
    at = {int(b): k for k, b in enumerate(ids)}
    for a in answers or ():
        k = at[a["bucket"]]
        n = begin[k + 1] - begin[k]
        bits[begin[k]:begin[k + 1]] = np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=n).astype(bool)
    return bits


# -- sequences around anchors --------------------------------------------------

SEQ_CELL = pa.schema([("bucket", pa.int64()), ("batch", pa.int64()), ("keys", pa.binary()), ("extra", pa.binary()),
                      ("base", pa.int64()), ("docs", pa.binary()), ("width", pa.int32())])


class _Sequences:
    """Distinct candidate sequences of a batch: 64 + 16 hash bits, the
    smallest document, and the bucket (high bits of the hash)."""

    def __init__(self, b: _Batch, at: np.ndarray, window: int, buckets: int):
        self.at = at
        h = b.words.windows(window)[at]
        x = b.words.windows(window, seed=1)[at].astype(np.uint16)
        self.doc = b.ids[b.words.doc[at]]
        order = np.lexsort((self.doc, x, h))
        new = np.ones(len(at), bool)
        hs, xs = h[order], x[order]
        new[1:] = (hs[1:] != hs[:-1]) | (xs[1:] != xs[:-1])
        self.h, self.x, self.least = hs[new], xs[new], self.doc[order][new]
        self.of = np.empty(len(at), np.int64)
        self.of[order] = np.cumsum(new) - 1
        bucket = ((self.h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        self.buckets, first = np.unique(bucket, return_index=True)  # ascending, as h is
        self.begin = np.append(first, len(self.h))


def earlier_sequences(cells: pa.Table) -> pa.Table:
    """Answer one bucket: which sequences start in a document smaller than
    the smallest of their batch."""
    keys = [np.frombuffer(k, np.uint64) for k in cells.column("keys").to_pylist()]
    extra = np.concatenate([np.frombuffer(k, np.uint16) for k in cells.column("extra").to_pylist()])
    doc = np.concatenate([np.frombuffer(d, f"u{w}").astype(np.int64) + base for d, w, base in
                          zip(*(cells.column(c).to_pylist() for c in ("docs", "width", "base")))])
    h = np.concatenate(keys)
    order = np.lexsort((doc, extra, h))
    hs, xs, ds = h[order], extra[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (hs[1:] != hs[:-1]) | (xs[1:] != xs[:-1])
    least = ds[np.flatnonzero(new)][np.cumsum(new) - 1]
    bits = np.zeros(len(h), bool)
    bits[order] = least < ds
    return _answers(cells, keys, bits)


# -- the operator ---------------------------------------------------------------

def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   digest: bool = False) -> DataFrame:
    """Remove every word of ``window`` consecutive words whose sequence also
    starts in a document with a smaller id.

    Words are runs of characters other than blank and \\t to \\r. Returns all
    rows and columns of ``df`` with ``text_col`` cut, and n_words, n_removed
    (longs; they replace input columns of that name). A removed word goes with
    the white space after it; a text that loses nothing stays as it is. With
    ``digest`` the result is id_col, n_words, n_removed, kept_sha256 only (the
    kept words joined by one space).

    Ids are integers. Null texts have no words and stay null. A null id counts
    as larger than any other; rows with equal ids (repeated rows, null ids)
    are not earlier than each other. An empty table gives an empty result.
    """
    spark = df.sparkSession
    importable(spark)
    df = df.drop(*(c for c in ("n_words", "n_removed") if c in df.columns and c not in (id_col, text_col)))
    id_at, text_at, block = df.columns.index(id_col), df.columns.index(text_col), (window + 1) // 2
    packed = written(df.mapInArrow(lambda it: _pack(it, text_at), "batch long, rows long, bytes long, blob binary"),
                     "packed")
    size = packed.agg(F.sum("bytes")).first()[0] or 0
    buckets = max(shuffle_width(spark), -(-size // (6 * BUCKET_WORDS)))  # a word is about six bytes

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for batch, blob in zip(rows.column("batch").to_pylist(), rows.column("blob").to_pylist()):
                w = _Batch(blob, id_at, text_at).words
                _, _, entries, aligned, _ = _rolling(w, block, buckets)
                ids, begin = _bucket_slices(entries, KEY_BITS)
                keys = (entries & np.uint64((1 << KEY_BITS) - 1)).astype(np.int64)
                out = [(int(i), batch, *encode_sorted(keys[a:b]), np.packbits(aligned[a:b]).tobytes())
                       for i, a, b in zip(ids, begin, begin[1:])]
                yield from _rows(CELL, out).to_batches()

    first = packed.select("batch", "blob").mapInArrow(cells, "bucket long, batch long, keys binary, wide boolean, marks binary")
    anchors = written(first.groupBy("bucket").applyInArrow(shared_entries, "batch long, bucket long, bits binary"),
                      "anchors")

    def with_answers(table: DataFrame, answers: DataFrame, name: str) -> DataFrame:
        # as many bits as the batch has entries: bounded by the batch
        own = answers.groupBy("batch").agg(F.collect_list(F.struct("bucket", "bits")).alias(name))
        return table.join(own, "batch", "left")

    def candidates(b: _Batch, answers: list | None) -> _Sequences:
        """The sequences of a batch that hold an anchor."""
        at, of, entries, aligned, places = _rolling(b.words, block, buckets)
        bits = _spread(answers, *_bucket_slices(entries, KEY_BITS)) | aligned & (places > 1)
        n = len(b.words.hash)
        hits = np.zeros(n + 1, np.int64)
        hits[at + 1] = bits[of]
        hits = np.cumsum(hits)
        reach = hits[np.minimum(np.arange(n) + window - block + 1, n)] - hits[:n]
        return _Sequences(b, np.flatnonzero((reach > 0) & b.words.window_starts(window)), window, buckets)

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for row in rows.to_pylist():
                s = candidates(_Batch(row["blob"], id_at, text_at), row["anchors"])
                base = int(s.least.min()) if len(s.least) else 0
                span = int(s.least.max()) - base if len(s.least) else 0
                width = 2 if span < 1 << 16 else 4 if span < 1 << 32 else 8
                docs = (s.least - base).astype(f"u{width}")
                out = [(int(i), row["batch"], s.h[a:z].tobytes(), s.x[a:z].tobytes(), base, docs[a:z].tobytes(), width)
                       for i, a, z in zip(s.buckets, s.begin, s.begin[1:])]
                yield from _rows(SEQ_CELL, out).to_batches()

    known = with_answers(packed.select("batch", "blob"), anchors, "anchors")
    earlier = known.mapInArrow(
        sequences, "bucket long, batch long, keys binary, extra binary, base long, docs binary, width int",
    ).groupBy("bucket").applyInArrow(earlier_sequences, "batch long, bucket long, bits binary")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for row in rows.to_pylist():
                b = _Batch(row["blob"], id_at, text_at)
                s = candidates(b, row["anchors"])
                repeat = _spread(row["earlier"], s.buckets, s.begin)[s.of] | (s.least[s.of] < s.doc)
                mark = np.zeros(len(b.words.hash) + 1, np.int64)
                np.add.at(mark, s.at[repeat], 1)
                np.add.at(mark, s.at[repeat] + window, -1)
                yield from _kept(b, np.cumsum(mark)[:-1] > 0, id_at, text_at, digest)

    joined = with_answers(known, earlier, "earlier")
    if digest:
        kind = T.StructType([df.schema[id_col], T.StructField("n_words", T.LongType()),
                             T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())])
    else:
        kind = T.StructType([*df.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    return joined.mapInArrow(finish, kind)


def _kept(b: _Batch, gone: np.ndarray, id_at: int, text_at: int, digest: bool) -> Iterator[pa.RecordBatch]:
    """Result rows of a batch, given which words go."""
    from hashlib import sha256
    w, table = b.words, b.table
    removed = np.bincount(w.doc[gone], minlength=len(b.texts)) if len(b.texts) else np.zeros(0, np.int64)
    out = []
    for k, text in enumerate(b.texts):
        kept = text
        if removed[k]:
            a, z = w.first[k], w.first[k + 1]
            stay = ~gone[a:z]
            nxt = np.append(w.start[a + 1:z], len(text))   # a word and the white space after it
            edge = np.flatnonzero(np.diff(np.concatenate([[False], stay, [False]]).astype(np.int8)))
            kept = text[:w.start[a]] + b"".join(text[w.start[a + i]:nxt[j - 1]] for i, j in zip(edge[::2], edge[1::2]))
        out.append(kept)
    counts = [pa.array(w.count, pa.int64()), pa.array(removed, pa.int64())]
    if digest:
        sums = pa.array([sha256(b" ".join(t.split())).hexdigest() for t in out], pa.string())
        result = pa.Table.from_arrays([table.column(id_at), *counts, sums],
                                      [table.column_names[id_at], "n_words", "n_removed", "kept_sha256"])
    else:
        column = table.column(text_at)
        texts = [old if not n else new.decode() for old, n, new in zip(column.to_pylist(), removed, out)]
        result = table.set_column(text_at, table.schema.field(text_at), pa.array(texts, column.type))
        result = result.append_column("n_words", counts[0]).append_column("n_removed", counts[1])
    yield from result.combine_chunks().to_batches()
