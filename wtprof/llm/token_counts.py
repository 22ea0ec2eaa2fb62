"""Token counts with overlap resynchronisation for huge documents.

A text of up to ``chunk_chars`` code points is encoded whole. A longer one is
cut into chunks that overlap. Each chunk is encoded by the library with
offsets, and neighbours are spliced at a boundary in their overlap that both
encodings share and that is proven stable: the characters left and right of
it stand next to each other in no piece of the vocabulary, so no merge can
ever span it and what lies on one side cannot change the other. Where an
overlap holds no such boundary, it is widened, and if need be the chunk grows
too, in the end up to the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wtprof.llm.common import importable, text_or_empty, worker_state

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 256
LIMIT = 4096
SPACE = "▁"  # the library's stand-in for the blank


class ChunkedCounter:
    """Exact token counts of one sentencepiece model."""

    def __init__(self, path: str, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.chunk, self.overlap = max(2, chunk_chars), max(1, min(overlap_chars, chunk_chars - 1))
        pieces = (self.sp.id_to_piece(i) for i in range(self.sp.vocab_size()))
        self.touching = {p[i:i + 2] for p in pieces for i in range(len(p) - 1)}
        self.widened = 0

    def _plain(self, text: str) -> bool:
        """Does the model leave this text as it is, but for blanks?"""
        want = text.replace(" ", SPACE)
        return self.sp.normalize(text) in (want, SPACE + want)

    def _stable(self, text: str, start: int, end: int) -> list[int]:
        """Positions in [start, end) whose left and right characters no piece joins."""
        window = text[start - 1:end]
        if not self._plain(window):
            return []
        window = window.replace(" ", SPACE)
        return [start + k for k in range(len(window) - 1) if window[k:k + 2] not in self.touching]

    def _plan(self, text: str) -> list[tuple[int, int, int]]:
        """(chunk start, chunk end, splice to the next chunk) of each chunk.
        A chunk starts before the splice it takes over at."""
        n, splice, out = len(text), 0, []
        while True:
            start, end, overlap = max(0, splice - self.overlap), min(n, splice + self.chunk), self.overlap
            while end < n:
                at = self._stable(text, max(splice + 1, end - overlap), end)
                if at:
                    break
                self.widened += 1
                if end - overlap <= splice + 1:
                    end = min(n, 2 * end - splice)  # no splice in the whole chunk: let it grow
                overlap *= 2
            if end >= n:
                out.append((start, n, n))
                return out
            splice = at[0]
            out.append((start, end, splice))

    def _starts(self, text: str) -> list[int]:
        return [a for a, _ in self.sp.encode(text, return_type="offset_mapping", num_threads=1)["offsets"]]

    def _long(self, text: str) -> int:
        plan = self._plan(text)
        if len(plan) == 1:
            return len(self.sp.encode(text))
        total, begin = 0, 0
        for start, end, splice in plan:
            starts = [start + a for a in self._starts(text[start:end])]
            own = [a for a in starts if begin <= a < splice] if begin else [a for a in starts if a < splice]
            if begin and begin not in starts or splice < end and splice not in starts:
                self.widened += 1
                return len(self.sp.encode(text))  # not aligned after all: the overlap is the whole text
            total += len(own)
            begin = splice
        return total

    def counts(self, texts: list[str]) -> list[int]:
        short = [t for t in texts if len(t) <= self.chunk]
        got = iter([len(x) for x in self.sp.encode(short, num_threads=1)] if short else [])
        return [next(got) if len(t) <= self.chunk else self._long(t) for t in texts]


def load(path: str, chunk_chars: int, overlap_chars: int) -> ChunkedCounter:
    key = (path, chunk_chars, overlap_chars)
    return worker_state(("pieces", *key), lambda: ChunkedCounter(*key))


def count_tokens(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT, chunk_chars: int = CHUNK_CHARS,
                 overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """Tokens of every whole text by the sentencepiece model file ``model``.

    Returns id_col, n_bytes long (UTF-8), n_tokens long, over_limit boolean
    (n_tokens > limit), one row for each input row: repeated rows and null ids
    stay. A null text counts as empty (no bytes, no tokens). An empty table
    gives an empty result; other columns are ignored. No shuffle; a task holds
    one Arrow batch and encodes 128 texts at a time.
    """

    importable(df.sparkSession)

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = load(model, chunk_chars, overlap_chars)
        for texts in batches:
            out: list[int] = []
            for k in range(0, len(texts), 128):
                out += counter.counts(texts.iloc[k:k + 128].tolist())
            yield pd.Series(out, dtype="int64")

    text = text_or_empty(text_col)
    out = df.select(F.col(id_col), F.octet_length(text).cast("long").alias("n_bytes"), run(text).alias("n_tokens"))
    return out.select(id_col, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
