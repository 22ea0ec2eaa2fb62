"""BPE encoding and decoding by the backtracking method.

Encoder: an Aho-Corasick automaton over the vocabulary lists every token that
starts at each position of a word. Taking the longest first, a token is kept
only if it is compatible with the one before it; otherwise the next shorter
one is tried, and when none is left the previous token is given up. Positions
proven to be dead ends are marked, so each is expanded at most once and the
work is linear in the word. A token sequence whose neighbours are all
compatible is exactly the sequence that merging by rank produces.

Compatibility of neighbours (a, b): let x run down the right edge of a's
merge tree and y down the left edge of b's. A symbol lives from the merge that
makes it until the merge that consumes it. (a, b) is broken if some x and y
that live at the same time would be merged with each other before either is
consumed. Verdicts are kept in a pair table.

Decoder: all token strings lie in one byte array with an offset table; the
bytes of a sequence are gathered from it.

White space never takes part in a token of this kind of vocabulary (words end
in ``</w>``), so a text is encoded chunk by chunk between ASCII white space,
and frequent chunks are kept in a bounded table.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from hashlib import sha256

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wtprof.llm.common import importable, text_or_empty, worker_state

END = ""          # stands for the end-of-word suffix inside patterns
MAX_CHUNKS = 1_000_000  # entries of the chunk table of one Python worker
MAX_PAIRS = 1_000_000
KEEP_LEN = 48           # longer chunks are encoded but not kept
PIECE = b" "            # no chunk holds a blank
TEXT_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
MARKS = TEXT_MARKS.encode()


def byte_symbols() -> list[str]:
    """Printable stand-in of each byte (the byte-level alphabet): printable
    Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [""] * 256, 0
    for b in range(256):
        if b in own:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + extra)
            extra += 1
    return out


class _Chunks(dict):
    """chunk bytes → uint16 ids; fills itself. A pre-tokenized piece stands
    under PIECE and its bytes: it is normalised already."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode
        self.old: dict[bytes, bytes] = {}   # entries of before the last turn, taken over when used again

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self.old.pop(chunk, None)
        if ids is None:
            ids = self.encode(chunk)
        if len(chunk) <= KEEP_LEN:
            if len(self) >= MAX_CHUNKS // 2:
                self.old = self.copy()
                self.clear()
            self[chunk] = ids
        return ids


class WordBpe:
    """Word-suffix byte-level BPE read from a ``tokenizers`` JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        self.path = path
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        if max(self.tokens) >= 1 << 16:
            raise ValueError("token ids must fit 16 bits")
        # merge rank of a token and its two parts; single symbols have none
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        self.merge: dict[tuple[int, int], int] = {}
        for r, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            ia, ib, made = self.vocab[a], self.vocab[b], self.vocab.get(a + b)
            self.merge.setdefault((ia, ib), r)
            if made is not None and made not in self.rank:
                self.rank[made], self.parts[made] = r, (ia, ib)
        self.pairs: dict[int, dict[int, bool]] = {}   # verdicts by left token
        self.verdicts = 0
        self._edges_right: dict[int, list] = {}
        self._edges_left: dict[int, list] = {}
        self.automaton = ahocorasick.Automaton()
        keys = {t[: -len(suffix)] + END if t.endswith(suffix) and t != suffix else t: i
                for t, i in self.vocab.items() if self._makes_itself(i)}
        self.size = [0] * (max(self.tokens) + 1)      # symbols of each token
        self.shorter = [-1] * (max(self.tokens) + 1)  # its longest proper prefix that is a token
        # tokens of one or two symbols are found by a look-up where no longer one starts
        self.brief = {key: i for key, i in keys.items() if len(key) < 3}
        for key, i in keys.items():
            if len(key) >= 3:
                self.automaton.add_word(key, (len(key) - 1, i))
            self.size[i] = len(key)
            self.shorter[i] = next((keys[key[:k]] for k in range(len(key) - 1, 0, -1) if key[:k] in keys), -1)
        self.automaton.make_automaton()
        self.symbol = byte_symbols()
        self.chunks = _Chunks(self._encode_chunk)
        self.plain = re.compile("[\x21-\x7e\xa1-ɏ]+")
        # fixed pattern of the vocabulary's pre-tokenizer
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self._slow = None
        strings = [self.tokens.get(i, "") + " " for i in range(max(self.tokens) + 1)]
        self.token_blob, self.token_offsets = offset_table(strings)
        self.digit_blob, self.digit_offsets = offset_table([f"{i} " for i in range(max(self.tokens) + 1)])

    # -- merge-tree edges and the pair table -------------------------------

    def _edge(self, i: int, right: bool) -> list[tuple[int, float]]:
        """(symbol, rank of the merge that consumes it) down one edge; the
        token itself is never consumed."""
        memo = self._edges_right if right else self._edges_left
        if i not in memo:
            out, death, at = [], float("inf"), i
            while True:
                out.append((at, death))
                if at not in self.parts:
                    break
                death, at = self.rank[at], self.parts[at][1 if right else 0]
            memo[i] = out
        return memo[i]

    def _broken(self, a: int, b: int, limit: float) -> bool:
        """Would a merge across the boundary happen before rank ``limit``?
        At equal rank the leftmost merge is first: inside ``a`` before the
        boundary, the boundary before inside ``b``."""
        rank = self.rank
        for x, dies_x in self._edge(a, True):
            dies_x = min(dies_x, limit)
            born_x = rank.get(x, -1)
            for y, dies_y in self._edge(b, False):
                dies_y = min(dies_y, limit)
                if born_x >= dies_y:
                    break  # y and all further down are consumed before x exists: none meets x
                if rank.get(y, -1) >= dies_x:
                    continue
                r = self.merge.get((x, y))
                if r is not None and r < dies_x and (r <= dies_y if dies_y < limit else r < dies_y):
                    return True
        return False

    def compatible(self, a: int, b: int) -> bool:
        """Verdict on neighbours, from the pair table or added to it."""
        row = self.pairs.get(a)
        if row is None:
            row = self.pairs[a] = {}
        ok = row.get(b)
        if ok is None:
            self.verdicts += 1
            ok = row[b] = not self._broken(a, b, float("inf"))
        return ok

    def _makes_itself(self, i: int) -> bool:
        """Does merging the symbols of this token end in the token?"""
        if i not in self.parts:
            return len(self.tokens[i]) == 1 or self.tokens[i].endswith("</w>")
        a, b = self.parts[i]
        return self._makes_itself(a) and self._makes_itself(b) and not self._broken(a, b, self.rank[i])

    # -- encoding -----------------------------------------------------------

    def encode_word(self, symbols: str) -> list[int]:
        """Tokens of one pre-tokenized word in byte symbols."""
        word = symbols + END
        n, size, shorter, pairs, brief = len(word), self.size, self.shorter, self.pairs, self.brief
        if self.verdicts >= MAX_PAIRS:
            pairs.clear()
            self.verdicts = 0
        # ends ascend, so the longest of a start comes last
        longest = {end - back: i for end, (back, i) in self.automaton.iter(word)} if n > 2 else {}
        dead: set[int] = set()
        ids: list[int] = []
        row: dict[int, bool] = {}
        pos, prev, fresh, tok = 0, -1, True, -1
        while True:
            if fresh:
                tok = longest.get(pos, -1)
                if tok < 0:
                    tok = brief.get(word[pos:pos + 2], -1)
                    if tok < 0:
                        tok = brief.get(word[pos], -1)
            while tok >= 0:
                if prev < 0 or (row[tok] if tok in row else self.compatible(prev, tok)):
                    after = pos + size[tok]
                    if after not in dead:
                        break
                tok = shorter[tok]
            if tok >= 0:
                ids.append(tok)
                if after == n:
                    return ids
                pos, prev, fresh = after, tok, True
                row = pairs.get(tok)
                if row is None:
                    row = pairs[tok] = {}
            elif ids:
                dead.add(pos)
                tok = ids.pop()
                pos -= size[tok]
                prev, fresh, tok = ids[-1] if ids else -1, False, shorter[tok]
                if ids:
                    row = pairs[prev]
            else:
                raise ValueError(f"no encoding of {symbols!r}")

    def _pieces_of(self, text: str) -> list[str]:
        """Normalise and pre-tokenize. Printable Latin is done here (it is
        NFC already and lower-cases char by char); anything else goes through
        the library's own normalizer and splitter."""
        if self.plain.fullmatch(text):
            return self.split.findall(text.lower())
        if self._slow is None:
            from tokenizers import Tokenizer
            t = Tokenizer.from_file(self.path)
            self._slow = t.normalizer, t.pre_tokenizer
            self._bytes = {s: b for b, s in enumerate(self.symbol)}
        norm, pre = self._slow
        return [bytes(map(self._bytes.__getitem__, s)).decode("utf-8", "surrogatepass")
                for s, _ in pre.pre_tokenize_str(norm.normalize_str(text))]

    def _encode_chunk(self, chunk: bytes) -> bytes:
        if chunk[:1] == PIECE:
            return array("H", self.encode_word("".join(map(self.symbol.__getitem__, chunk[1:])))).tobytes()
        if chunk.isalpha():  # ASCII letters: one piece
            return array("H", self.encode_word(chunk.decode().lower())).tobytes()
        # letters and marks after them are two pieces: the letters stand in the table by themselves
        core = chunk.rstrip(MARKS)
        if core.isalpha():
            return self.chunks[core] + self.chunks[PIECE + chunk[len(core):]]
        text, out = chunk.decode("utf-8"), []
        if not core.isascii():
            word = text.rstrip(TEXT_MARKS)
            low = word.lower()
            if low.isalpha() and self.plain.fullmatch(word):
                first = self.chunks[PIECE + low.encode()]
                return first + self.chunks[PIECE + text[len(word):].encode()] if len(word) < len(text) else first
        for part in (self.specials.split(text) if "<|" in text else (text,)):
            if part in self.special:
                out.append(array("H", [self.special[part]]).tobytes())
                continue
            for piece in self._pieces_of(part) if part else ():
                raw = piece.encode("utf-8", "surrogatepass")
                out.append(self.chunks[raw if raw.islower() and raw.isalpha() else PIECE + raw])
        return b"".join(out)

    def encode(self, text: str) -> np.ndarray:
        """Token ids (uint16) of a whole text."""
        raw = text.encode()
        # ASCII letters may be lowered first where no combining mark (U+0300 to U+036F)
        # could join one: the tokenizer composes before it lowers. The rest is
        # normalised chunk by chunk.
        if b"<|" not in raw and b"\xcc" not in raw and b"\xcd" not in raw:
            raw = raw.lower()
        return np.frombuffer(b"".join(map(self.chunks.__getitem__, raw.split())), np.uint16)

    # -- decoding -----------------------------------------------------------

    def decode(self, ids: np.ndarray) -> bytes:
        """Token strings joined by one space, UTF-8."""
        return gather(self.token_blob, self.token_offsets, ids)[:-1]

    def digits(self, ids: np.ndarray) -> bytes:
        """Decimal ids joined by one space."""
        return gather(self.digit_blob, self.digit_offsets, ids)[:-1]


def offset_table(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [s.encode() for s in strings]
    offsets = np.zeros(len(raw) + 1, np.int32)
    np.cumsum([len(r) for r in raw], out=offsets[1:])
    return np.frombuffer(b"".join(raw), np.uint8), offsets


def gather(blob: np.ndarray, offsets: np.ndarray, ids: np.ndarray, step: int = 1 << 17) -> bytes:
    """Concatenate blob[offsets[i]:offsets[i+1]] over ``ids``, in steps of
    bounded size."""
    out = []
    for k in range(0, len(ids), step):
        part = ids[k:k + step]
        start = offsets[part]
        length = offsets[part.astype(np.int32) + 1] - start
        ends = np.cumsum(length, dtype=np.int64)
        index = np.repeat(start - (ends - length), length)
        index += np.arange(ends[-1] if len(ends) else 0)
        out.append(blob[index].tobytes())
    return b"".join(out)


def load(path: str) -> WordBpe:
    """The codec of a vocabulary, kept by the Python worker."""
    return worker_state(("bpe", path), lambda: WordBpe(path))


def codec(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every whole text.

    Returns id_col, ids (binary, uint16), n_tokens long,
    decoded binary (UTF-8) for each row of ``df``; other columns are ignored.
    A null text counts as empty: no ids, empty decoding. Repeated rows and
    null ids are kept as they are. An empty table gives an empty result.
    """
    importable(df.sparkSession)

    @F.pandas_udf("ids binary, n_tokens long, decoded binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = load(vocabulary)
        for texts in batches:
            ids = [bpe.encode(t) for t in texts]
            yield pd.DataFrame({"ids": [x.tobytes() for x in ids], "n_tokens": [len(x) for x in ids],
                                "decoded": [bpe.decode(x) for x in ids]})

    out = df.select(F.col(id_col), run(text_or_empty(text_col)).alias("_r"))
    return out.select(id_col, "_r.ids", "_r.n_tokens", "_r.decoded")


def codec_digests(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As :func:`codec`, but only the digests leave the task: id_col,
    n_tokens long, ids_sha256, decoded_sha256 (lowercase hex)."""
    importable(df.sparkSession)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = load(vocabulary)
        for texts in batches:
            rows = []
            for t in texts:
                ids = bpe.encode(t)
                rows.append((len(ids), sha256(bpe.digits(ids)).hexdigest(), sha256(bpe.decode(ids)).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    out = df.select(F.col(id_col), run(text_or_empty(text_col)).alias("_r"))
    return out.select(id_col, "_r.n_tokens", "_r.ids_sha256", "_r.decoded_sha256")
