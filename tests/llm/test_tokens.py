"""BPE codec, token counts and packing against the libraries."""

from collections import defaultdict
from hashlib import sha256
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from edges import by_rows, empty, frame, long_text, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wtprof.llm import bpe, packing, queries, token_counts

WORD, PIECE = queries.tokenizer_path(queries.WORD_BPE), queries.tokenizer_path(queries.PIECE_BPE)


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(WORD)
    t.no_padding()
    t.no_truncation()
    return t


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aabbcdehinorstTHEéßñ'.,!-0123 \n\t<|>日Σİ \U0001f642"), max_size=80))
def test_encoder_equals_library(text):
    t = Tokenizer.from_file(WORD) if not hasattr(test_encoder_equals_library, "t") else test_encoder_equals_library.t
    test_encoder_equals_library.t = t
    codec = bpe.load(WORD)
    ids = t.encode(text, add_special_tokens=False).ids
    assert codec.encode(text).tolist() == ids
    assert codec.decode(codec.encode(text)).decode() == t.decode(ids, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aeihTHWYJkKİıÉé<. \n"), st.characters(min_codepoint=0x300, max_codepoint=0x36F),
                                  st.characters(min_codepoint=0x1E00, max_codepoint=0x1EFF)), max_size=30))
def test_marks_equal_library(text):
    test_encoder_equals_library.hypothesis.inner_test(text)


def test_decomposed_capitals(library):
    codec = bpe.load(WORD)
    letters = "ABCHIJKTWYZ"
    for text in [a + chr(m) + tail for a in letters for m in range(0x300, 0x370) for tail in ("", "a", "\u0307")] + ["İ͇", "xİ͇̇ İ"]:
        for whole in (text, f"some Words {text}, {text.lower()}"):
            assert codec.encode(whole).tolist() == library.encode(whole, add_special_tokens=False).ids


def test_vocabulary_tokens_side_by_side(library):
    vocab = sorted(library.get_vocab())
    codec = bpe.load(WORD)
    for k in range(0, 6000, 3):
        text = "".join(vocab[(k * 7919 + j * 104729) % len(vocab)].replace("</w>", "") for j in range(3))
        assert codec.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_codec_rows(spark, library):
    got = bpe.codec(frame(spark), WORD)
    assert got.columns == ["doc_id", "ids", "n_tokens", "decoded"]
    want = []
    for i, t in rows():
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, np.array(ids, np.uint16).tobytes(), len(ids), library.decode(ids, skip_special_tokens=False).encode()))
    assert [tuple(map(lambda v: bytes(v) if isinstance(v, bytearray) else v, r)) for r in by_rows(got)] == \
        [tuple(r) for r in sorted(want, key=lambda r: repr((r[0], bytearray(r[1]), r[2], bytearray(r[3]))))]
    assert bpe.codec(empty(spark), WORD).count() == 0


def test_op2_digests(spark, library, duck):
    from conftest import SF_SMALL
    texts = dict(duck.sql("SELECT doc_id, text FROM documents").fetchall())
    got = queries.op2_bpe_codec(spark, SF_SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())


@pytest.mark.parametrize("chunk,overlap", [(2, 1), (7, 2), (64, 8), (1000, 50)])
def test_splices_are_exact(pieces, chunk, overlap):
    counter = token_counts.ChunkedCounter(PIECE, chunk, overlap)
    texts = [t or "" for _, t in rows() if not t or len(t) < 3000] + [
        "x" * 900, "  " * 200, " ".join(["a" * 70] * 9), long_text(300), "日本" * 100, "\n\n" * 50]
    assert counter.counts(texts) == [len(pieces.encode(t)) for t in texts]
    assert counter.widened or chunk > 100  # some overlaps hold no stable boundary


def test_token_count_rows(spark, pieces):
    got = token_counts.count_tokens(frame(spark), PIECE, chunk_chars=5000, limit=10)
    want = [(i, len((t or "").encode()), len(pieces.encode(t or "")), len(pieces.encode(t or "")) > 10) for i, t in rows()]
    assert by_rows(got) == sorted(want, key=repr)
    assert token_counts.count_tokens(empty(spark), PIECE).count() == 0


def test_op6(spark, pieces, duck):
    from conftest import SF_SMALL
    texts = duck.sql("SELECT doc_id, coalesce(text, '') FROM documents").fetchall()
    got = sorted((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in queries.op6_token_counts(spark, SF_SMALL).collect())
    assert got == sorted((i, len(t.encode()), len(pieces.encode(t))) for i, t in texts)


def test_differencing_is_a_near_equal_partition():
    rnd = np.random.default_rng(3)
    for n, m in ((0, 1), (1, 4), (50, 7), (300, 16)):
        sizes = rnd.integers(1, 200, n).tolist()
        window = packing.differencing(sizes, m)
        sums = np.bincount(window, sizes, m) if n else np.zeros(m)
        assert len(window) == n and (n < 50 or sums.max() - sums.min() <= 12)
    window, count = packing.deal([1500] * 5, 2048)
    assert count == 5  # the count rose from ceil(7500 / 2048) until each fits


def test_batch_cuts_only_what_no_window_holds():
    rnd = np.random.default_rng(5)
    for sizes in ([1500] * 5, [2048], [1], [700] * 300, rnd.integers(1, 2048, 400).tolist(), [2047] * 64 + [1] * 64):
        p = packing.pack_batch(sizes, 2048)
        full = np.bincount(p.window, p.length).astype(int)
        over = sum(sizes) % 2048
        assert full.tolist() == [2048] * (sum(sizes) // 2048) + [1 << b for b in range(10, -1, -1) if over >> b & 1]
        at = [0] * len(sizes)
        for item, start, length in sorted(zip(p.item.tolist(), p.start.tolist(), p.length.tolist())):
            assert start == at[item] and length > 0
            at[item] += length
        assert at == sizes
        for w in range(len(full)):
            o, n = p.offset[p.window == w], p.length[p.window == w]
            assert o.tolist() == (np.cumsum(n) - n).tolist()
        assert len(p.item) <= len(sizes) + len(full)  # a window gets one part of a cut document at most beside whole ones


def check_packing(pieces_rows, ids_of):
    seqs, docs = defaultdict(list), defaultdict(list)
    for r in pieces_rows:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
        docs[r["doc_id"]].append(r)
    pad = 0
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048
        pad += 2048 - at if at & (at - 1) else 0
    for doc, ids in ids_of.items():
        ids = np.append(ids, 1).astype("<u4")
        at = 0
        for r in sorted(docs[doc], key=lambda r: r["start"]):
            part = ids[r["start"]:r["start"] + r["length"]]
            assert (r["start"], r["ids_crc32"], r["doc_tokens"]) == (at, crc32(part.tobytes()), len(ids))
            at += r["length"]
        assert at == len(ids)
    return pad / max(1, sum(r["length"] for r in pieces_rows))


def test_packing_rows(spark, library):
    data = [(i, t) for i, t in rows() if i is not None and i != 7]
    got = packing.pack(frame(spark, data), WORD).collect()
    assert check_packing(got, {i: library.encode(t or "", add_special_tokens=False).ids for i, t in data}) < 0.02
    every = packing.pack(frame(spark), WORD)
    assert every.where("doc_id is null").count() and every.where("doc_id = 7 and start = 0").count() == 2
    assert packing.pack(empty(spark), WORD).count() == 0


def test_op8_packing(spark, library, duck):
    from conftest import SF_SMALL
    texts = duck.sql("SELECT doc_id, text FROM documents").fetchall()
    got = queries.op8_packing(spark, SF_SMALL).collect()
    assert check_packing(got, {i: library.encode(t or "", add_special_tokens=False).ids for i, t in texts}) < 0.02
    assert public_tokenizers.path(queries.WORD_BPE) == WORD
