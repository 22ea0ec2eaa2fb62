"""Text cleaning and tokenising as native expressions (no Python UDFs).

All of these compile into whole-stage codegen; none moves a row to Python.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results.
# Replacement for a literal "/.." in decoded URL text.
TRAVERSAL_TOKEN = " pathsearcherdetected "
# Characters that are each replaced by one space after decoding.
SYMBOL_CLASS = r"[\-%./!@#$?,;:&*)(+=0-9_]"
# Stop words of the TF-IDF vectoriser (board-page words).
STOP_WORDS = ["bbs", "write", "modify", "board", "delete", "id", "contents", "writer", "page"]
# Token rule: runs of two or more word characters (letters, digits, underscore).
TOKEN_REGEX = r"[\p{L}\p{N}_]{2,}"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def url_decode_lenient(c) -> Column:
    """Percent-decode; keep malformed escapes (``%zz``, lone ``%``) and ``+``.

    ``url_decode`` raises on a bad escape and turns ``+`` into a space, so
    bad ``%`` are first escaped to ``%25`` and ``+`` to ``%2B``. Text without
    any ``%`` is its own decoding.
    """
    guarded = F.regexp_replace(F.regexp_replace(_c(c), r"%(?![0-9A-Fa-f]{2})", "%25"), r"\+", "%2B")
    return F.when(F.contains(_c(c), F.lit("%")), F.url_decode(guarded)).otherwise(_c(c))


def mark_traversal(c) -> Column:
    """Literal ``/..`` → `` pathsearcherdetected `` (every occurrence)."""
    return F.replace(_c(c), F.lit("/.."), F.lit(TRAVERSAL_TOKEN))


def strip_symbols(c) -> Column:
    """Each symbol or digit of :data:`SYMBOL_CLASS` → one space."""
    return F.regexp_replace(_c(c), SYMBOL_CLASS, " ")


def clean_text(c) -> Column:
    """decode → mark traversal → strip symbols, as one expression."""
    return strip_symbols(mark_traversal(url_decode_lenient(c)))


def remove_punctuation(c) -> Column:
    """Drop the 32 ASCII punctuation marks."""
    return F.regexp_replace(_c(c), r"\p{Punct}", "")


def tokenize(c, pattern: str = TOKEN_REGEX) -> Column:
    """Lower-case, then all runs of ≥2 word characters, in order (repeats kept)."""
    return F.regexp_extract_all(F.lower(F.coalesce(_c(c), F.lit(""))), F.lit(pattern), 0)


def remove_stop_words(tokens, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """Filter stop words out of a token array, keeping repeats and order."""
    stop = F.array(*[F.lit(w) for w in stop_words])
    return F.filter(_c(tokens), lambda t: ~F.array_contains(stop, t))


def bind(expr: Column, fn) -> Column:
    """Evaluate ``expr`` once and pass it to ``fn`` as a lambda variable.

    Referencing an expression inside an element lambda re-evaluates it per
    element; binding it through a one-element ``transform`` does not.
    """
    return F.get(F.transform(F.array(expr), fn), 0)


def ngrams(tokens, lo: int = 1, hi: int = 1) -> Column:
    """Word n-grams of length lo..hi, joined by one space, in sklearn order
    (all unigrams, then all bigrams, ...)."""
    def build(arr):
        parts = []
        for n in range(lo, hi + 1):
            if n == 1:
                parts.append(arr)
                continue
            count = F.size(arr) - F.lit(n - 1)
            idx = F.filter(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: i <= count)
            parts.append(F.transform(idx, lambda i: F.array_join(F.slice(arr, i, n), " ")))
        return parts[0] if len(parts) == 1 else F.concat(*parts)

    if hi <= 1:
        return build(_c(tokens))
    return bind(_c(tokens), build)
