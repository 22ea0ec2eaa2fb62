"""Toxicity by a subsequence string-kernel SVM with Nyström landmarks.

Kernel of two words: the inner product of their gap-weighted character
subsequences of length three (within a span of five characters, a gap costs a
factor ``DECAY``), over words with a start and an end mark, each scaled to unit
energy. Insults with inserted, dropped or spaced characters keep most of
their subsequences.

A labelled sentence is represented by its witness, the word of it that the
current model holds most toxic. Words are mapped to the Nyström features of
landmark words, and a linear SVM (squared hinge, Newton steps) is trained on
the witnesses; then witnesses are chosen anew. Sentences of toxic documents
without a toxic witness drop out: most sentences of such a document are
clean. The SVM is linear in the landmarks' subsequences, so the fitted model
is one weight for each (hashed) subsequence, and scoring is a table look-up.
A document's score is a logistic function of its highest word score, so one
insult is enough; it is fitted on labelled documents the SVM has not seen.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wtprof.llm.common import importable, text_or_empty, worker_state, written

GAPS = ((1, 1), (1, 2), (2, 1), (1, 3), (2, 2), (3, 1))  # distances between the three characters
DECAY = 0.6
TABLE_BITS = 20
LANDMARKS = 384
NEGATIVES = 2000          # hard and frequent clean words of a round
TRAIN_DOCS = 4000         # labelled documents of each class that a fit reads at most
TRAIN_SENTENCES = 15_000  # their distinct sentences of each class at most (by hash)
ROUNDS = 3
COST = 100.0
FIRST_ODDS = 2.5          # log of how many times as frequent the first witnesses must be, and
FIRST_MARGIN = 3.0        # log-odds by which the first witnesses must beat chance over the vocabulary
SENTENCE_WORDS = 32       # longer sentences are cut
WORD_CHARS = 64           # longer words are scored in overlapping windows
MAX_WORDS = 300_000       # entries of a Python worker's word table
EDGE = "\"'.,;:!?()[]{}<>…«»„“”‘’*%&$#@+-_/\\|~^`="
SPACED = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")  # letters written one by one, over any white space


def words_of(text: str) -> list[str]:
    """Lower-cased words; a run of single letters also counts as one word."""
    low = text.lower()
    return low.split() + ["".join(m[0].split()) for m in SPACED.finditer(low)]


def sentences_of(text: str) -> list[str]:
    out = []
    for s in re.split(r"[.!?\n]+", text):
        words = s.split()
        out += [" ".join(words[k:k + SENTENCE_WORDS]) for k in range(0, len(words), SENTENCE_WORDS)]
    return out


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, hashed subsequence, weight) of all words' subsequences, each
    word's weights scaled to unit energy."""
    marked = ["^" + w.strip(EDGE)[:WORD_CHARS] + "$" for w in words]
    chars = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), [len(m) for m in marked])
    at, code, weight = [], [], []
    for d1, d2 in GAPS:
        n = len(chars) - d1 - d2
        if n <= 0:
            continue
        ok = owner[:n] == owner[d1 + d2:]
        a, b, c = chars[:n][ok], chars[d1:n + d1][ok], chars[d1 + d2:][ok]
        h = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (c * np.uint64(0x165667B19E3779F9))
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        at.append(owner[:n][ok])
        code.append((h >> np.uint64(64 - TABLE_BITS)).astype(np.int64))
        weight.append(np.full(len(code[-1]), DECAY ** (d1 + d2 - 2)))
    if not at:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    at, code, weight = np.concatenate(at), np.concatenate(code), np.concatenate(weight)
    energy = np.bincount(at, weight ** 2, len(words))
    return at, code, weight / np.sqrt(energy[at])


class Model:
    """Subsequence weights, bias, and the logistic of the highest word score."""

    def __init__(self, table: np.ndarray, bias: float):
        self.table, self.bias = table.astype(np.float32), bias
        self.slope, self.offset = 4.0, 0.0

    def word_scores(self, words: list[str]) -> np.ndarray:
        at, code, weight = subsequences(words)
        return np.bincount(at, weight * self.table[code], len(words)) + self.bias


def _svm(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Squared-hinge linear SVM by Newton steps; the last weight is the bias."""
    z = np.hstack([z, np.ones((len(z), 1))])
    w = np.zeros(z.shape[1])
    ridge = np.eye(z.shape[1]) / COST
    ridge[-1, -1] = 1e-6
    for _ in range(30):
        active = y * (z @ w) < 1
        za, wa = z[active], weight[active]
        new = np.linalg.solve(ridge + za.T @ (za * wa[:, None]), za.T @ (wa * y[active]))
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w


def _explicit(words: list[str], marks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nyström features of ``words`` for landmark words ``marks``, and what
    turns weights on features into weights on subsequences (codes, matrix)."""
    at, code, weight = subsequences(marks)
    used, of = np.unique(code, return_inverse=True)
    phi = np.zeros((len(used), len(marks)))
    np.add.at(phi, (of, at), weight)
    value, vector = np.linalg.eigh(phi.T @ phi)
    keep = value > 1e-6 * value.max()
    base = phi @ (vector[:, keep] / np.sqrt(value[keep]))
    out = np.zeros((len(words), keep.sum()))
    for k in range(0, len(words), 1000):
        at, code, weight = subsequences(words[k:k + 1000])
        where = np.minimum(np.searchsorted(used, code), len(used) - 1)
        ok = used[where] == code
        part = np.zeros((len(words[k:k + 1000]), len(used)))
        np.add.at(part, (at[ok], where[ok]), weight[ok])
        out[k:k + 1000] = part @ base
    return out, used, base


def _runs(word: str) -> set[str]:
    marked = "^" + word + "$"
    return {marked, *(marked[i:i + size] for size in (4, 5) for i in range(len(marked) - size + 1))}


def _first_witnesses(vocab: list[str], pos: list[np.ndarray], neg: list[np.ndarray]) -> np.ndarray:
    """Which words are the first witnesses: those with a run of characters (or
    the whole word) that is many times as frequent in toxic sentences, so
    plainly that chance would hardly give one such run among all (by
    log-likelihood ratio). The best run is taken first and the sentences it
    explains are set aside, so that chance neighbours of an insult are not."""
    runs: dict[str, int] = {}
    of = [np.array([runs.setdefault(g, len(runs)) for g in sorted(_runs(w))]) for w in vocab]

    def incidence(side: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        each = [np.unique(np.concatenate([of[k] for k in s])) for s in side]
        return np.repeat(np.arange(len(side)), [len(e) for e in each]), np.concatenate(each)

    (ps, pr), (_, nr) = incidence(pos), incidence(neg)
    b = np.bincount(nr, minlength=len(runs)).astype(float)
    chosen = np.zeros(len(runs), bool)
    while len(ps):
        a, left = np.bincount(pr, minlength=len(runs)).astype(float), len(np.unique(ps))
        n, rate = a + b, left / (left + len(neg))
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = a * np.log(np.maximum(a, 1e-9) / (n * rate)) + b * np.log(np.maximum(b, 1e-9) / (n * (1 - rate)))
        odds = np.log((a + 0.5) / (b + 0.5)) - np.log(rate / (1 - rate))
        fit = np.where((odds > FIRST_ODDS) & (a > 0), ratio, 0)
        best = int(np.argmax(fit))
        if fit[best] < np.log(len(runs)) + FIRST_MARGIN:
            break
        chosen[best] = True
        stay = ~np.isin(ps, ps[pr == best])
        ps, pr = ps[stay], pr[stay]
    return np.array([chosen[k].any() for k in of])


def fit_svm(positive: list[str], negative: list[str], landmarks: int = LANDMARKS) -> Model:
    """Train on sentences of toxic and of clean documents."""
    model = Model(np.zeros(1 << TABLE_BITS), -1.0)
    pos, neg = ([x for x in (sorted({w.strip(EDGE)[:WORD_CHARS] for w in words_of(s)} - {""}) for s in side) if x]
                for side in (positive, negative))
    if not pos or not neg:
        return model
    in_pos, in_neg = Counter(w for s in pos for w in s), Counter(w for s in neg for w in s)
    vocab = sorted(in_pos.keys() | in_neg.keys())
    number = {w: k for k, w in enumerate(vocab)}
    pos_ids, neg_ids = ([np.array([number[w] for w in s]) for s in side] for side in (pos, neg))
    a, b = (np.array([c[w] for w in vocab], float) for c in (in_pos, in_neg))
    first = _first_witnesses(vocab, pos_ids, neg_ids) & (a > b)
    score = np.where(first, a, -1.0)
    frequent = np.argsort(-b, kind="stable")[:NEGATIVES]
    clean = b > 0  # a word that only toxic sentences have is never a negative
    for _ in range(ROUNDS):
        best = np.array([s[np.argmax(score[s])] for s in pos_ids])
        wp, cp = np.unique(best[score[best] > 0], return_counts=True)
        if not len(wp):
            break
        hard = np.flatnonzero(clean)[np.argsort(-score[clean], kind="stable")[:NEGATIVES]]
        wn = np.unique(np.concatenate([[s[np.argmax(np.where(clean[s], score[s], -np.inf))] for s in neg_ids], hard, frequent]))
        wn = wn[clean[wn] & ~np.isin(wn, wp)].astype(int)
        third = landmarks // 3
        marks = np.unique(np.concatenate([wp[np.argsort(-cp, kind="stable")[:third]], hard[:third], frequent[:third]]))
        x, used, base = _explicit([vocab[k] for k in np.concatenate([wp, wn])], [vocab[k] for k in marks])
        y = np.concatenate([np.ones(len(wp)), -np.ones(len(wn))])
        many = np.sqrt(np.concatenate([cp, b[wn]]))
        w = _svm(x, y, many)
        table = np.zeros(1 << TABLE_BITS)
        table[used] = base @ w[:-1]
        model = Model(table, float(w[-1]))
        score = np.concatenate([model.word_scores(vocab[k:k + 20_000]) for k in range(0, len(vocab), 20_000)])
    return model


class _Scores(dict):
    """word → score, in a bounded table."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    @staticmethod
    def _readings(word: str) -> list[str]:
        """The word, also without marks put between its letters, in windows."""
        out = [word]
        if not word.strip(EDGE).isalnum():
            bare = "".join(filter(str.isalnum, word))
            out += [bare] if bare else []
        return [w[j:j + WORD_CHARS] for w in out for j in range(0, max(1, len(w) - WORD_CHARS // 2), WORD_CHARS // 2)]

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self]
        if len(self) + len(new) > MAX_WORDS:
            self.clear()
            new = list(words)
        for k in range(0, len(new), 8000):
            part = new[k:k + 8000]
            pieces = [self._readings(w) for w in part]
            got = iter(self.model.word_scores([p for ps in pieces for p in ps]).tolist())
            self.update((w, max(next(got) for _ in ps)) for w, ps in zip(part, pieces))


def _top_scores(texts: list[str], table: _Scores) -> np.ndarray:
    """The highest word score of each text (the bias if it has no word)."""
    out = np.empty(len(texts))
    for k in range(0, len(texts), 500):
        sets = [set(words_of(t)) for t in texts[k:k + 500]]
        table.learn(set().union(*sets))
        out[k:k + 500] = [max(map(table.__getitem__, s), default=table.model.bias) for s in sets]
    return np.clip(out, -1, 1)  # beyond the margin a score says no more


def _scored(df: DataFrame, model: Model, keep: list, text_col: str) -> DataFrame:
    """``keep`` columns and the highest word score of each row."""
    spark = df.sparkSession
    importable(spark)
    shared = spark.sparkContext.broadcast(model)  # one table of 2^20 weights
    key = f"{spark.sparkContext.applicationId}-{shared._jbroadcast.id()}"

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = worker_state(("toxicity", key), lambda: _Scores(shared.value))
        for texts in batches:
            yield pd.Series(_top_scores(texts.tolist(), table))

    return df.select(*keep, run(text_or_empty(text_col)).alias("top"))


def held_out(id_col: str) -> Column:
    """Is the crc32 of the id as text divisible by five? (null id: as empty text)"""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        train_docs: int = TRAIN_DOCS, train_sentences: int = TRAIN_SENTENCES) -> Model:
    """Fit on labelled documents that are not held out.

    Of each class at most ``train_docs`` documents (smallest hash of the id)
    are read: two thirds give sentences for the SVM (at most
    ``train_sentences`` distinct ones a class), the rest fit the logistic.
    Of a word over 64 characters the first 64 are learned from. Null labels
    and ids don't count; of repeated labels the largest does. With one class
    only, or no labels, the model calls everything clean.
    """
    importable(df.sparkSession)
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(id_col))
             .groupBy(id_col).agg(F.max(label_col).cast("int").alias("label")))
    known = known.select(F.col(id_col).alias("l_id"), "label", F.xxhash64(F.lit("fit"), id_col).alias("h"))
    known = written(known, "labels")
    drawn, of_class = None, {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    for y in (0, 1):
        part = known.where(F.col("label") == y).orderBy("h", "l_id").limit(train_docs)
        drawn = part if drawn is None else drawn.union(part)
    texts = df.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    sample = written(texts.join(F.broadcast(drawn), texts["id"] == drawn["l_id"])  # at most 2 x train_docs ids
                     .select("text", "label", (F.pmod("h", F.lit(3)) == 0).alias("second")), "labelled")

    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series) -> pd.Series:
        # a word is learned from by its first characters, as in fit_svm
        return pd.Series([[" ".join(w.lstrip(EDGE)[:WORD_CHARS] or w[:1] for w in s.split()) for s in sentences_of(t)] for t in texts])

    lines = sample.where(~F.col("second")).select("label", F.explode(cut("text")).alias("s")).groupBy("s").agg(
        F.max("label").alias("label"))
    lines = written(lines, "sentences")
    sides = [[r["s"] for r in lines.where(F.col("label") == y).orderBy(F.xxhash64("s"), "s").limit(train_sentences)
              .select("s").collect()] for y in (1, 0)]
    model = fit_svm(*sides)
    rows = _scored(sample.where("second"), model, ["label"], "text").collect()  # at most 2 x train_docs
    if {r["label"] for r in rows} == {0, 1}:
        y = np.array([r["label"] for r in rows], float)
        share = of_class[1] / (of_class[0] + of_class[1])  # classes count as often as among all labels
        weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
        model.slope, model.offset = _logistic(np.array([r["top"] for r in rows]), y, weight)
    return model


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of a weighted logistic regression, slope not negative."""
    mean, scale = x.mean(), max(x.std(), 1e-9)
    z = np.stack([(x - mean) / scale, np.ones(len(x))], axis=1)
    def loss(w: np.ndarray) -> float:
        t = np.where(y == 1, 1, -1) * (z @ w)
        return float((weight * np.logaddexp(0, -t)).mean() + 5e-4 * w[0] ** 2)

    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        grad = z.T @ (weight * (p - y)) / len(y) + 1e-3 * np.array([w[0], 0])
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z / len(y) + 1e-3 * np.eye(2)
        step, size = np.linalg.solve(hess, grad), 1.0
        while loss(w - size * step) > loss(w) and size > 1e-6:
            size /= 2
        w = w - size * step
    slope = max(w[0], 0.0) / scale
    return float(slope), float(w[1] - slope * mean)


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, held_out, score (0 to 1) and predicted (1 if score >= 0.5) of
    every whole text; null and empty texts score as a text without toxic
    words; a score of exactly 0.5 is predicted toxic. One row for each input row, null ids and repeated rows too; an
    empty table gives an empty result; other columns are ignored."""
    top = _scored(df, model, [F.col(id_col)], text_col)
    return top.select(id_col, held_out(id_col).alias("held_out"), _probability(model).alias("score")).select(
        "*", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def _probability(model: Model) -> Column:
    z = F.col("top") * model.slope + model.offset
    return 1 / (1 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), z))))


def keep_clean(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Rows of ``df`` whose text is not predicted toxic, all columns."""
    kept = _scored(df, model, [F.struct(*df.columns).alias("row")], text_col)
    return kept.where(_probability(model) < 0.5).select("row.*")
