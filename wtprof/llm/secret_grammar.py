"""Secret scan with grammars inferred from labelled credentials.

Base patterns label credentials by kind. For each kind a prefix tree of a
bounded sample of them, over coarse character classes, is folded into a
probabilistic automaton: states whose stop and branch frequencies (and those
of all their successors) agree within the Hoeffding bound are merged
(the ALERGIA rule). Each transition keeps how often each character was seen,
so a format is a chain of classes, lengths and typical characters.

A kind needs ``MIN_STRINGS`` distinct examples in the table: with fewer, its
frequencies say too little and it gets no automaton, so a table that holds
next to no credentials is scanned by the base patterns alone.

Every token-like run of every text, and each of its parts that starts and ends
at one of ``+/_.=-`` (``auth=...``, ``?sig=...``), is a candidate from the
shortest learned length up. It is a secret if some automaton accepts it, its
likelihood a character is not plainly below that of all but 1 % of that kind's
training strings, and it beats a character model of the table's ordinary words
by a margin that no sampled ordinary word reaches.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wtprof.llm.common import importable, text_or_empty, worker_state, written

KINDS = ("assign", "access", "hex")   # base kinds, in this order
FOUND = "grammar"                     # kind of spans the automata add
# Fixed patterns of the base kinds; a failing match is dropped, not retried.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
HINTS = ("passw", "secret", "token", "api")

RUN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{16,}")
RUN_FROM = r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{%d,}"
WORD = re.compile(r"(?<!\S)[A-Za-z]{4,}(?!\S)")
WORD_SHARE = 64          # ordinary words are drawn from the 64th part of all words, by hash
EDGES = "+/_.=-"         # parts of a run start after and end before one of these
EDGE = re.compile(r"[+/_.=-]")
FREE = re.compile(rb"\0+")
MEMO_CHARS, MEMO_RUNS = 64, 1 << 17   # runs kept with their answer, as words come again and again
LONG_RUN = 1024          # longer runs are searched with bounds, in time linear in the run
CHECK_EVERY = 64         # positions at which a search compares with its bounds
MAX_TRAIN = 1500         # training strings of each kind, and ordinary words (bounds the fit)
MAX_TRAIN_CHARS = 256    # longer strings are scored but not learned from
ALPHA = 0.05             # significance of the merge test
MIN_STRINGS = 20         # a kind with fewer examples gets no automaton
SLACK = 0.25             # likelihood (nats a character) a new string may lack against the training strings
MARGIN = 4.0             # log-odds above the best ordinary word

CLASS = {c: ("x" if c in "0123456789abcdef" else "l" if c.islower() else "U" if c.isupper() else c)
         for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns: whole matches, in code
    points, leftmost and non-overlapping within a kind."""
    out = []
    low = text.lower()
    if any(h in low for h in HINTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    for run in RUN.finditer(text):  # a hex run of 24 lies within one
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text, run.start(), run.end()) if len(m[0]) >= MIN_HEX]
    return sorted(out)


class Automaton:
    """Probabilistic automaton folded from a prefix tree of strings."""

    def __init__(self, strings: list[str], alpha: float = ALPHA):
        self.visits, self.stops, self.next, self.flow = [0], [0], [{}], [{}]
        for s in strings:
            self._insert([CLASS[c] for c in s])
        self.bound = math.sqrt(math.log(2 / alpha) / 2)
        self._fold_all()
        self._emissions(strings)

    def _insert(self, symbols: list[str]) -> None:
        at = 0
        self.visits[0] += 1
        for y in symbols:
            self.flow[at][y] = self.flow[at].get(y, 0) + 1
            to = self.next[at].get(y)
            if to is None:
                to = self.next[at][y] = len(self.visits)
                self.visits.append(0)
                self.stops.append(0)
                self.next.append({})
                self.flow.append({})
            at = to
            self.visits[at] += 1
        self.stops[at] += 1

    def _differ(self, n1: int, f1: int, n2: int, f2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) > self.bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n1, n2 = self.visits[a], self.visits[b]
            if self._differ(n1, self.stops[a], n2, self.stops[b]):
                return False
            for y in self.flow[a].keys() | self.flow[b].keys():
                if self._differ(n1, self.flow[a].get(y, 0), n2, self.flow[b].get(y, 0)):
                    return False
                if y in self.next[a] and y in self.next[b]:
                    todo.append((self.next[a][y], self.next[b][y]))  # b's part is a tree: this ends
        return True

    def _fold(self, a: int, b: int) -> None:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.visits[a] += self.visits[b]
            self.stops[a] += self.stops[b]
            for y, f in self.flow[b].items():
                self.flow[a][y] = self.flow[a].get(y, 0) + f
                if y in self.next[a]:
                    todo.append((self.next[a][y], self.next[b][y]))
                else:
                    self.next[a][y] = self.next[b][y]

    def _fold_all(self) -> None:
        kept = [0]
        while True:
            edge = [(-self.visits[to], r, y, to) for r in kept for y, to in self.next[r].items() if to not in kept]
            if not edge:
                break
            _, r, y, b = min(edge)
            for a in kept:
                if self._compatible(a, b):
                    self.next[r][y] = a
                    self._fold(a, b)
                    break
            else:
                kept.append(b)
        self.states = len(kept)

    def _emissions(self, strings: list[str]) -> None:
        """Per state and character: (next state, log probability)."""
        seen: dict[int, Counter] = {}
        for s in strings:
            at = 0
            for c in s:
                seen.setdefault(at, Counter())[c] += 1
                at = self.next[at][CLASS[c]]
        sizes = Counter(CLASS.values())
        self.steps: dict[int, dict[str, tuple[int, float]]] = {}
        self.ends: dict[int, float] = {}
        todo, known = [0], {0}
        while todo:
            at = todo.pop()
            n = self.visits[at]
            self.ends[at] = math.log(self.stops[at] / n) if self.stops[at] else -math.inf
            step = self.steps[at] = {}
            for y, to in self.next[at].items():
                of_class = {c: seen[at][c] for c, k in CLASS.items() if k == y}
                total = sum(of_class.values()) + 0.5 * sizes[y]
                for c, k in of_class.items():
                    step[c] = (to, math.log(self.flow[at][y] / n) + math.log((k + 0.5) / total))
                if to not in known:
                    known.add(to)
                    todo.append(to)
        del self.visits, self.stops, self.next, self.flow

    def loglik(self, s: str) -> float:
        at, total = 0, 0.0
        for c in s:
            step = self.steps[at].get(c)
            if step is None:
                return -math.inf
            at, p = step
            total += p
        return total + self.ends[at]


class Ordinary:
    """Smoothed character pair model of ordinary words."""

    def __init__(self, words: list[str]):
        pairs, firsts = Counter(), Counter()
        for w in words:
            for a, b in zip("^" + w, w):
                pairs[a, b] += 1
                firsts[a] += 1
        self.p = {(a, b): math.log((pairs[a, b] + 0.1) / (firsts[a] + 0.1 * len(CLASS)))
                  for a in ["^", *CLASS] for b in CLASS}

    def loglik(self, s: str) -> float:
        return sum(map(self.p.__getitem__, zip("^" + s, s)))


class Grammar:
    """Automata by kind, the ordinary model, and their thresholds."""

    def __init__(self, credentials: dict[str, list[str]], words: list[str]):
        self.ordinary = Ordinary(words)
        self.shortest = min((len(s) for strings in credentials.values() if len(strings) >= MIN_STRINGS for s in strings), default=0)
        self.runs = re.compile(RUN_FROM % self.shortest)
        self.memo: dict[str, list[tuple[int, int]]] = {}
        self.kinds: list[tuple[str, Automaton, float, float]] = []
        for kind, strings in sorted(credentials.items()):
            if len(strings) < MIN_STRINGS:
                continue
            a = Automaton(strings)
            rates = sorted(a.loglik(s) / len(s) for s in strings)
            odds = [a.loglik(w) - self.ordinary.loglik(w) for w in words]
            self.kinds.append((kind, a, rates[len(rates) // 100] - SLACK, max([0.0, *(o for o in odds if o > -math.inf)]) + MARGIN))

    def accepts(self, s: str) -> bool:
        for _, a, rate, margin in self.kinds:
            fit = a.loglik(s)
            if fit > -math.inf and fit / len(s) >= rate and fit - self.ordinary.loglik(s) >= margin:
                return True
        return False

    def parts(self, run: str) -> list[tuple[int, int]]:
        """(start, end) of all parts of a run that are accepted: those without
        marks at their edges first, then by start, the longest first."""
        if len(run) > MEMO_CHARS:
            return self._parts(run)
        found = self.memo.get(run)
        if found is None:
            if len(self.memo) >= MEMO_RUNS:
                self.memo.clear()
            found = self.memo[run] = self._parts(run)
        return found

    def _parts(self, run: str) -> list[tuple[int, int]]:
        marks = [m.start() for m in EDGE.finditer(run)]
        ends = {*marks, len(run)}
        ordinary: list[float] = []   # log likelihood of run[:k + 1] after its first character
        found = set()
        for start in (0, *(k + 1 for k in marks)):
            if len(run) - start < self.shortest:
                break
            for _, a, rate, margin in self.kinds:
                at, total = 0, 0.0
                for k in range(start, len(run)):
                    step = a.steps[at].get(run[k])
                    if step is None:
                        break
                    at, p = step
                    total += p
                    fit = total + a.ends[at]
                    if k + 1 in ends and fit > -math.inf and fit / (k + 1 - start) >= rate:
                        ordinary = ordinary or [0.0, *accumulate(map(self.ordinary.p.__getitem__, zip(run, run[1:])))]
                        if fit - self.ordinary.p["^", run[start]] - ordinary[k] + ordinary[start] >= margin:
                            found.add((start, k + 1))
        return sorted(found, key=lambda f: (run[f[0]] in EDGES or run[f[1] - 1] in EDGES, f[0], -f[1]))


    def longest_parts(self, run: str, low: int, high: int, plain: bool) -> Iterator[tuple[int, int]]:
        """Accepted parts of run[low:high], by start and the longest from each,
        none overlapping: what :meth:`parts` lists first, without listing all
        pairs. ``plain``: only parts without marks at their edges.

        One pass from the right finds, for each automaton, how far likelihood
        and odds can still rise from each state and position (the run decides
        the path, so there is one step a state). A start that can't reach both
        thresholds is skipped at once, and a walk ends where it no longer can."""
        marks = [m.start() for m in EDGE.finditer(run, low, high)]
        starts = [k for k in (low, *(k + 1 for k in marks)) if (k == 0 or run[k - 1] in EDGES) and k < high and not (plain and run[k] in EDGES)]
        ends = {k for k in (*marks, high) if (k == len(run) or run[k] in EDGES) and k > low and not (plain and run[k - 1] in EDGES)}
        searches = [_Search(kind, self.ordinary, run, low, high, set(starts), ends) for kind in self.kinds]
        free = low
        for start in starts:
            if start >= free and len(run) - start >= self.shortest:
                end = max(s.longest(start) for s in searches)
                if end > start:
                    yield start, end
                    free = end


class _Search:
    """One automaton over a long run, with the bounds of what can still come."""

    def __init__(self, kind: tuple, ordinary: Ordinary, run: str, low: int, high: int, starts: set[int], ends: set[int]):
        _, self.automaton, self.rate, self.margin = kind
        self.ordinary, self.run, self.high, self.ends = ordinary, run, high, ends
        a = self.automaton
        self.row = {state: k for k, state in enumerate(a.steps)}
        size = len(self.row)
        stop = np.array([a.ends[s] for s in a.steps])
        step, chance = {}, {}
        for c in set(run[low:high]):
            to, p = np.full(size, size), np.full(size, -np.inf)
            for state, k in self.row.items():
                if c in a.steps[state]:
                    to[k], p[k] = self.row[a.steps[state][c][0]], a.steps[state][c][1]
            step[c], chance[c] = to, p
        # best sums from here on to some end: of (log chance - rate), and of (log chance - ordinary)
        best = np.full((2, size + 1), -np.inf)
        self.reach: dict[int, tuple[float, float]] = {}
        self.bounds: dict[int, np.ndarray] = {}
        for k in range(high, low - 1, -1):
            if k < high:
                c = run[k]
                to, p = step[c], chance[c]
                if k in starts:
                    first, here = to[self.row[0]], p[self.row[0]]
                    self.reach[k] = (here - self.rate + best[0, first], here - ordinary.p["^", c] + best[1, first])
                best = np.concatenate([best[:, to] + p, np.full((2, 1), -np.inf)], axis=1)
                best[0, :size] -= self.rate
                best[1, :size] -= ordinary.p[run[k - 1], c] if k else 0.0
            if k in ends:
                best[:, :size] = np.maximum(best[:, :size], stop)
            if k % CHECK_EVERY == 0:
                self.bounds[k] = best.copy()

    def longest(self, start: int) -> int:
        """End of the longest accepted part from ``start`` (start: none)."""
        reach = self.reach[start]
        if reach[0] < -1e-6 * (self.high - start) or reach[1] < self.margin - 1e-6 * (self.high - start):
            return start
        a, run, end = self.automaton, self.run, start
        at, total, plain = 0, 0.0, 0.0
        for k in range(start, self.high):
            step = a.steps[at].get(run[k])
            if step is None:
                break
            at, p = step
            total += p
            plain += self.ordinary.p["^" if k == start else run[k - 1], run[k]]
            if k + 1 in self.ends:
                fit = total + a.ends[at]
                if fit > -math.inf and fit / (k + 1 - start) >= self.rate and fit - plain >= self.margin:
                    end = k + 1
            if (k + 1) % CHECK_EVERY == 0 and k + 1 in self.bounds:
                likely, odds = self.bounds[k + 1][:, self.row[at]]
                room = 1e-6 * (self.high - start)  # sums from the right round differently
                if total - self.rate * (k + 1 - start) + likely < -room or total - plain + odds < self.margin - room:
                    break
        return end


def all_spans(text: str, grammar: Grammar) -> list[tuple[int, int, int]]:
    """Base spans and those the grammar adds where no base span lies; of
    accepted parts that overlap the first of :meth:`Grammar.parts` is taken."""
    base = base_spans(text)
    added = []
    taken = None     # a mark for each character within a span
    if grammar.kinds:
        for run in grammar.runs.finditer(text):
            long_ = len(run[0]) > LONG_RUN
            found = () if long_ else grammar.parts(run[0])
            if taken is None and (found or long_):
                taken = bytearray(len(text))
                for a, _, b in base:
                    taken[a:b] = b"\1" * (b - a)
            for start, end in found:
                start, end = run.start() + start, run.start() + end
                if taken.find(1, start, end) < 0:
                    taken[start:end] = b"\1" * (end - start)
                    added.append((start, len(KINDS), end))
            for plain in (True, False) if long_ else ():
                for gap in FREE.finditer(taken, run.start(), run.end()):
                    for start, end in grammar.longest_parts(run[0], gap.start() - run.start(), gap.end() - run.start(), plain):
                        start, end = run.start() + start, run.start() + end
                        taken[start:end] = b"\1" * (end - start)
                        added.append((start, len(KINDS), end))
    return sorted(base + added)


def learn(df: DataFrame, text_col: str = "text", max_train: int = MAX_TRAIN) -> Grammar:
    """Fit the grammar on a bounded sample: for each kind at most
    ``max_train`` distinct credentials, and as many distinct ordinary words
    (letters only, four or more), those with the smallest hash, out of all
    texts. Strings over 256 characters are left out of the fit."""
    importable(df.sparkSession)

    @F.pandas_udf("array<struct<kind:string,value:string>>")
    def examples(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        worker_state("secrets", dict)
        for texts in batches:
            out = []
            for text in texts:
                got = set()
                for start, kind, end in base_spans(text):
                    value = ASSIGN.fullmatch(text, start, end)[2] if kind == 0 else text[start:end]
                    got.add((KINDS[kind], value))
                got.update(("", w) for w in set(WORD.findall(text)) if crc32(w.encode()) % WORD_SHARE == 0)
                out.append([{"kind": k, "value": v} for k, v in got if len(v) <= MAX_TRAIN_CHARS])
            yield pd.Series(out)

    found = written(df.select(F.explode(examples(text_or_empty(text_col))).alias("e")).select("e.kind", "e.value")
             .groupBy("kind", "value").count().select("kind", "value"), "credentials")
    # one bounded read: the rows of smallest hash of each kind
    samples: dict[str, list[str]] = {}
    top = found.select("kind", F.struct(F.xxhash64("kind", "value").alias("h"), "value").alias("v"))
    for kind in ("", *KINDS):
        rows = top.where(F.col("kind") == kind).orderBy("v").limit(max_train).select("v.value").collect()
        samples[kind] = sorted(r[0] for r in rows)
    return Grammar({k: samples[k] for k in KINDS}, samples[""])


def scan(df: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Find the secrets of every whole text: id_col and ``spans``, an array of
    (kind, start, end) by start, then kind (assign, access, hex, grammar); in
    code points, end exclusive. One row for each input row: a null text counts
    as empty and has no spans; null ids and repeated rows stay; an empty table
    gives an empty result; other columns are ignored."""
    importable(df.sparkSession)
    names = (*KINDS, FOUND)

    @F.pandas_udf("array<struct<kind:string,start:int,end:int>>")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        worker_state("secrets", dict)
        for texts in batches:
            yield pd.Series([[{"kind": names[k], "start": a, "end": b} for a, k, b in all_spans(t, grammar)] for t in texts],
                            dtype=object)

    return df.select(F.col(id_col), spans(text_or_empty(text_col)).alias("spans"))


def redact(df: DataFrame, grammar: Grammar, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """``df`` with each secret of ``text_col`` replaced by ``mark`` (spans that
    overlap become one). Texts without secrets, null among them, stay as they
    are; so do all other columns and rows."""
    importable(df.sparkSession)

    @F.pandas_udf("string")
    def masked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = []
            for text in texts:
                parts, at = [], 0
                for start, _, end in all_spans(text, grammar) if text else ():
                    if start >= at:
                        parts += [text[at:start], mark]
                    at = max(at, end)
                out.append("".join([*parts, text[at:]]) if parts else text)
            yield pd.Series(out, dtype=object)

    return df.withColumn(text_col, masked(F.col(text_col)))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id_col, n_assign, n_access, n_hex, base_sha256 and spans (string) of a
    :func:`scan` result."""
    s = F.col("spans")
    line = F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
    base = F.filter(s, lambda x: x["kind"] != FOUND)
    base_line = F.transform(base, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
    def count(kind: str) -> Column:
        return F.size(F.filter(s, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(F.col(id_col), *map(count, KINDS), F.sha2(F.concat_ws(",", base_line), 256).alias("base_sha256"),
                        F.concat_ws(",", line).alias("spans"))
