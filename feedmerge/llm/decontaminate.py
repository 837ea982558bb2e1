"""Benchmark passages in documents, by a generalised suffix automaton of the items.

Words are runs of ASCII letters, digits and other characters from U+0080, A-Z as a-z.
All items are put into one suffix automaton over words. A document's words stream
through it; at each word the automaton knows the longest match that ends there. A
match of at least ``window`` words marks that many words as hit and names the items
that hold them; an item shorter than that counts only as a whole.

The automaton runs where it can leave its root for long enough: stretches whose
consecutive word pairs all occur in items, found by comparing hashes in bulk. The
automaton itself compares the words, so equal hashes of different words cost time and
never change a result.

The items of one automaton have at most about ``MAX_WORDS`` words. A larger benchmark is
cut into as many automata as it takes, whole items each, and the documents pass through them one
after another. Only a benchmark part travels with the tasks, after its size is known.

Null and empty texts have no words and are never hit; nor do items without words
occur. Items with a null id mark words but are not listed, equal ids are listed once. Rows
with equal ids are judged one by one; other columns pass through ``mark_spans``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ByteTables, PowerTable, Scratch, Words, ascii_lower, with_columns

WINDOW = 13
#: A document is contaminated when hits reach one word in this many.
COVERAGE = 20
MAX_WORDS = 200_000

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(ascii_lower(text)) if text else []


class SuffixAutomaton:
    """Every run of words of any item leads to one state."""

    def __init__(self, items: Iterable[tuple[str | None, list[str]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ids: list[str | None] = []
        self.at: list[set[int]] = [set()]
        whole = []
        for name, words in items:
            if not words:
                continue
            k = len(self.ids)
            self.ids.append(name)
            last = 0
            for w in words:
                last = self._extend(last, w)
                self.at[last].add(k)
            if len(words) < window:
                whole.append((k, words))
        #: items shorter than the window, at the state of their whole text
        self.short: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for k, words in whole:
            state = 0
            for w in words:
                state = self.next[state][w]
            self.short[state].append((len(words), k))
        order = sorted(range(1, len(self.next)), key=self.length.__getitem__)
        #: the nearest state with short items along the links, itself included
        self.marked = [-1] * len(self.next)
        self.children: list[list[int]] = [[] for _ in self.next]
        for v in order:
            self.children[self.link[v]].append(v)
            self.marked[v] = v if self.short[v] else self.marked[self.link[v]]
        self._items: dict[int, frozenset[int]] = {}

    def _state(self, length: int, moves: dict[str, int], link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        self.at.append(set())
        return len(self.next) - 1

    def _clone(self, p: int, word: str, q: int) -> int:
        c = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = c
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = c
            p = self.link[p]
        return c

    def _extend(self, last: int, word: str) -> int:
        q = self.next[last].get(word)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, word, q)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, word, q)
        return new

    def items_of(self, state: int) -> frozenset[int]:
        """Items that hold the words of a state: those of all states below it."""
        if state not in self._items:
            found, todo = set(), [state]
            while todo:
                v = todo.pop()
                found |= self.at[v]
                todo += self.children[v]
            self._items[state] = frozenset(found)
        return self._items[state]

    def scan(self, words: list[str], hit: np.ndarray, start: int, found: set[int]) -> int:
        """Mark the hit words, add the items; returns the longest match."""
        state = length = longest = 0
        for i, w in enumerate(words):
            while state and w not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            state = self.next[state].get(w, 0)
            length = length + 1 if state else 0
            longest = max(longest, length)
            if length >= self.window:
                v = state
                while self.length[self.link[v]] >= self.window:
                    v = self.link[v]
                hit[start + i + 1 - self.window : start + i + 1] = True
                found |= self.items_of(v)
            v = self.marked[state]
            while v > 0:
                for size, k in self.short[v]:
                    if size <= length:
                        hit[start + i + 1 - size : start + i + 1] = True
                        found.add(k)
                v = self.marked[self.link[v]]
        return longest


class Matcher:
    """One automaton, and the hashes that tell where it has to run."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        split = [(name, words_of(text)) for name, text in items]
        self.automaton = SuffixAutomaton(split, window)
        self.tables, self.powers = ByteTables.alphanumeric(), PowerTable()
        made = self._words(pa.array([text for _, text in items], pa.string()))
        sizes = made.ends - made.starts
        self.singles = np.unique(made.hashes(1)[made.starts[sizes == 1]]) if len(sizes) else np.zeros(0, np.uint64)
        pairs = made.hashes(2)
        self.pairs = np.unique(pairs[self._inside(made)[: len(pairs)]])
        longer = sizes[sizes > 1]
        self.least = min(window, int(longer.min())) if len(longer) else window

    def _words(self, texts: pa.Array) -> Words:
        return Words(texts, self.tables, self.powers)

    @staticmethod
    def _inside(words: Words) -> np.ndarray:
        """For each word, whether the next one belongs to the same text."""
        inside = np.ones(len(words.w0), bool)
        inside[words.ends[words.ends > words.starts] - 1] = False
        return inside

    @staticmethod
    def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
        if not len(known):
            return np.zeros(len(values), bool)
        return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values

    def match(self, texts: pa.Array) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, set[str], int]]]:
        """Words of each text, and for texts with a match: hit words, item ids, longest match."""
        made = self._words(texts)
        sizes = made.ends - made.starts
        n = len(made.w0)
        found: dict[int, tuple[np.ndarray, set[str], int]] = {}
        if not n:
            return sizes, found
        pair = np.zeros(n, bool)
        hashed = made.hashes(2)
        pair[: len(hashed)] = self._among(hashed, self.pairs)
        pair &= self._inside(made)
        single = self._among(made.hashes(1), self.singles) if len(self.singles) else np.zeros(n, bool)
        # runs of pairs, as their first word and the word after their last
        edges = np.diff(np.concatenate(([False], pair, [False])).astype(np.int8))
        first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) + 1
        long = last - first >= self.least
        alone = np.flatnonzero(single)
        runs = np.concatenate((np.column_stack((first[long], last[long])), np.column_stack((alone, alone + 1))))
        if not len(runs):
            return sizes, found
        runs = runs[np.argsort(runs[:, 0], kind="stable")]
        text_of = np.searchsorted(made.ends, runs[:, 0], side="right")
        cuts = np.flatnonzero(np.diff(text_of)) + 1
        for part, t in zip(np.split(runs, cuts), text_of[np.concatenate(([0], cuts))]):
            words = words_of(texts[int(t)].as_py())
            hit, items, longest, base = np.zeros(len(words), bool), set(), 0, int(made.starts[t])
            for a, b in part.tolist():
                longest = max(longest, self.automaton.scan(words[a - base : b - base], hit, a - base, items))
            if items or hit.any():
                found[int(t)] = hit, {self.automaton.ids[k] for k in items} - {None}, longest
        return sizes, found


def ranges(hit: np.ndarray) -> list[dict]:
    edges = np.diff(np.concatenate(([False], hit, [False])).astype(np.int8))
    return [{"first": int(a), "last": int(b) - 1} for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1))]


COLUMNS = "n_words bigint, item_ids array<string>, hit_spans array<struct<first:bigint,last:bigint>>, longest bigint"


def _mark(docs: DataFrame, items: list[tuple[str | None, str | None]], window: int, again: bool) -> DataFrame:
    def make():
        matcher = Matcher(items, window)

        def work(batch):
            texts = batch.column("text").cast(pa.string())
            sizes, found = matcher.match(texts)
            ids = batch.column("_item_ids").to_pylist() if again else [[] for _ in sizes]
            spans = batch.column("_hit_spans").to_pylist() if again else [[] for _ in sizes]
            longest = batch.column("_longest").to_pylist() if again else [0] * len(sizes)
            for t, (hit, names, most) in found.items():
                for span in spans[t]:
                    hit[span["first"] : span["last"] + 1] = True
                ids[t] = sorted({*ids[t], *names})
                spans[t], longest[t] = ranges(hit), max(longest[t], most)
            return {"n_words": sizes, "item_ids": ids, "hit_spans": spans, "longest": longest}

        return work

    return with_columns(docs, COLUMNS, make)


def mark_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_words: int = MAX_WORDS) -> DataFrame:
    """``docs`` with ``n_words``, ``item_ids`` (sorted), ``hit_spans`` (first and last word) and ``longest``."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null")
    words = F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    total = items.agg(F.sum(words)).first()[0] or 0
    parts = max(1, -(-total // max_words))
    scratch = Scratch(docs.sparkSession, "decontaminate") if parts > 1 else None
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    kept, again = docs.columns, ["n_words", "item_ids", "hit_spans", "longest"]
    for k in range(parts):
        own = [(r.item_id, r.text) for r in items.where(part == k).collect()]
        if k:
            docs = scratch.put(marked.withColumnsRenamed({c: f"_{c}" for c in again}))  # noqa: F821
        marked = _mark(docs, own, window, k > 0).select(*kept, *again)
    return marked


def verdict(marked: DataFrame, coverage: int = COVERAGE) -> DataFrame:
    """Adds ``n_hit`` and ``contaminated``: hits reach one word in ``coverage``."""
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    judged = marked.withColumn("n_hit", n_hit)
    return judged.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * coverage >= F.col("n_words")))


def cut_spans(text: str | None, spans: list) -> str | None:
    """``text`` without its hit words, from the first to the last character of each span."""
    if not text or not spans:
        return text
    at = [m.span() for m in WORD.finditer(ascii_lower(text))]
    out, end = [], 0
    for s in spans:
        out.append(text[end : at[s["first"]][0]])
        end = at[s["last"]][1]
    return "".join([*out, text[end:]])


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``clean_text``: the text without the spans of the contaminated documents."""

    def make():
        def work(batch):
            judged = batch.column("contaminated").to_pylist()
            texts, spans = batch.column("text").to_pylist(), batch.column("hit_spans").to_pylist()
            return {"clean_text": [cut_spans(t, s) if c else t for t, s, c in zip(texts, spans, judged)]}

        return work

    return with_columns(verdict(mark_spans(docs, benchmark, window)), "clean_text string", make)


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's columns for every row of ``docs``."""
    return verdict(mark_spans(docs.select("doc_id", "text"), benchmark)).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )
