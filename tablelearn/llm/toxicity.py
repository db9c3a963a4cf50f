"""Toxicity by a lexicon trie intersected with Levenshtein automata, and the hits' context.

The lexicon is learned from a bounded sample of labelled rows: words, and beginnings of words
(4 to 6 letters, written ``abcd*``), that are far more frequent in toxic documents. All terms
form one trie. Reading a word moves a set of (trie node, edits) pairs: the Levenshtein automata
of all terms at once, restricted to the trie, with as many edits as a term's length allows
(none below 5 letters, 1 up to 8, 2 beyond; one step less for beginnings). The sets are made
deterministic on the fly, so a known prefix costs one lookup per letter.

Each hit weighs the log-odds of its term and edits, from the sample. A window of ``WINDOW``
words on both sides separates quotation from abuse: quotation marks and reporting words lower
the weight, second-person words and exclamation marks raise it. A small calibrated network on
the document's hits (sum, largest, count, share, quoted share, ...) gives the score.

Every whole text is read. Null and empty texts have no hits and are scored like any text
without. Repeated rows get equal scores. Without labels, or with one class only, the score is
the share of label 1 (0.5 without any). Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.llm.common import WordCache, id_bucket, worker_cache
from tablelearn.llm.nets import TwoLayer, fit_two_layer
from tablelearn.llm.samples import labelled_sample

PER_CLASS = 3000
MAX_TERMS = 2000
PREFIXES = (4, 5, 6)
WINDOW = 5
THRESHOLD = 0.7
_FOLDS = (3, 1)  # held out: crc32(doc_id) mod 3 = 1
FEATURES = 8

_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_QUOTES = re.compile("[\"“”„«»‘]|^'|'$")
_REPORTING = frozenset("said says wrote writes called quote quoted quotes term word words insult slur".split())
_ADDRESSING = frozenset("you your youre you're u ur du dich dein tu toi ton te vous usted tus eres".split())


def normal(word: str) -> str:
    return _EDGE.sub("", word.lower())


def edits_allowed(term: str) -> int:
    stem = term.rstrip("*")
    most = 0 if len(stem) < 5 else 1 if len(stem) <= 8 else 2
    return max(0, most - 1) if term.endswith("*") else most


class TrieAutomaton:
    """All terms within their allowed edits of a word, by lazy determinisation."""

    def __init__(self, terms: list[str]):
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.whole: list[int] = [-1]  # term that ends at a node
        self.begin: list[int] = [-1]  # term whose beginning ends at a node
        self.most: list[int] = [0]  # edits allowed below a node
        for k, term in enumerate(terms):
            node, limit = 0, edits_allowed(term)
            self.most[0] = max(self.most[0], limit)
            for letter in term.rstrip("*"):
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.whole.append(-1)
                    self.begin.append(-1)
                    self.most.append(0)
                node = self.children[node][letter]
                self.most[node] = max(self.most[node], limit)
            (self.begin if term.endswith("*") else self.whole)[node] = k
        self.letters = {c for kids in self.children for c in kids}
        self.states: dict[frozenset, int] = {}
        self.pairs: list[frozenset] = []
        self.ends: list[tuple[int, int] | None] = []
        self.passed: list[tuple[int, int] | None] = []
        self.moves: list[dict[str, int]] = []
        self.start = self._state({0: 0})

    def _state(self, pairs: dict[int, int]) -> int:
        """Number of a set of node -> fewest edits, after skipping term letters."""
        stack = list(pairs.items())
        while stack:
            node, e = stack.pop()
            for kid in self.children[node].values():
                if e + 1 <= self.most[kid] and pairs.get(kid, 99) > e + 1:
                    pairs[kid] = e + 1
                    stack.append((kid, e + 1))
        key = frozenset(pairs.items())
        if key not in self.states:
            self.states[key] = len(self.pairs)
            self.pairs.append(key)
            self.moves.append({})
            self.ends.append(self._best(pairs, self.whole))
            self.passed.append(self._best(pairs, self.begin))
        return self.states[key]

    def _best(self, pairs: dict[int, int], where: list[int]) -> tuple[int, int] | None:
        hits = [(e, where[n]) for n, e in pairs.items() if where[n] >= 0 and e <= edits_allowed(self.terms[where[n]])]
        return min(hits) if hits else None

    def _move(self, state: int, letter: str) -> int:
        out: dict[int, int] = {}

        def put(node: int, e: int) -> None:
            if e <= self.most[node] and out.get(node, 99) > e:
                out[node] = e

        for node, e in self.pairs[state]:
            put(node, e + 1)
            for c, kid in self.children[node].items():
                put(kid, e if c == letter else e + 1)
        return self._state(out)

    def match(self, word: str) -> tuple[int, int] | None:
        """``(edits, term number)`` of the closest term, or None."""
        state, best = self.start, None
        for letter in word:
            if letter not in self.letters:
                letter = ""
            after = self.moves[state].get(letter)
            if after is None:
                after = self.moves[state][letter] = self._move(state, letter)
            state = after
            if not self.pairs[state]:
                return best
            if self.passed[state] is not None and (best is None or self.passed[state] < best):
                best = self.passed[state]
        end = self.ends[state]
        return end if best is None or (end is not None and end < best) else best


@dataclass
class ToxicityModel:
    terms: list[str]
    weights: dict[tuple[int, int], float] = field(default_factory=dict)
    net: TwoLayer | None = None

    def tag(self) -> str:
        return xxhash.xxh3_64_hexdigest(repr(self.terms))

    def hits(self, text: str | None) -> tuple[list[str], list[tuple[int, int, int]]]:
        """Words, and ``(place, edits, term)`` of every hit."""
        words = (text or "").split()
        automaton = worker_cache("toxic_trie_" + self.tag(), lambda: TrieAutomaton(self.terms))
        found = worker_cache("toxic_words_" + self.tag(), lambda: WordCache(lambda w: automaton.match(normal(w))))
        return words, [(k, *hit) for k, hit in enumerate(map(found.__getitem__, words)) if hit is not None]

    def features(self, text: str | None) -> np.ndarray:
        out = np.zeros(FEATURES)
        words, hits = self.hits(text)
        if not hits:
            return out
        scored = []
        for place, edits, term in hits:
            near = words[max(0, place - WINDOW) : place + WINDOW + 1]
            lower = [normal(w) for w in near]
            quoted = any(map(_QUOTES.search, near)) or any(w in _REPORTING for w in lower)
            abuse = any(w in _ADDRESSING for w in lower) or any("!" in w for w in near)
            weight = self.weights.get((term, edits), 0.0)
            scored.append((weight * (0.4 if quoted else 1.0) * (1.25 if abuse else 1.0), quoted, abuse, edits))
        value = [s[0] for s in scored]
        out[:] = (
            sum(value),
            max(value),
            math.log1p(len(scored)),
            math.log1p(sum(max(v, 0) for v in value)),
            sum(s[1] for s in scored) / len(scored),
            sum(s[2] for s in scored) / len(scored),
            sum(s[3] == 0 for s in scored) / len(scored),
            100.0 * len(scored) / len(words),
        )
        return out


def choose_terms(counts: dict[str, tuple[int, int]], toxic: int, clean: int) -> list[str]:
    """Terms with (toxic, clean) document counts that mark toxic documents, most frequent first.

    Of a word and its beginnings the longest that keeps nine tenths of the documents stands
    for them; what a chosen beginning covers is not listed again."""
    good = {}
    for term, (t, c) in counts.items():
        if t >= max(3, 0.003 * toxic) and (t / max(1, toxic)) >= 15 * ((c + 0.5) / max(1, clean)):
            good[term] = t
    stems = sorted(good, key=lambda x: (-len(x.rstrip("*")), x.endswith("*"), x))
    kept: dict[str, int] = {}
    for term in stems:
        stem = term.rstrip("*")
        if term.endswith("*") and any(k != term and k.startswith(stem) and n >= 0.9 * good[term] for k, n in kept.items()):
            continue
        kept[term] = good[term]
    out = []
    for term in sorted(kept, key=lambda x: (-kept[x], x)):
        if not any(k.endswith("*") and term != k and term.startswith(k[:-1]) for k in kept):
            out.append(term)
    return out[:MAX_TERMS]


def _document_terms(text: str | None) -> set[str]:
    words = {normal(w) for w in (text or "").split()}
    out = {w for w in words if 3 <= len(w) <= 40}
    return out | {w[:n] + "*" for w in words if len(w) <= 40 for n in PREFIXES if len(w) > n}


def _lexicon(sample: DataFrame, toxic: int, clean: int) -> list[str]:
    def run(frames):
        for frame in frames:
            for k in range(0, len(frame), 300):
                part = frame.iloc[k : k + 300]
                rows = [(t, y) for text, y in zip(part["text"], part["label"], strict=True) for t in _document_terms(text)]
                table = pd.DataFrame(rows, columns=["term", "label"])
                yield table.groupby("term")["label"].agg(["sum", "count"]).reset_index().rename(columns={"sum": "toxic", "count": "n"})

    counts = (
        sample.select("text", "label")
        .mapInPandas(run, "term string, toxic long, n long")
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
        # The rule of choose_terms, so that only terms that can be chosen are collected.
        .filter((F.col("toxic") >= 3) & (F.col("toxic") >= 0.003 * toxic))
        .filter(F.col("toxic") / max(1, toxic) >= 15 * (F.col("n") - F.col("toxic") + 0.5) / max(1, clean))
        .orderBy(F.desc("toxic"), "term")
        .limit(20 * MAX_TERMS)
        .collect()
    )
    return choose_terms({r["term"]: (r["toxic"], r["n"] - r["toxic"]) for r in counts}, toxic, clean)


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> ToxicityModel:
    """Learn lexicon, weights and network from labelled rows outside the held-out fold."""
    eligible = id_bucket(F.col("doc_id"), _FOLDS[0]) != _FOLDS[1]
    sample, totals = labelled_sample(docs, labels.select("doc_id", "toxic"), "toxic", eligible, per_class)
    sample = sample.select("doc_id", "text", F.col("label").cast("int").alias("label"))
    n = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    model = ToxicityModel(_lexicon(sample, toxic, clean) if toxic and clean else [])

    def seen(frames):
        for frame in frames:
            rows = [(t, e, y) for text, y in zip(frame["text"], frame["label"], strict=True) for e, t in {h[1:] for h in model.hits(text)[1]}]
            yield pd.DataFrame(rows, columns=["term", "edits", "label"])

    parts = sample.select("text", "label").mapInPandas(seen, "term int, edits int, label int")
    counts = {(r["term"], r["edits"]): (r["t"], r["n"] - r["t"]) for r in parts.groupBy("term", "edits").agg(F.sum("label").alias("t"), F.count(F.lit(1)).alias("n")).collect()}
    for k, term in enumerate(model.terms):
        for edits in range(edits_allowed(term) + 1):
            t, c = counts.get((k, edits), (0, 0))
            weight = math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))
            # A misspelling never met in the sample counts less than the term itself.
            model.weights[k, edits] = weight if t + c else 0.6 * model.weights.get((k, edits - 1), 0.0)

    def describe(frames):
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["doc_id"], "label": frame["label"], "x": pd.Series([model.features(t) for t in frame["text"]], dtype=object, index=frame.index)})

    rows = sample.mapInPandas(describe, "doc_id long, label int, x array<double>").orderBy("doc_id").toPandas()
    y = rows["label"].to_numpy(float)
    x = np.stack(rows["x"]) if len(rows) else np.zeros((0, FEATURES))
    share = {float(k): v / sum(totals.values()) for k, v in totals.items()}
    inside = {k: max(1, (y == k).sum()) / max(1, len(y)) for k in share}
    model.net = fit_two_layer(x, y, np.array([share[k] / inside[k] for k in y]), hidden=8)
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, score, n_hits`` of every row."""

    def run(frames):
        for frame in frames:
            for k in range(0, len(frame), 1000):
                part = frame.iloc[k : k + 1000]
                x = np.stack([model.features(t) for t in part["text"]])
                yield pd.DataFrame({"doc_id": part["doc_id"], "score": model.net.score(x), "n_hits": np.rint(np.expm1(x[:, 2])).astype(int)})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, score double, n_hits int")


def classify_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_hits`` of every row."""
    scored = score_toxicity(docs, fit_toxicity(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(id_bucket(F.col("doc_id"), _FOLDS[0]) == _FOLDS[1], F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "n_hits",
    )
