"""Benchmark decontamination: BM25 with block-max bounds, then question and answer overlap.

A document holds an item only if it holds most of its question and most of its answer, so an
item is looked for by the longer of the two. That part is indexed as pieces of ``PIECE`` words,
``PIECE_STRIDE`` apart: a copy that is torn apart, or of an item of any length, still leaves
pieces whole. The pieces form an inverted index: for every word its pieces and BM25 impacts.
Pieces are sorted by the score they would give themselves and cut into blocks; for every word
and block the largest impact is kept. Every training text is read as overlapping passages of
``PASSAGE`` words, ``STRIDE`` apart. An item is retrieved when some passage's score reaches
``RECALL_SHARE`` of the own score of one of its pieces. As in block-max WAND, a piece comes into
question only where enough of its pivots stand, its words of the highest impacts: with fewer
than ``PIVOTS`` of them its other words cannot reach the threshold. Then each block is dropped
whose block-max sum stays below the block's smallest threshold, and only what is left is
scored in full. Nothing else is cut, so all pieces above their thresholds are found.
Nothing but this retrieval decides which pairs are looked at; the tests compare it with a
search for every shared run of words.

Retrieved pairs are verified on the whole text with runs of five words: the share of the
question's runs and of the answer's runs found there must both reach ``OVERLAP``. An item's
answer is its last sentence and its question what comes before; an item of one sentence is
cut at two thirds of its words. A part with fewer than five words takes words of the other
part next to it; an item with fewer than five words in all must appear as one run. A pair
that this rule misses is looked at once more on words without punctuation at their ends, where a
short answer takes words of the question with it until it has ``ANSWER_RUNS`` runs: signs
stuck to a copy or a touched last word do not hide it. The reported overlaps are those of the
rule that held.

The items are read in shards of at most ``SHARD`` items, so what a task holds is bounded. Words'
frequencies and the pieces' mean length are those of all items, counted by Spark where there
are several shards, so a threshold does not depend on the shards.

Edge cases: null and empty texts are clean; null and empty items are ignored; repeated items
and rows are reported each; without items the result is empty. Extra columns are ignored or,
in ``drop_contaminated``, passed through.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.llm.common import WordCache, worker_cache
from tablelearn.llm.wordsets import shingles, word_hashes
from tablelearn.session import materialize

PASSAGE, STRIDE = 32, 16
PIECE, PIECE_STRIDE = 16, 8
RECALL_SHARE = 0.5
OVERLAP = 0.6
SHINGLE = 5
ANSWER_RUNS = 5
BLOCK = 16
PIVOTS = 3
SHARD = 20_000
K1, B = 1.2, 0.75
_DENSE = 16  # tables of up to this many places a key replace sorting
_TOGETHER = 30_000  # about as many words are looked up together
_EDGE = re.compile(rb"^[^0-9a-z\x80-\xff]+|[^0-9a-z\x80-\xff]+$")


def _terms(text: str) -> list[bytes]:
    """Lower-cased words without punctuation at their ends."""
    found = (_EDGE.sub(b"", w) for w in text.encode("utf-8", "surrogatepass").lower().split())
    return [w for w in found if w]


def _ragged(starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For CSR ``starts``: positions of all entries of ``rows``, and which of ``rows`` each is of."""
    sizes = starts[rows + 1] - starts[rows]
    owner = np.repeat(np.arange(len(rows)), sizes)
    first = np.repeat(starts[rows] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) if len(rows) else sizes
    return first + np.arange(len(owner)), owner


def _distinct(keys: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct ``keys`` below ``size``."""
    if size > _DENSE * len(keys):
        return np.unique(keys)
    flags = np.zeros(size, bool)
    flags[keys] = True
    return np.flatnonzero(flags)


def _sums(keys: np.ndarray, weights: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``keys`` below ``size`` and the sums of their (positive) weights, or of one weight for all."""
    weights = np.broadcast_to(weights, keys.shape)
    if size > _DENSE * len(keys):
        found, inverse = np.unique(keys, return_inverse=True)
        return found, np.bincount(inverse, weights)
    sums = np.bincount(keys, weights, size)
    found = np.flatnonzero(sums)
    return found, sums[found]


def _member(keys: np.ndarray, chosen: np.ndarray, size: int) -> np.ndarray:
    if size > _DENSE * len(keys):
        return np.isin(keys, chosen)
    flags = np.zeros(size, bool)
    flags[chosen] = True
    return flags[keys]


@dataclass
class ItemIndex:
    """Inverted index of one shard of test items (see the module text)."""

    tag: str
    item_ids: list[int]
    vocabulary: dict[bytes, int]
    owner: np.ndarray  # piece -> item
    starts: np.ndarray  # term -> postings
    pieces: np.ndarray
    impacts: np.ndarray
    is_pivot: np.ndarray  # term -> whether it is a pivot of some piece
    pivot_starts: np.ndarray  # term -> pieces it is a pivot of
    pivot_pieces: np.ndarray
    least: np.ndarray  # piece -> how many of its pivots a passage needs
    block_starts: np.ndarray  # term -> block entries
    blocks: np.ndarray
    block_top: np.ndarray
    need: np.ndarray  # piece -> threshold
    block_need: np.ndarray
    question: list[tuple[int, np.ndarray]]
    answer: list[tuple[int, np.ndarray]]
    bare_question: list[tuple[int, np.ndarray]]
    bare_answer: list[tuple[int, np.ndarray]]

    def term_ids(self, text: str) -> np.ndarray:
        """For every word its number in the vocabulary, -1 for others, -2 for words of signs only."""
        known = worker_cache("bm25_" + self.tag, lambda: WordCache(lambda w: _term_id(self.vocabulary, w)))
        words = text.encode("utf-8", "surrogatepass").lower().split()
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def retrieve(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """For texts as ``term_ids``: pairs (text, piece) where some passage reaches the piece's threshold."""
        # One text behind the other, each from a stride of its own on and behind strides without
        # words, so no passage holds words of two texts.
        over = PASSAGE // STRIDE
        strides = np.array([over - 1 + -(-len(x) // STRIDE) for x in ids], np.int64)
        begin = np.cumsum(strides) - strides
        count = int(strides.sum())
        line = np.full(count * STRIDE, -1, np.int64)
        for x, at in zip(ids, (begin + over - 1) * STRIDE, strict=True):
            line[at : at + len(x)] = x
        passage, piece = self._passages(line, count)
        text = np.searchsorted(begin, passage, side="right") - 1
        pairs = np.unique(text * len(self.need) + piece)
        return pairs // len(self.need), pairs % len(self.need)

    def _passages(self, ids: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        none = np.empty(0, np.int64), np.empty(0, np.int64)
        pivots = np.flatnonzero(self.is_pivot[ids])  # the numbers below 0 fall on the two last places
        if not len(pivots):
            return none
        # Each word belongs to the passages that begin at most PASSAGE words before it.
        over = np.arange(PASSAGE // STRIDE)
        n_blocks, n_pieces, width = len(self.block_need), len(self.need), len(self.vocabulary)
        entry, owner = _ragged(self.pivot_starts, ids[pivots])
        wanted = (((pivots[owner] // STRIDE)[:, None] - over) * n_pieces + self.pivot_pieces[entry][:, None]).ravel()
        wanted, times = _sums(wanted[wanted >= 0], np.ones(1), count * n_pieces)
        wanted = wanted[times >= self.least[wanted % n_pieces]]
        cells = _distinct(wanted // n_pieces * n_blocks + wanted % n_pieces // BLOCK, count * n_blocks)
        if not len(cells):
            return none
        # All known words of the passages that are left.
        left = np.zeros(count, bool)
        left[cells // n_blocks] = True
        at = np.flatnonzero(ids >= 0)
        place = (at // STRIDE)[:, None] - over
        use = left[place] & (place >= 0)
        pairs = _distinct(place[use] * width + np.broadcast_to(ids[at][:, None], place.shape)[use], count * width)
        passage, term = pairs // width, pairs % width
        entry, owner = _ragged(self.block_starts, term)
        key = passage[owner] * n_blocks + self.blocks[entry]
        use = _member(key, cells, count * n_blocks)
        cells, bounds = _sums(key[use], self.block_top[entry[use]], count * n_blocks)
        cells = cells[bounds >= self.block_need[cells % n_blocks]]
        if not len(cells):
            return none
        left = np.zeros(count, bool)
        left[cells // n_blocks] = True
        use = left[passage]
        passage, term = passage[use], term[use]
        entry, owner = _ragged(self.starts, term)
        use = _member(passage[owner] * n_blocks + self.pieces[entry] // BLOCK, cells, count * n_blocks)
        entry, owner = entry[use], owner[use]
        scored, score = _sums(passage[owner] * n_pieces + self.pieces[entry], self.impacts[entry], count * n_pieces)
        scored = scored[score >= self.need[scored % n_pieces]]
        return scored // n_pieces, scored % n_pieces

    def matches(self, texts: list[str | None]) -> list[list[tuple[int, float, float]]]:
        """For each text ``item_id, question overlap, answer overlap`` of the verified items."""
        out: list[list] = [[] for _ in texts]
        waiting, words = [], 0
        for k, text in enumerate(texts):
            if text:
                waiting.append((k, self.term_ids(text)))
                words += len(waiting[-1][1])
            if waiting and (words >= _TOGETHER or k == len(texts) - 1):
                found, piece = self.retrieve([ids for _, ids in waiting])
                for j in np.unique(found).tolist():
                    at, ids = waiting[j]
                    out[at] = self._of_text(texts[at], ids, np.unique(self.owner[piece[found == j]]))
                waiting, words = [], 0
        return out

    def _of_text(self, text: str, ids: np.ndarray, found: np.ndarray) -> list[tuple[int, float, float]]:
        whole = self._verified(found, word_hashes(text), self.question, self.answer)
        rest = np.setdiff1d(found, [k for k, _, _ in whole])
        bare = self._verified(rest, _bare_words(ids), self.bare_question, self.bare_answer)
        return [(self.item_ids[k], q, a) for k, q, a in sorted(whole + bare)]

    def _verified(self, found: np.ndarray, hashes: np.ndarray, question: list, answer: list) -> list[tuple[int, float, float]]:
        out = []
        by_size: dict[int, np.ndarray] = {}
        for k in found.tolist():
            part = []
            for width, runs in (question[k], answer[k]):
                if width not in by_size:
                    by_size[width] = np.unique(shingles(hashes, width)) if len(hashes) >= width else np.empty(0, np.uint64)
                part.append(float(np.isin(runs, by_size[width]).mean()))
            if min(part) >= OVERLAP:
                out.append((k, *part))
        return out


def _term_id(vocabulary: dict[bytes, int], word: bytes) -> int:
    term = _EDGE.sub(b"", word)
    return vocabulary.get(term, -1) if term else -2


def _bare_words(ids: np.ndarray) -> np.ndarray:
    """``term_ids`` as words of runs, without words of signs only: 0 (a word of no item) or a number of the word."""
    ids = ids[ids != -2]
    return np.where(ids == -1, 0, ids + 2).astype(np.uint64)


def _cut(words: list[bytes]) -> int:
    """Number of words of an item's question."""
    ends = [k + 1 for k, w in enumerate(words[:-1]) if w[-1:] in b".!?"]
    return ends[-1] if ends else max(1, 2 * len(words) // 3)


def _parts(text: str) -> tuple[tuple[int, np.ndarray], tuple[int, np.ndarray]]:
    """Run width and runs of an item's question and answer."""
    hashes = word_hashes(text)
    words = text.encode("utf-8", "surrogatepass").split()
    n, cut = len(words), _cut(words)
    width = min(SHINGLE, n)
    question = hashes[: max(cut, width)]
    answer = hashes[min(cut, n - width) :]
    return (width, np.unique(shingles(question, width))), (width, np.unique(shingles(answer, width)))


def _bare_parts(text: str, vocabulary: dict[bytes, int]) -> tuple[tuple[int, np.ndarray], tuple[int, np.ndarray]]:
    """As ``_parts``, on words without signs at their ends; the answer has ``ANSWER_RUNS`` runs
    at least, as far as the item has them, and every run that touches it."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    ids = np.array([_term_id(vocabulary, w) for w in words])
    cut = int((ids[: _cut(words)] != -2).sum())
    hashes = _bare_words(ids)
    n = len(hashes)
    width = min(SHINGLE, n)
    question = hashes[: max(cut, width)]
    answer = hashes[max(0, min(cut - width + 1, n - width - ANSWER_RUNS + 1)) :]
    return (width, np.unique(shingles(question, width))), (width, np.unique(shingles(answer, width)))


def pieces_of(text: str) -> list[list[bytes]]:
    """The terms of each piece of an item's longer part (of the item, where that part has none)."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    cut, width = _cut(words), min(SHINGLE, len(words))
    parts = [words[: max(cut, width)], words[min(cut, len(words) - width) :]]
    longer = max(([w for w in (_EDGE.sub(b"", x) for x in part) if w] for part in parts), key=len)
    longer = longer or _terms(text)
    last = max(0, -(-(len(longer) - PIECE) // PIECE_STRIDE))
    return [longer[k * PIECE_STRIDE : k * PIECE_STRIDE + PIECE] for k in range(last + 1)] if longer else []


@dataclass
class Statistics:
    """Pieces of all items: how many, their words, and in how many each term stands."""

    pieces: int
    words: int
    frequency: dict[bytes, int]


def _statistics(pieces: list[list[bytes]]) -> Statistics:
    frequency: dict[bytes, int] = {}
    for terms in pieces:
        for t in set(terms):
            frequency[t] = frequency.get(t, 0) + 1
    return Statistics(len(pieces), sum(map(len, pieces)), frequency)


def build_index(rows: list[tuple[int, str]], statistics: Statistics | None = None) -> ItemIndex | None:
    """Index of (item_id, text) rows; None if no item has a word. ``statistics`` are those of all
    items, where ``rows`` are a part of them."""
    rows = [(i, t) for i, t in rows if t and _terms(t)]
    if not rows:
        return None
    vocabulary: dict[bytes, int] = {}
    for _, text in rows:
        for w in _terms(text):
            vocabulary.setdefault(w, len(vocabulary))
    cut = [(k, terms) for k, (_, text) in enumerate(rows) for terms in pieces_of(text)]
    known = statistics or _statistics([terms for _, terms in cut])
    mean = known.words / known.pieces
    impact = []
    for _, terms in cut:
        counts: dict[bytes, int] = {}
        for t in terms:
            counts[t] = counts.get(t, 0) + 1
        norm = K1 * (1 - B + B * len(terms) / mean)
        idf = {t: np.log(1 + (known.pieces - known.frequency[t] + 0.5) / (known.frequency[t] + 0.5)) for t in counts}
        impact.append({vocabulary[t]: idf[t] * c * (K1 + 1) / (c + norm) for t, c in counts.items()})
    self_score = np.array([sum(own.values()) for own in impact])
    order = np.argsort(self_score, kind="stable")
    postings = sorted((t, new, w) for new, old in enumerate(order) for t, w in impact[old].items())
    term, piece, weight = (np.array(x) for x in zip(*postings, strict=True))
    width = len(vocabulary)
    best: dict[tuple[int, int], float] = {}
    for t, i, w in postings:
        best[t, i // BLOCK] = max(best.get((t, i // BLOCK), 0.0), w)
    cells = sorted(best)
    # A hair below the exact value, so that rounding never drops a pair.
    need = RECALL_SHARE * self_score[order] * (1 - 1e-9)
    pivots, least = [], np.ones(len(order), np.int64)
    for new, old in enumerate(order):
        rising = sorted(impact[old].items(), key=lambda x: x[1])
        # With fewer than ``least`` pivots a passage has at most the highest impacts and all words that are none.
        highest = np.cumsum([0.0, *[w for _, w in rising[::-1]]])
        least[new] = max(m for m in range(1, PIVOTS + 1) if m <= len(rising) and highest[m - 1] < need[new])
        rest = highest[least[new] - 1]
        for t, w in rising:
            rest += w
            if rest >= need[new]:
                pivots.append((t, new))
    pivot_term, pivot_piece = (np.array(x) for x in zip(*sorted(pivots), strict=True))
    pivot_starts = np.searchsorted(pivot_term, np.arange(width + 1))
    parts = [_parts(text) + _bare_parts(text, vocabulary) for _, text in rows]
    return ItemIndex(
        tag=xxhash.xxh3_64_hexdigest(repr(rows)),
        item_ids=[i for i, _ in rows],
        vocabulary=vocabulary,
        owner=np.array([cut[k][0] for k in order]),
        starts=np.searchsorted(term, np.arange(width + 1)),
        pieces=piece,
        impacts=weight,
        is_pivot=np.append(np.diff(pivot_starts) > 0, [False, False]),
        pivot_starts=pivot_starts,
        pivot_pieces=pivot_piece,
        least=least,
        block_starts=np.searchsorted(np.array([c[0] for c in cells]), np.arange(width + 1)),
        blocks=np.array([c[1] for c in cells]),
        block_top=np.array([best[c] for c in cells]),
        need=need,
        block_need=np.minimum.reduceat(need, np.arange(0, len(need), BLOCK)),
        question=[p[0] for p in parts],
        answer=[p[1] for p in parts],
        bare_question=[p[2] for p in parts],
        bare_answer=[p[3] for p in parts],
    )


def _shards(benchmark: DataFrame, size: int):
    """Indexes of at most about ``size`` items, one at a time."""
    items = benchmark.filter("item_id is not null and text is not null").select("item_id", "text")
    total = items.count()
    shards = -(-total // size)
    if shards > 1:

        def terms(frames):
            for frame in frames:
                cut = [t for text in frame["text"] for t in pieces_of(text)]
                found = _statistics(cut)
                rows = [(t, n, 0, 0) for t, n in found.frequency.items()] + [(None, 0, found.pieces, found.words)]
                yield pd.DataFrame(rows, columns=["term", "n", "pieces", "words"])

        counted = items.select("text").mapInPandas(terms, "term binary, n long, pieces long, words long")
        counted = materialize(counted.groupBy("term").agg(*[F.sum(c).alias(c) for c in ("n", "pieces", "words")]), "item-terms")
        sizes = counted.filter("term is null").first()
    for k in range(shards):
        part = items if shards == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == k)
        rows = [(r["item_id"], r["text"]) for r in part.orderBy("item_id", "text").collect()]
        statistics = None
        if shards > 1:
            own = items.sparkSession.createDataFrame([(bytearray(t),) for t in {t for _, text in rows for t in _terms(text)}], "term binary")
            found = counted.join(F.broadcast(own), "term").select("term", "n").collect()  # the words of one shard
            statistics = Statistics(sizes["pieces"], sizes["words"], {bytes(r["term"]): r["n"] for r in found})
        index = build_index(rows, statistics)
        if index is not None:
            yield index


def contaminated(docs: DataFrame, benchmark: DataFrame, shard: int = SHARD) -> DataFrame:
    """``doc_id, item_id, question_overlap, answer_overlap`` of every verified pair."""
    schema = "doc_id long, item_id long, question_overlap double, answer_overlap double"
    out = None
    for index in _shards(benchmark, shard):

        def run(frames, index=index):
            for frame in frames:
                found = [(d, *m) for d, own in zip(frame["doc_id"], index.matches(frame["text"].tolist()), strict=True) for m in own]
                if found:
                    yield pd.DataFrame(found, columns=["doc_id", "item_id", "question_overlap", "answer_overlap"]).astype({"doc_id": "Int64"})

        part = docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, shard: int = SHARD) -> DataFrame:
    """``docs`` without the contaminated rows; all columns stay. Rows are filtered where they
    are read, nothing is shuffled."""
    at = docs.columns.index("text")
    for index in _shards(benchmark, shard):

        def run(batches, index=index):
            for batch in batches:
                for k in range(0, len(batch), 1000):
                    part = batch.slice(k, 1000)
                    yield part.filter(pa.array([not m for m in index.matches(part.column(at).to_pylist())], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
