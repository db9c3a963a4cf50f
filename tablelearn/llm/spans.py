"""Substring deduplication by sliding spans of sentences.

A text is cut into sentences at line ends and behind words that end in a stop, with or without
signs behind it, in any of several scripts. Text with few stops is cut at content-defined
places too: of every ``WINDOW`` words in a row without a stop, behind the word with the
smallest hash. Two copies of a passage are cut alike but for the ``WINDOW - 1`` words at its
ends, and no piece has more than ``WINDOW`` words, so every passage of 2 * WINDOW + MIN_WORDS +
WINDOW - 1 words (47) holds a whole span wherever it stands.

From every sentence a span runs over the shortest sequence of at least ``MIN_SENTENCES``
sentences with at least ``MIN_WORDS`` words, and so does one up to every sentence; each
sentence of a repeated passage, its last ones too, lies in a span inside the passage. Spans
between stops only are hashed as well, so that a shorter passage that consists of sentences
does not depend on what stands around it. Spans are hashed over their words (A-Z lower-cased,
any white space between words) to 96 bits.

All spans of all documents meet once, by hash: the first holder of a span is the smallest
``doc_id`` (then the smallest hash of the text, then the first place), and every sentence that
another place of a repeated span covers is removed. The one shuffle carries a row per
hash and group of documents read together: a task lists all places of a hash it has met in
one row, so a span that a third of all documents share makes a row per group of documents.

Edge cases: null, empty and short texts have no spans and stay as they are; a row is identified
by ``doc_id`` and its text, so a repeated row has no effect and is treated like its twin, and
different texts under one id are cut each by its own spans; null ids have no spans and stay.
Extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablelearn.llm.common import WordCache, worker_cache
from tablelearn.llm.wordsets import mix
from tablelearn.operators.joins import join_small
from tablelearn.session import materialize

MIN_SENTENCES = 3
MIN_WORDS = 24
WINDOW = 8
_STOPS = frozenset(".!?,;:…。．｡！？，､、；：؟،؛۔।॥։።፣፤")
_BASES = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _value(word: bytes) -> int:
    """63 bits of hash above a bit that says whether the word ends a sentence."""
    stop = 0
    for c in reversed(word.decode("utf-8", "surrogatepass")):
        if c.isalnum():
            break
        if c in _STOPS:
            stop = 1
            break
    return (xxhash.xxh3_64_intdigest(word) & ~1) | stop


def _content_cuts(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``ends`` and the words that have the smallest hash of some ``WINDOW`` words without an end."""
    least = np.where(ends, np.uint64(0), values | np.uint64(1))
    if len(least) < WINDOW:
        return ends
    low, size = least, 1
    while size < WINDOW:  # least hash of each window
        step = min(size, WINDOW - size)
        low, size = np.minimum(low[:-step], low[step:]), size + step
    # A word is cut behind if it is the least of some window: if the largest of its windows' least is its own.
    high = np.concatenate([np.zeros(WINDOW - 1, np.uint64), low, np.zeros(WINDOW - 1, np.uint64)])
    size = 1
    while size < WINDOW:
        step = min(size, WINDOW - size)
        high, size = np.maximum(high[:-step], high[step:]), size + step
    return ends | (high == least)


def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers of both bases and of their inverses modulo 2^64, up to ``n``."""

    def make(size: int):
        out = []
        with np.errstate(over="ignore"):
            for base in _BASES:
                inverse = np.uint64(pow(int(base), -1, 1 << 64))
                out.append(tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, b, np.uint64)])) for b in (base, inverse)))
        return out

    table = worker_cache("span_powers", lambda: {"size": 0, "rows": []})
    if table["size"] < n:
        table["size"] = max(n, 2 * table["size"], 4096)
        table["rows"] = make(table["size"])
    return table["rows"]


def _ends(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and whether a sentence ends with it at a stop or line end."""
    cache = worker_cache("span_words", lambda: WordCache(_value))
    data = text.encode("utf-8", "surrogatepass").lower().replace(b"\n", b" \x00 ")
    words = data.split()
    values = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    line_end = values == np.uint64(_value(b"\x00"))
    ends = (values & np.uint64(1)).astype(bool)
    ends[:-1] |= line_end[1:]
    ends, values = ends[~line_end], values[~line_end]
    ends[-1:] = True
    return values, ends


def _starts(ends: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.flatnonzero(ends) + 1])


def sentence_starts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the index of each sentence's first word (the number of words at the end)."""
    values, ends = _ends(text)
    return values, _starts(_content_cuts(values, ends))


def _forward(starts: np.ndarray, min_sentences: int, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First word of, and first word behind, the shortest span from every sentence."""
    count = len(starts) - 1
    last = np.maximum(np.arange(count) + min_sentences, np.searchsorted(starts, starts[:-1] + min_words))
    first = np.flatnonzero(last <= count)
    return starts[first], starts[last[first]]


def _backward(starts: np.ndarray, min_sentences: int, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``_forward``, the shortest span up to every sentence."""
    first = np.minimum(np.arange(1, len(starts)) - min_sentences, np.searchsorted(starts, starts[1:] - min_words, side="right") - 1)
    last = np.flatnonzero(first >= 0)
    return starts[first[last]], starts[last + 1]


def spans(text: str | None, min_sentences: int, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``first sentence, last sentence, h1, h2`` of every span of a text."""
    none = np.empty(0, np.int64)
    if not text:
        return none, none, none, none
    values, ends = _ends(text)
    starts = _starts(_content_cuts(values, ends))
    found = [f(x, min_sentences, min_words) for x in (starts, _starts(ends)) for f in (_forward, _backward)]
    size = len(values) + 1
    keys = np.unique(np.concatenate([a * size + b for a, b in found]))
    begin, end = keys // size, keys % size
    hashes = []
    with np.errstate(over="ignore"):
        for power, inverse in _powers(len(values) + 1):
            total = np.concatenate([[np.uint64(0)], np.cumsum(values * power[: len(values)], dtype=np.uint64)])
            hashes.append(mix((total[end] - total[begin]) * inverse[begin]).view(np.int64))
    return np.searchsorted(starts, begin), np.searchsorted(starts, end) - 1, hashes[0], hashes[1]


# A place of a span: its document's id, the hash of its text (0 unless the id has several texts),
# and its first sentence (high half) with the number of sentences behind it (low half).
_PLACE = np.dtype([("doc_id", "<i8"), ("th", "<i4"), ("place", "<i8")])
_GROUP_BYTES = 8 << 20  # about as much text is read together
_SPANS = "h1 long, h2 int, th int, doc_id long, place long, more binary"


def _grouped(places: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> pa.RecordBatch:
    """One row per hash: its smallest place and, where it has others, those as ``more``. The places
    come in their order."""
    order = np.argsort(h1, kind="stable")
    h1, h2 = h1[order], h2[order]
    if (h2[1:] != h2[:-1])[h1[1:] == h1[:-1]].any():  # equal in 64 bits, different in 96
        again = np.lexsort((h2, h1))
        order, h1, h2 = order[again], h1[again], h2[again]
    places = places[order]
    starts = np.flatnonzero(np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]))
    sizes = np.diff(np.append(starts, len(h1)))
    more = np.full(len(starts), None, object)
    for k in np.flatnonzero(sizes > 1):
        more[k] = places[starts[k] + 1 : starts[k] + sizes[k]].tobytes()
    lead = places[starts]
    columns = [h1[starts], h2[starts], *[np.ascontiguousarray(lead[c]) for c in ("th", "doc_id", "place")]]
    return pa.RecordBatch.from_arrays(
        [*map(pa.array, columns), pa.array(more, pa.binary())], names=["h1", "h2", "th", "doc_id", "place", "more"]
    )


def _texts(docs: DataFrame) -> DataFrame:
    """``doc_id, th, text`` of the rows with both; ``th`` is the text's hash where an id has several
    texts and 0 elsewhere, so that it takes no room in the shuffle of the spans."""
    rows = docs.filter("doc_id is not null and text is not null")
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    by_id = rows.select("doc_id", F.hash("text").alias("th")).groupBy("doc_id").agg(F.min("th").alias("a"), F.max("th").alias("b"))
    several = by_id.filter("a <> b").select("doc_id", F.lit(True).alias("several"))
    rows = join_small(rows, several, on=["doc_id"], how="left")
    return rows.select("doc_id", F.when(F.col("several"), F.hash("text")).otherwise(F.lit(0)).alias("th"), "text")


def span_table(docs: DataFrame, min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS) -> DataFrame:
    """``h1, h2, th, doc_id, place, more``: the spans of all documents, one row per hash and
    group of documents read together."""
    return _span_rows(_texts(docs), min_sentences, min_words)


def _span_rows(texts: DataFrame, min_sentences: int, min_words: int) -> DataFrame:
    """``span_table`` of the rows of ``_texts``."""

    def group(rows: list[tuple]):
        places, h1s, h2s = [], [], []
        for doc_id, th, text in sorted(rows, key=lambda r: r[:2]):
            first, last, h1, h2 = spans(text, min_sentences, min_words)
            if len(first):
                place = np.empty(len(first), _PLACE)
                place["doc_id"], place["th"], place["place"] = doc_id, th, (first << 32) + last - first
                places.append(place)
                h1s.append(h1)
                h2s.append(h2.astype(np.int32))
        if places:
            yield _grouped(np.concatenate(places), np.concatenate(h1s), np.concatenate(h2s))

    def run(batches):
        for batch in batches:
            rows, size = [], 0
            for row in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "th", "text")], strict=True):
                rows.append(row)
                size += len(row[2])
                if size >= _GROUP_BYTES:
                    yield from group(rows)
                    rows, size = [], 0
            yield from group(rows)

    return texts.mapInArrow(run, _SPANS)


def repeated_spans(texts: DataFrame, min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, th, holder (smallest doc_id with the span), first, last`` of the non-first places
    of repeated spans in the rows of ``_texts``."""
    by_hash = Window.partitionBy("h1", "h2").orderBy("doc_id", "th", "place").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    found = _span_rows(texts, min_sentences, min_words)
    held = found.select(
        "*",
        F.count(F.lit(1)).over(by_hash).alias("n"),
        *[F.first(c).over(by_hash).alias(f"holder_{c}") for c in _PLACE.names],
    ).where("n > 1 or more is not null").drop("h1", "h2", "n")

    def unpack(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            lead = np.empty(batch.num_rows, _PLACE)
            holder = np.empty(batch.num_rows, _PLACE)
            for c in _PLACE.names:
                lead[c] = batch.column(c).to_numpy()
                holder[c] = batch.column(f"holder_{c}").to_numpy()
            others = [np.frombuffer(m or b"", _PLACE) for m in batch.column("more").to_pylist()]
            owner = np.concatenate([np.arange(len(lead)), np.repeat(np.arange(len(lead)), [len(o) for o in others])])
            places, first = np.concatenate([lead, *others]), holder[owner]
            later = places != first
            places, first = places[later], first[later]
            begin = places["place"] >> 32
            end = begin + (places["place"] & 0xFFFFFFFF)
            columns = [places["doc_id"], places["th"], first["doc_id"], begin.astype(np.int32), end.astype(np.int32)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(c)) for c in columns], names=["doc_id", "th", "holder", "first", "last"]
            )

    return held.mapInArrow(unpack, "doc_id long, th int, holder long, first int, last int")


def removals(docs: DataFrame, min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, th, holders, places`` of the texts that lose sentences: the smallest ids that keep the
    passages, and the first and last sentences of what goes (at most one for each of its spans)."""
    return _removals(_texts(docs), min_sentences, min_words)


def _removals(texts: DataFrame, min_sentences: int, min_words: int) -> DataFrame:
    cut = repeated_spans(texts, min_sentences, min_words)
    return cut.groupBy("doc_id", "th").agg(
        F.array_sort(F.collect_set("holder")).alias("holders"), F.collect_set(F.struct("first", "last")).alias("places")
    )


def covered(places) -> np.ndarray:
    """Sorted numbers of the sentences that lie in any of the places."""
    return np.unique(np.concatenate([np.arange(p["first"], p["last"] + 1) for p in places]))


def _cut(text: str, sentences: np.ndarray) -> tuple[str, int, int]:
    """The text without the given sentences (white space behind them goes too)."""
    _, starts = sentence_starts(text)
    data = text.encode("utf-8", "surrogatepass")
    at = [m.start() for m in _WORD.finditer(data)] + [len(data)]
    keep, end = [], 0
    for s in sentences:
        keep.append(data[end : at[starts[s]]])
        end = at[starts[s + 1]]
    keep.append(data[end:])
    words = int(sum(starts[s + 1] - starts[s] for s in sentences))
    return b"".join(keep).decode("utf-8", "surrogatepass"), len(starts) - 1, words


def remove_repeated(docs: DataFrame, min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, first_doc_ids, n_sentences, n_removed, n_words_removed, kept_text`` of the
    texts that lose sentences, one row for each id and text."""
    texts = _texts(docs)
    cut = materialize(_removals(texts, min_sentences, min_words), "removals")

    def run(frames):
        for frame in frames:
            rows = []
            for doc_id, text, holders, places in frame.itertuples(index=False):
                sentences = covered(places)
                kept, n, words = _cut(text, sentences)
                rows.append((doc_id, list(holders), n, len(sentences), words, kept))
            yield pd.DataFrame(rows, columns=["doc_id", "first_doc_ids", "n_sentences", "n_removed", "n_words_removed", "kept_text"])

    # Texts that lose nothing stay out of the shuffle while the list of those that do is small.
    losing = join_small(texts, cut.select("doc_id", "th"), on=["doc_id", "th"])
    rows = losing.join(cut, ["doc_id", "th"]).dropDuplicates(["doc_id", "th"])
    schema = "doc_id long, first_doc_ids array<long>, n_sentences int, n_removed int, n_words_removed int, kept_text string"
    return rows.select("doc_id", "text", "holders", "places").mapInPandas(run, schema)
