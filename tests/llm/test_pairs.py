"""Near-duplicates, sentence spans and decontamination against brute force."""

from collections import Counter, defaultdict

import numpy as np
import pyarrow.dataset as ds
import pytest
from helpers import SF, edge_docs, edge_rows, no_docs, pandas, table

from tablelearn.llm import decontaminate, neardup, spans, wordsets
from tablelearn.llm.queries import QUERIES


def brute_components(rows, size, threshold=80):
    sets = {}
    for doc_id, text in rows:
        words = (text or "").encode().lower().split()
        runs = [tuple(words[k : k + size]) for k in range(len(words) - size + 1)] or ([tuple(words)] if words else [])
        sets[doc_id] = set(runs)
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    holders = defaultdict(list)
    for doc_id in sorted(sets):
        own, counts = sets[doc_id], Counter()
        for run in own:
            counts.update(holders[run])
            holders[run].append(doc_id)
        for other, n in counts.items():
            if 100 * n >= threshold * (len(own) + len(sets[other]) - n):
                a, b = sorted((root(doc_id), root(other)))
                parent[b] = a
    return {d: (len(s), root(d)) for d, s in sets.items()}


def as_dict(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_components_match_brute_force(spark):
    docs = pandas("documents")
    want = brute_components(zip(docs["doc_id"], docs["text"], strict=True), 2)
    out = QUERIES["op4_minhash_near_dedup"](spark, SF)
    assert as_dict(out) == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out.collect())


def test_chains_of_near_copies_lose_no_link(spark):
    """Copies of copies: neighbours are similar, the ends are not, and no bucket member is a hub."""
    rng = np.random.default_rng(1)
    words = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(60):
        rows.append((1000 - k, " ".join(words)))
        for at in rng.choice(120, 5, replace=False):
            words[at] = f"n{k}_{at}"
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for size in (2, 5):
        assert as_dict(neardup.near_duplicates(docs, size)) == brute_components(rows, size)


def test_what_is_apart_is_compared_in_one_pass(spark, monkeypatch):
    """Near copies about as similar as the threshold: the leads of a bucket do not reach all of them."""
    rng = np.random.default_rng(3)
    rows = [(0, " ".join(f"w{k}" for k in range(150)))]
    for doc_id in range(1, 120):
        words = [f"w{k}" for k in range(150)]
        for at in rng.choice(150, 5 + doc_id % 8, replace=False):
            words[at] = f"n{doc_id}_{at}"
        rows.append((doc_id, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    passes = []
    real = neardup.components
    monkeypatch.setattr(neardup, "components", lambda edges: passes.append(1) or real(edges))
    assert as_dict(neardup.near_duplicates(docs, 2)) == brute_components(rows, 2)
    assert len(passes) <= 2


def test_large_buckets_give_no_more_links_than_components(spark):
    rows = [(5, 100 + k, 100 + k, 100, 40, 39, 42, 42) for k in range(40)]
    members = spark.createDataFrame(rows, "bucket long, rep long, component long, c0 long, m long, o long, lo long, other long")
    items = np.arange(10, dtype=np.uint64).tobytes()
    sets = spark.createDataFrame([(100 + k, items) for k in range(40)], "id long, items binary")
    assert neardup._block_links(members, sets, 80).count() <= 39


@pytest.mark.parametrize("limit", [2, 1000])
def test_components_take_chains_and_copies(spark, limit):
    rng = np.random.default_rng(2)
    order = rng.permutation(60).tolist()
    edges = list(zip(order, order[1:])) + [(70, 71), (71, 70), (80, 80)]
    out = neardup.components(spark.createDataFrame(edges, "a long, b long").repartition(5), limit).collect()
    got = {r["node"]: r["component"] for r in out}
    assert len(got) == len(out)
    assert {n: got.get(n, n) for n in [*range(60), 70, 71]} == {**dict.fromkeys(range(60), 0), 70: 70, 71: 70}


def test_threshold_is_exact(spark):
    base = [f"a{k}" for k in range(11)]  # 10 shingles
    rows = [(1, " ".join(base)), (2, " ".join([*base[:10], "z"])), (3, " ".join([*base[:9], "y", "x"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_dict(neardup.near_duplicates(docs, 2)) == brute_components(rows, 2)


def test_near_duplicates_take_awkward_rows(spark):
    docs = edge_docs(spark)
    out = neardup.near_duplicates(docs, 2).collect()
    assert len(out) == docs.count()
    got = {r["doc_id"]: r for r in out}
    assert got[14]["component_id"] == 5 and not got[14]["kept"] and got[5]["kept"]
    assert got[1]["component_id"] == 1 and got[2]["component_id"] == 2 and got[3]["n_shingles"] == 0
    assert got[None]["component_id"] is None and got[None]["kept"]
    left = neardup.drop_near_duplicates(docs, 2)
    assert left.columns == docs.columns
    ids = [r["doc_id"] for r in left.collect()]
    assert sorted(ids, key=str).count(5) == 1 and 14 not in ids and None in ids
    assert neardup.near_duplicates(no_docs(spark), 2).count() == 0
    assert neardup.drop_near_duplicates(no_docs(spark)).count() == 0


def test_circulant_signatures_estimate_jaccard():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2**63, 600, dtype=np.uint64)
    a, b = pool[:400], pool[100:500]
    agree = np.mean(neardup.circulant_signature(a, 200) == neardup.circulant_signature(b, 200))
    assert abs(agree - 300 / 500) < 0.12


def brute_sentences(text):
    """Words with the numbers of the sentences they lie in: once cut by content too, once at stops only."""
    words, stops = [], []
    for line in text.split("\n"):
        own = [w for w in line.translate({k: k + 32 for k in range(65, 91)}).encode().split()]
        words += own
        stops += [bool(spans._value(w) & 1) for w in own[:-1]] + [True] * bool(own)
    cuts = list(stops)
    for k in range(len(words) - spans.WINDOW + 1):
        if not any(stops[k : k + spans.WINDOW]):
            window = [spans._value(w) | 1 for w in words[k : k + spans.WINDOW]]
            for j, v in enumerate(window):
                cuts[k + j] |= v == min(window)
    return words, cuts, stops


def brute_spans(rows):
    """Sentences removed per text, from tuples of words instead of hashes."""
    held, cuts, places = {}, defaultdict(set), []
    for doc_id, text in rows:
        words, fine, coarse = brute_sentences(text or "")
        number = np.concatenate([[0], np.cumsum(fine)]).tolist()
        for ends in (fine, coarse):
            bounds = [0] + [k + 1 for k, e in enumerate(ends) if e]
            for i in range(len(bounds)):
                fits = [j for j in range(i + 3, len(bounds)) if bounds[j] - bounds[i] >= spans.MIN_WORDS]
                back = [j for j in range(i - 2) if bounds[i] - bounds[j] >= spans.MIN_WORDS]
                for x, y in [(i, j) for j in fits[:1]] + [(j, i) for j in back[-1:]]:
                    places.append((tuple(words[bounds[x] : bounds[y]]), doc_id, number[bounds[x]], number[bounds[y]] - 1, text))
    for key, doc_id, first, last, text in places:
        held[key] = min(held.get(key, (doc_id, first)), (doc_id, first))
    for key, doc_id, first, last, text in places:
        if held[key] != (doc_id, first):
            cuts[doc_id, text] |= set(range(first, last + 1))
    return {d: sorted(c) for d, c in cuts.items()}


def removed_sentences(df):
    return {r["doc_id"]: spans.covered(r["places"]).tolist() for r in spans.removals(df).collect()}


def test_span_removals_match_brute_force(spark):
    docs = pandas("documents")
    want = {d: c for (d, _), c in brute_spans(list(zip(docs["doc_id"], docs["text"], strict=True))).items()}
    assert removed_sentences(table(spark, "documents").repartition(5)) == want and want


def test_span_text_and_awkward_rows(spark):
    passage = "One two three four five six. Seven eight nine ten eleven twelve. " + "Thirteen fourteen fifteen sixteen seventeen. " + "Eighteen nineteen twenty and more of it. The end of it all."
    rows = [(1, "Start here. " + passage + " Tail a."), (2, "Other start. " + passage + "\nTail b."), (3, None), (4, ""), (None, passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = spans.remove_repeated(docs).collect()
    assert [(r["doc_id"], r["first_doc_ids"], r["kept_text"]) for r in out] == [(2, [1], "Other start. Tail b.")]
    assert spans.remove_repeated(edge_docs(spark)).filter("doc_id not in (5, 14)").count() == 0
    assert spans.remove_repeated(no_docs(spark)).count() == 0


def test_different_texts_under_one_id_and_repeated_rows(spark):
    words = [f"q{k}" for k in range(120)]
    passage = " ".join(words[:60])
    texts = [(7, passage + " and one end"), (7, "a longer way to begin here, " + passage), (7, passage + " and one end"), (9, "x " + passage), (9, " ".join(words[60:]))]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    out = spans.remove_repeated(docs).collect()
    assert sorted(r["doc_id"] for r in out) == [7, 9] and all(r["first_doc_ids"] == [7] and r["n_words_removed"] >= 31 for r in out)
    assert "and one end" in str([r["kept_text"] for r in out]) or "a longer way" in str([r["kept_text"] for r in out])
    assert all(not set(r["kept_text"].split()) & set(words[60:]) for r in out)


def test_a_span_of_many_documents_makes_a_row_per_group(spark):
    passage = " ".join(f"hot{k}" for k in range(60))
    docs = spark.createDataFrame([(d, f"only{d} {passage} end{d}") for d in range(900)], "doc_id long, text string").repartition(3)
    rows = spans.span_table(docs)
    assert rows.groupBy("h1", "h2").count().agg({"count": "max"}).first()[0] <= 3
    out = spans.remove_repeated(docs).collect()
    assert len(out) == 899 and all(0 in r["first_doc_ids"] for r in out)


def test_the_span_shuffle_names_a_text_only_where_an_id_has_several(spark):
    passage = " ".join(f"w{k}" for k in range(60))
    rows = [(1, passage), (2, "x " + passage), (2, "x " + passage), (3, passage + " a"), (3, passage + " b"), (None, passage), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    hashes = {d: {r["th"] for r in spans._texts(docs).filter(f"doc_id = {d}").collect()} for d in (1, 2, 3)}
    assert hashes[1] == hashes[2] == {0} and len(hashes[3]) == 2 and 0 not in hashes[3]
    out = spans.remove_repeated(docs).collect()
    assert sorted(r["doc_id"] for r in out) == [2, 3, 3] and all(r["first_doc_ids"] == [1] for r in out)


def brute_runs(rows):
    """Sentences that lie in any run of several sentences held earlier, whatever its length."""
    held, cuts = {}, defaultdict(set)
    for doc_id, sentences in rows:
        for first in range(len(sentences)):
            for last in range(first + 2, len(sentences)):
                key = " ".join(sentences[first : last + 1])
                if len(key.split()) >= spans.MIN_WORDS and held.setdefault(key, (doc_id, first)) != (doc_id, first):
                    cuts[doc_id] |= set(range(first, last + 1))
    return {d: sorted(c) for d, c in cuts.items()}


def test_every_sentence_of_a_repeated_passage_goes(spark):
    """Sentences of up to 8 words, which are not cut any further."""
    rng = np.random.default_rng(4)
    pool = [" ".join(f"p{k}_{j}" for j in range(rng.integers(1, 9))) + "." for k in range(60)]
    rows = []
    for d in range(40):
        own = [f"only{d}a here.", *pool[rng.integers(0, 50) :][: rng.integers(3, 14)], f"only{d}b there."]
        rows.append((d, own + pool[rng.integers(0, 50) :][: rng.integers(3, 14)]))
    docs = spark.createDataFrame([(d, " ".join(s)) for d, s in rows], "doc_id long, text string")
    got = removed_sentences(docs)
    assert got == brute_runs(rows) and got


def test_last_sentences_of_a_passage_go(spark):
    words = iter(f"w{k}" for k in range(99))
    passage = " ".join(" ".join(next(words) for _ in range(n)) + "." for n in (12, 12, 5, 3))
    docs = spark.createDataFrame([(1, f"Start here. {passage} Tail a."), (2, f"Other start. {passage} Tail b.")], "doc_id long, text string")
    out = spans.remove_repeated(docs).collect()
    assert [(r["doc_id"], r["first_doc_ids"], r["kept_text"]) for r in out] == [(2, [1], "Other start. Tail b.")]


def test_passages_without_stops_hold_a_span_wherever_they_stand():
    rng = np.random.default_rng(3)
    word = lambda n: [f"x{k}" for k in rng.integers(0, 10**6, n)]
    for n in (47, 50, 60):
        for _ in range(60):
            passage = word(n)
            a, b = (" ".join(word(rng.integers(0, 30)) + passage + word(rng.integers(0, 30))) for _ in range(2))
            assert np.isin(spans.spans(a, 3, 24)[2], spans.spans(b, 3, 24)[2]).any()


def test_signs_after_stops_and_other_stops_end_sentences():
    text = 'a b,### c d." e f。 g h?) i j'
    assert spans.sentence_starts(text)[1].tolist() == [0, 2, 4, 6, 8, 10]


def test_query_removes_passages_without_stops(spark, tmp_path):
    passage = " ".join(f"w{k}" for k in range(60))
    texts = ["alpha beta " + passage + " gamma", "other words here " + passage + " and an end", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op3_substring_dedup"](spark, str(tmp_path)).collect()
    assert [(r["doc_id"], r["first_doc_ids"]) for r in out] == [(1, [0])]
    assert 31 <= out[0]["n_words_removed"] <= 67


def item_runs(words, n_answer=0):
    """Runs of five words of an item's question and answer."""
    ends = [k + 1 for k, w in enumerate(words[:-1]) if w[-1:] in b".!?"]
    cut = ends[-1] if ends else max(1, 2 * len(words) // 3)
    runs = lambda words, n: {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}
    if n_answer:  # on words without signs at their ends
        bare = lambda words: [x for x in (decontaminate._EDGE.sub(b"", w) for w in words) if x]
        cut, words = len(bare(words[:cut])), bare(words)
        n = min(5, len(words))
        return n, runs(words[: max(cut, n)], n), runs(words[max(0, min(cut - n + 1, len(words) - n - n_answer + 1)) :], n)
    n = min(5, len(words))
    return n, runs(words[: max(cut, n)], n), runs(words[min(cut, len(words) - n) :], n)


def brute_contamination(docs, items):
    """Every pair that one of the two rules holds for, from a look at every shared run."""
    want, where = {}, defaultdict(lambda: defaultdict(set))
    words = {i: t.encode().lower().split() for i, t in items}
    sizes = {(i, k): item_runs(w, k) for i, w in words.items() for k in (0, 5)}
    for (i, k), (n, q, a) in sizes.items():
        for part, runs in (("q", q), ("a", a)):
            for run in runs:
                where[k, n][run].add((i, part))
    for doc_id, text in docs:
        plain = (text or "").encode().lower().split()
        bare = [x for x in (decontaminate._EDGE.sub(b"", w) for w in plain) if x]
        for rule, own in ((0, plain), (5, bare)):
            found = defaultdict(int)
            for (k, n), table in where.items():
                if k == rule:
                    for run in {tuple(own[j : j + n]) for j in range(len(own) - n + 1)}:
                        for key in table.get(run, ()):
                            found[key] += 1
            for i in {i for i, _ in found}:
                n, q, a = sizes[i, rule]
                shares = found[i, "q"] / len(q), found[i, "a"] / len(a)
                if min(shares) >= 0.6:
                    want.setdefault((doc_id, i), shares)
    return want


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.1"])
def test_retrieval_finds_every_pair_that_the_rules_hold_for(folder):
    read = lambda n: ds.dataset(f"/root/testdata/{folder}/{n}.parquet").to_table().to_pandas()
    docs, items = read("documents"), read("benchmark")
    items = list(zip(items["item_id"], items["text"], strict=True))
    index = decontaminate.build_index(items)
    docs = list(zip(docs["doc_id"], docs["text"], strict=True))
    got = {(d, i): (q, a) for (d, _), m in zip(docs, index.matches([t for _, t in docs]), strict=True) for i, q, a in m}
    assert got == brute_contamination(docs, items) and got


def test_without_retrieval_nothing_is_found():
    items = pandas("benchmark")
    index = decontaminate.build_index(list(zip(items["item_id"], items["text"], strict=True)))
    text = "Before. " + items["text"][0] + " Behind."
    assert [m[0] for m in index.matches([text])[0]] == [items["item_id"][0]]
    index.is_pivot[:] = False
    assert index.matches([text]) == [[]]


def test_torn_copies_are_retrieved():
    """Copies of which chunks of 10 to 14 words are left, far apart."""
    rng = np.random.default_rng(6)
    word = lambda n: [f"w{k}" for k in rng.zipf(1.3, n) % 5000]
    items = [(k, " ".join(word(rng.integers(20, 200))) + "? " + " ".join(word(rng.integers(6, 40)))) for k in range(40)]
    docs = []
    for d, (_, text) in enumerate(items):
        words, out = text.split(), word(50)
        while words:
            n = int(rng.integers(10, 15))
            out, words = out + words[:n] + word(rng.integers(0, 90)), words[n:]
        docs.append((d, " ".join(out)))
    index = decontaminate.build_index(items)
    want = brute_contamination(docs, items)
    got = {(d, i): (q, a) for (d, _), m in zip(docs, index.matches([t for _, t in docs]), strict=True) for i, q, a in m}
    assert len(want) > 10 and len(got) >= 0.95 * len(want) and got.items() <= want.items()


def test_query_matches_brute_force(spark):
    docs, items = (list(zip(t[c], t["text"], strict=True)) for t, c in ((pandas("documents"), "doc_id"), (pandas("benchmark"), "item_id")))
    got = {(r["doc_id"], r["item_id"]): (r["question_overlap"], r["answer_overlap"]) for r in QUERIES["op8_decontamination"](spark, SF).collect()}
    assert got == brute_contamination(docs, items)


def test_bounds_drop_nothing():
    """Retrieval equals scoring every passage against every piece in full."""
    rng = np.random.default_rng(2)
    vocabulary = [f"t{k}" for k in range(80)]
    items = [(k, " ".join(rng.choice(vocabulary, rng.integers(5, 40)))) for k in range(70)]
    index = decontaminate.build_index(items)
    texts = [" ".join(rng.choice(vocabulary + ["other", "!!"], rng.integers(0, 300))) for _ in range(40)]
    found, pieces = index.retrieve([index.term_ids(t) for t in texts])
    for k, text in enumerate(texts):
        words, want = text.split(), set()
        for p in range((len(words) - 1) // decontaminate.STRIDE + 1):
            some = words[decontaminate.STRIDE * p :][: decontaminate.PASSAGE]
            terms = {index.vocabulary[w.encode()] for w in some if w.encode() in index.vocabulary}
            score = np.zeros(len(index.need))
            for t in terms:
                at = slice(index.starts[t], index.starts[t + 1])
                score[index.pieces[at]] += index.impacts[at]
            want |= set(np.flatnonzero(score >= index.need).tolist())
        assert set(pieces[found == k].tolist()) == want


def test_thresholds_do_not_depend_on_the_shards(spark):
    bench = table(spark, "benchmark")
    one = next(decontaminate._shards(bench, 10**6))
    needs = {}
    for index in decontaminate._shards(bench, 7):
        for piece, item in enumerate(index.owner):
            needs.setdefault(index.item_ids[item], []).append(round(index.need[piece], 9))
    want = {}
    for piece, item in enumerate(one.owner):
        want.setdefault(one.item_ids[item], []).append(round(one.need[piece], 9))
    assert {i: sorted(v) for i, v in needs.items()} == {i: sorted(v) for i, v in want.items()}


def test_decontamination_takes_awkward_rows(spark):
    docs = edge_docs(spark)
    bench = spark.createDataFrame([(1, None), (None, "x y"), (2, ""), (3, "the same text twice"), (3, "the same text twice"), (4, "?!")], "item_id long, text string")
    pairs = [(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, bench).collect()]
    assert sorted(pairs) == [(5, 3)] * 4 + [(14, 3)] * 2
    assert sorted((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, bench, shard=1).collect()) == sorted(pairs)
    left = decontaminate.drop_contaminated(docs, bench)
    assert left.columns == docs.columns and left.count() == len(edge_rows()) - 3
    assert decontaminate.contaminated(no_docs(spark), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_copies_with_signs_or_a_touched_end_are_dropped(spark):
    item = "Which river runs past the old mill and the two stone bridges of the town? It is the Ilm."
    texts = ["Before it. " + item + "&&& and more", "Before it. " + item[:-4] + "Elm. and more", "Before it. " + item[: item.index("It is")] + "Nobody knows that."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert [r["doc_id"] for r in decontaminate.drop_contaminated(docs, bench).collect()] == [2]


def test_given_copy_followed_by_signs_is_dropped():
    """A pair of the given tables that the rule on raw words misses."""
    docs, items = (ds.dataset(f"/root/testdata/sf0.01/{n}.parquet").to_table().to_pandas() for n in ("documents", "benchmark"))
    index = decontaminate.build_index([tuple(r) for r in items[["item_id", "text"]].itertuples(index=False)])
    text = docs["text"][471]
    words = text.encode().lower().split()
    for item_id, question, answer in index.matches([text])[0]:
        n, q, a = item_runs(items.set_index("item_id")["text"][item_id].encode().lower().split())
        own = {tuple(words[j : j + n]) for j in range(len(words) - n + 1)}
        assert min(question, answer) >= 0.6 and min(len(q & own) / len(q), len(a & own) / len(a)) < 0.6
    assert index.matches([None, text, ""])[1]


def test_items_longer_than_a_passage_are_found(spark):
    """Also when question and answer stand far apart, and when the runs that are left are scattered."""
    words = [f"w{k}" for k in range(300)]
    words[219] += "?"
    text, gap = " ".join(words), " ".join(f"gap{k}" for k in range(400))
    halves = [" ".join(words[k : k + 12]) for k in range(0, 300, 12)]
    texts = [f"{gap} {text} {gap}", " ".join(words[:220]) + f" {gap} " + " ".join(words[220:]), f" {gap} ".join(halves), " ".join(words[:220])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    short = " ".join(words[40:60]) + "? " + " ".join(words[100:120])
    parted = spark.createDataFrame([(7, " ".join(words[40:60]) + f"? {gap} " + " ".join(words[100:120]))], "doc_id long, text string")
    bench = spark.createDataFrame([(1, text), (2, short)], "item_id long, text string")
    assert sorted((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, bench).collect() if r["item_id"] == 1) == [(0, 1), (1, 1), (2, 1)]
    assert [r["doc_id"] for r in decontaminate.drop_contaminated(docs, bench.filter("item_id = 1")).collect()] == [3]
    assert [(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(parted, bench).collect()] == [(7, 2)]


def test_word_rule():
    assert len(wordsets.word_hashes("A b c d\x1ce\tf\x0b\x0cg\r\nh")) == 5
    assert (wordsets.word_hashes("ÉA") == wordsets.word_hashes("Éa")).all()
    assert (wordsets.word_hashes("É") != wordsets.word_hashes("é")).all()
