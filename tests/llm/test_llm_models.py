"""Classifiers, packing, rollups and the pipeline."""

import zlib

import numpy as np
import pytest
from helpers import SF, edge_docs, edge_rows, no_docs, pandas, table
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablelearn.llm import decontaminate, langid, nets, packing, quality, rollups, tokens, toxicity
from tablelearn.llm.queries import QUERIES


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def labelled(spark, rows, schema="doc_id long, text string, lang string, quality int, toxic int"):
    return spark.createDataFrame(rows, schema)


GOOD = "the quiet river runs past an old mill where people meet and talk about rain"
BAD = "CLICK!! BUY!! WIN!! FREE!! CLICK!! BUY!!"


def test_quality_learns_and_takes_awkward_rows(spark):
    rows = [(k, f"{GOOD} {k}" if k % 3 else f"{BAD} {k}!!", "en", int(k % 3 > 0), 0) for k in range(300)]
    docs = labelled(spark, rows)
    out = {r["doc_id"]: r for r in quality.classify_quality(docs, docs).collect()}
    held = [k for k in range(300) if fold(k, 5) == 0]
    assert all(out[k]["held_out"] == (k in held) for k in range(300))
    assert np.mean([out[k]["predicted"] == rows[k][3] for k in held]) > 0.95
    edge = quality.classify_quality(edge_docs(spark), docs.select("doc_id", "quality")).collect()
    assert len(edge) == len(edge_rows()) and all(0 <= r["score"] <= 1 for r in edge)
    none = quality.classify_quality(docs, docs.limit(0)).agg(F.min("score"), F.max("score")).first()
    assert none[0] == none[1] == pytest.approx(0.5)
    assert quality.classify_quality(no_docs(spark), docs.select("doc_id", "quality")).count() == 0
    kept = quality.drop_low_quality(docs, docs)
    assert kept.columns == docs.columns and abs(kept.count() - 200) < 15


def test_quality_is_blind_to_held_out_labels(spark):
    rows = [(k, f"{GOOD} {k}" if k % 3 else f"{BAD} {k}!!", "en", int(k % 3 > 0), 0) for k in range(120)]
    flipped = [(*r[:3], 1 - r[3] if fold(r[0], 5) == 0 else r[3], 0) for r in rows]
    a = quality.classify_quality(labelled(spark, rows), labelled(spark, rows)).orderBy("doc_id").collect()
    b = quality.classify_quality(labelled(spark, rows), labelled(spark, flipped)).orderBy("doc_id").collect()
    assert a == b


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 3))
    y = (rng.random(4000) < nets.sigmoid(2 * x[:, 0])).astype(float)
    model = nets.fit_two_layer(x, y, np.ones(4000))
    score = model.score(x)
    for lo in (0.2, 0.5, 0.8):
        near = abs(score - lo) < 0.08
        assert abs(y[near].mean() - score[near].mean()) < 0.08


LANGS = {"aa": "kalo miru tanepo sila ", "bb": "schwurz gräbt knirpf ßtok ", "cc": "où eau çe étoile "}


def test_language_learns_and_takes_awkward_rows(spark):
    rng = np.random.default_rng(4)
    rows = []
    for k in range(240):
        lang = sorted(LANGS)[k % 3]
        rows.append((k, " ".join(rng.choice(LANGS[lang].split(), 60)), lang, 1, 0))
    docs = labelled(spark, rows)
    out = {r["doc_id"]: r for r in langid.identify_languages(docs).collect()}
    assert all(out[k]["held_out"] == (fold(k, 4) == 2) for k in out)
    assert np.mean([out[k]["lang_pred"] == rows[k][2] for k in out if out[k]["held_out"]]) > 0.9
    edge = {r["doc_id"]: r for r in langid.identify_languages(edge_docs(spark)).collect()}
    assert len(edge) == len({r[0] for r in edge_rows()})
    assert all(edge[k]["lang_pred"] == "und" and edge[k]["score"] == 0 for k in (1, 2, 3, 13))
    assert edge[4]["lang_pred"] == "en" and langid.identify_languages(no_docs(spark)).count() == 0
    assert {r["lang_pred"] for r in langid.identify_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_byte_windows_cover_whole_texts():
    data = langid._bytes("Añ" * 1000)
    found, sizes = langid.windows(data)
    assert found.reshape(-1)[: len(data)].tobytes() == data.tobytes() and sizes.sum() == len(data)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abc", min_size=3, max_size=10), min_size=1, max_size=6, unique=True), st.text("abcd", max_size=12))
def test_trie_automaton_equals_edit_distance(terms, word):
    want = min(((edit_distance(word, t), k) for k, t in enumerate(terms) if edit_distance(word, t) <= toxicity.edits_allowed(t)), default=None)
    assert toxicity.TrieAutomaton(terms).match(word) == want


def test_automaton_takes_beginnings():
    auto = toxicity.TrieAutomaton(["veju*", "pathetic", "scum"])
    assert auto.match("vejuance") == (0, 0) and auto.match("xejuance") is None
    assert auto.match("pathetik") == (1, 1) and auto.match("scun") is None and auto.match("") is None


def test_toxicity_learns_and_takes_awkward_rows(spark):
    rng = np.random.default_rng(8)
    calm = [f"calm{k}" for k in range(200)]
    rows = []
    for k in range(400):
        words = list(rng.choice(calm, 40))
        if k % 4 == 0:
            words[5:5] = ["you", str(rng.choice(["moronic", "worthless", "idiotic"]))]
        rows.append((k, " ".join(words), "en", 1, int(k % 4 == 0)))
    docs = labelled(spark, rows)
    out = {r["doc_id"]: r for r in toxicity.classify_toxicity(docs, docs).collect()}
    held = [k for k in out if out[k]["held_out"]]
    assert held == [k for k in out if fold(k, 3) == 1]
    assert all(out[k]["predicted"] == rows[k][4] for k in held)
    model = toxicity.fit_toxicity(docs, docs)
    assert {"moronic", "worthless", "idiotic"} <= {t.rstrip("*") for t in model.terms} or any(t.endswith("*") for t in model.terms)
    plain, quoted = model.features("you worthless thing calm1"), model.features('he said "worthless" calm1')
    assert plain[0] > quoted[0] > 0 and quoted[4] == 1 and plain[4] == 0
    assert model.features("you wortless thing")[0] > 0
    edge = toxicity.classify_toxicity(edge_docs(spark), docs.select("doc_id", "toxic")).collect()
    assert len(edge) == len(edge_rows()) and all(0 <= r["score"] <= 1 for r in edge)
    assert toxicity.classify_toxicity(no_docs(spark), docs.limit(0)).count() == 0
    assert {r["predicted"] for r in toxicity.classify_toxicity(docs, docs.limit(0)).collect()} == {0}


def whole_text_ids(texts):
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(tokens.vocabulary_path())
    return [np.asarray(one.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_word_by_word_ids_equal_whole_text_ids():
    odd = ["Áb, J̌ x\x1cy a\xa0b it's IT'S. <|startoftext|> <|STARTOFTEXT|> ́c ... a.. 3.5, don't,", "İstanbul ﬁ Ǆ,", "", None, " \n", "ªº ⅷ ² ＡＢ ß ẞ ŉ", "a b\x85c 1,2. é. É, é."]
    texts = odd + pandas("documents")["text"].tolist()
    assert tokens.token_bytes(texts, tokens.vocabulary_path()) == whole_text_ids(texts)


def check_packing(out, capacity):
    at = out.sort_values(["sequence_id", "offset"])
    ends = at.groupby("sequence_id")["length"].cumsum()
    assert ((ends - at["length"]) == at["offset"]).all() and ends.max() <= capacity


def test_packing_matches_brute_force_tokens(spark):
    docs = pandas("documents")
    out = QUERIES["op5_best_fit_packing"](spark, SF).toPandas()
    check_packing(out, 2048)
    want = {}
    for doc_id, ids in zip(docs["doc_id"], whole_text_ids(docs["text"]), strict=True):
        ids += b"\0\0\0\0"
        for k in range(0, len(ids), 8192):
            want[doc_id, k // 8192] = (k // 4, len(ids[k : k + 8192]) // 4, zlib.crc32(ids[k : k + 8192]))
    got = {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in out.itertuples()}
    assert got == want
    assert out["sequence_id"].nunique() <= -(-out["length"].sum() // 2048) * 1.02 + 1


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=30), st.integers(1, 40))
def test_plan_places_every_item(histogram, groups):
    classes = packing.plan(histogram, 64, groups)
    used = {}
    for n, own in classes:
        assert n > 0 and own and sum(own) <= 64
        for length in own:
            used[length] = used.get(length, 0) + n
    assert used == histogram
    # With groups of one item nothing is rounded: close to first fit decreasing, or better.
    bins = []
    for length in sorted((k for k, n in histogram.items() for _ in range(n)), reverse=True):
        at = next((k for k, room in enumerate(bins) if room >= length), None)
        if at is None:
            bins.append(64 - length)
        else:
            bins[at] -= length
    assert sum(n for n, _ in packing.plan(histogram, 64, 10_000)) <= 1.2 * len(bins) + 1


def test_packing_takes_awkward_rows(spark):
    out = packing.pack(edge_docs(spark)).toPandas()
    check_packing(out, 2048)
    assert (out["piece"] == 0).sum() == len(edge_rows())
    assert out[out["doc_id"] == 1]["length"].tolist() == [1] and len(out[out["doc_id"] == 4]) > 10
    assert packing.pack(no_docs(spark)).count() == 0


EVENTS = "op string, doc_id long, source string, lang string, tokenizer string, tokens long, old_source string, old_lang string, old_tokenizer string, old_tokens long"


def test_rollup_batches_are_signed_and_idempotent(spark, tmp_path):
    roll = rollups.Rollup(spark, str(tmp_path / "r"))
    batch = lambda rows: spark.createDataFrame(rows, EVENTS)
    none = (None, None, None, None)
    first = batch([("insert", 1, "a", "en", "v1", 10, *none), ("insert", 2, "a", "en", "v1", 5, *none), ("insert", 3, None, None, "v1", None, *none)])
    assert roll.totals().count() == 0
    assert roll.commit("one", first) and not roll.commit("one", first)
    second = batch([("revise", 1, "b", "en", "v2", 12, "a", "en", "v1", 10), ("delete", 2, "a", "en", "v1", 5, *none)])
    assert roll.commit("two", second) and roll.commit("empty", batch([]))
    want = {("b", "en", "v2"): (1, 12), (None, None, "v1"): (1, 0)}
    get = lambda: {tuple(r)[:3]: tuple(r)[3:] for r in roll.totals().collect()}
    assert get() == want
    roll.compact()
    assert get() == want and not roll.commit("two", second)
    assert roll.commit("three", batch([("insert", 9, "b", "en", "v2", 1, *none)]))
    want["b", "en", "v2"] = (2, 13)
    assert get() == want
    roll.compact()
    assert get() == want
    # A batch left without its success mark is neither read nor in the way.
    (tmp_path / "r" / "batch=four").mkdir()
    (tmp_path / "r" / "batch=four" / "part-0.parquet").write_bytes(b"torn")
    assert get() == want and roll.commit("four", batch([("delete", 9, "b", "en", "v2", 1, *none)]))
    want["b", "en", "v2"] = (1, 12)
    assert get() == want
    with pytest.raises(Exception, match="unknown op"):
        roll.commit("five", batch([("upsert", 1, "a", "en", "v1", 1, *none)]))


def test_token_counts_match_brute_force(spark):
    docs = pandas("documents").sort_values("doc_id").drop_duplicates("text")
    want = {}
    for source, lang, ids in zip(docs["source"], docs["lang"], whole_text_ids(docs["text"]), strict=True):
        n, t = want.get((source, lang, "word_bpe_49k/2"), (0, 0))
        want[source, lang, "word_bpe_49k/2"] = (n + 1, t + len(ids) // 4 + 1)
    assert {tuple(r)[:3]: tuple(r)[3:] for r in QUERIES["op7_token_counts"](spark, SF).collect()} == want
    assert rollups.corpus_rollup(no_docs(spark)).count() == 0
    assert rollups.corpus_rollup(edge_docs(spark)).agg(F.sum("documents")).first()[0] == len({r[1] or "" for r in edge_rows()}) + 1


def test_pipeline_matches_brute_force(spark):
    import corpus_pipeline
    from test_pairs import brute_components

    docs = pandas("documents").sort_values("doc_id").reset_index(drop=True)
    out = corpus_pipeline.run(spark, SF).toPandas()
    check_packing(out, 2048)
    score = quality.classify_quality(table(spark, "documents"), table(spark, "labels"))
    good = {r["doc_id"] for r in score.filter("predicted = 1").collect()}
    docs = docs[docs["doc_id"].isin(good)]
    key = lambda x: x.strip(" \t\n\x0b\f\r").translate({k: k + 32 for k in range(65, 91)})
    holders = {}
    for d, text in zip(docs["doc_id"], docs["text"], strict=True):
        for x in text.split("\n"):
            if len(key(x)) >= 40:
                holders.setdefault(key(x), set()).add(d)
    gone = {k: max(v) for k, v in holders.items() if len(v) >= 5}
    rows = [(d, "\n".join(x for x in t.split("\n") if gone.get(key(x), d) == d)) for d, t in zip(docs["doc_id"], docs["text"], strict=True)]
    parts = brute_components(rows, 5)
    rows = [(d, t) for d, t in rows if parts[d][1] == d]
    index = decontaminate.build_index([tuple(r) for r in pandas("benchmark")[["item_id", "text"]].itertuples(index=False)])
    rows = [(d, t) for (d, t), held in zip(rows, index.matches([t for _, t in rows]), strict=True) if not held]
    sizes = {d: len(ids) // 4 + 1 for (d, _), ids in zip(rows, whole_text_ids([t for _, t in rows]), strict=True)}
    assert out.groupby("doc_id")["length"].sum().to_dict() == sizes


def test_pipeline_stages_keep_columns(spark):
    import corpus_pipeline

    docs = edge_docs(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, no_docs(spark), SF).count() == 0
