import hashlib
from collections import Counter

import duckdb
import pytest
from helpers import SF, edge_docs, edge_rows, no_docs, pandas, table
from pyspark.sql import functions as F

from tablelearn.llm import fingerprints, lines
from tablelearn.llm.oracles import ORACLE_SQL
from tablelearn.llm.queries import QUERIES


def generalised_jaccard(a, b):
    x, y = Counter(a.split()), Counter(b.split())
    top = sum(max(x[w], y[w]) for w in {*x, *y})
    return sum(min(x[w], y[w]) for w in {*x, *y}) / top if top else 1.0


def test_edited_fingerprints_match_brute_force(spark):
    docs = pandas("documents").sort_values("doc_id").reset_index(drop=True)
    rows = {r["doc_id"]: r for r in QUERIES["op1_fingerprints"](spark, SF).collect()}
    assert sorted(rows) == docs["doc_id"].tolist()
    texts = docs["text"].tolist()
    errors, seen = [], {}
    for k, (doc_id, text) in enumerate(zip(docs["doc_id"], texts, strict=True)):
        r, after = rows[doc_id], texts[(k + 1) % len(texts)]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        errors += [r["near_edited"] - generalised_jaccard(text, edited), r["near_next"] - generalised_jaccard(text, after)]
        assert seen.setdefault(text, r["fingerprint"]) == r["fingerprint"]
    # The collision rate is an unbiased estimate of the generalised Jaccard similarity.
    assert abs(sum(errors) / len(errors)) < 0.02
    assert (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.12


def test_fingerprint_weights_count(spark):
    """A word repeated more often pulls the collision rate as the generalised Jaccard says."""
    a = " ".join(["red"] * 30 + ["blue"] * 10)
    b = " ".join(["red"] * 10 + ["blue"] * 30)
    docs = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    fp = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprint_documents(docs, samples=128).collect()}
    same = sum(fp[1][8 * k : 8 * k + 8] == fp[2][8 * k : 8 * k + 8] for k in range(128)) / 128
    assert abs(same - 1 / 3) < 0.13


@pytest.mark.parametrize("chars", [20_000, 1_500_000])
def test_fingerprints_take_awkward_rows(spark, chars):
    out = fingerprints.edited_fingerprints(edge_docs(spark), chars_per_bucket=chars).collect()
    assert len(out) == len(edge_rows())
    one = {r["doc_id"]: r for r in out}
    assert one[1]["n_chars"] == 0 and one[1]["fingerprint"] == one[2]["fingerprint"] == one[3]["fingerprint"]
    assert one[1]["near_next"] == 1.0 and one[5]["fingerprint"] == one[14]["fingerprint"]
    # Ties of doc_id 5 are neighbours; the row without id is first, so the last one's next.
    assert max(r["near_next"] for r in out if r["doc_id"] == 5) == 1.0
    last = "the same text twice"
    assert one[14]["edited_sha256"] == hashlib.sha256((last[:10] + "no id at "[:9]).encode()).hexdigest()
    assert fingerprints.edited_fingerprints(no_docs(spark)).count() == 0


def test_line_dedup_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    rows = con.execute(ORACLE_SQL["op6_line_dedup"]).fetchall()
    out = QUERIES["op6_line_dedup"](spark, SF).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()
    assert sorted(map(tuple, out)) == sorted(rows)


def test_lines_take_awkward_rows(spark):
    docs = edge_docs(spark)
    out = lines.dedup_lines(docs, min_docs=5)
    assert out.columns == docs.columns and out.count() == docs.count()
    text = {r["doc_id"]: r["text"] for r in out.collect()}
    assert text[8] == "own one" and text[10] == "own three" and text[11] == "" and text[12] == edge_rows()[13][1]
    assert text[1] is None and text[4] == edge_rows()[4][1]
    maps = {r["doc_id"]: r for r in lines.keep_bitmaps(docs).collect()}
    assert maps[11]["n_dropped"] == 2 and maps[11]["bitmap"][0]["bits"] & 3 == 0 and maps[8]["bitmap"][0]["bits"] & 3 == 2
    assert lines.dedup_lines(no_docs(spark)).count() == 0


def test_line_bitmaps_of_many_lines(spark):
    """Words beyond the first, a key in the same document several times, and ties."""
    own = [f"line number {k} of a document, all of its own making" for k in range(150)]
    shared = "this is the sentence that all of the documents have in common"
    rows = [(d, "\n".join([*[f"{d} {x}" for x in own[:d]], shared, shared, "end"])) for d in range(60, 140, 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(docs).collect()}
    for d, text in rows:
        assert got[d] == (text if d == 130 else text.replace(shared + "\n", ""))


def test_native_plans_hold_no_python(spark):
    for name in ("op1_fingerprints", "op6_line_dedup"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_bitmap_word_bits(spark):
    got = spark.range(1).select(F.expr("shiftleft(1L, cast(63 as int))")).first()[0]
    assert got == -(2**63)
