"""The pipeline's stages, one on the other's result, against the brute-force definitions."""

from __future__ import annotations

import os
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from ledgerline.llm import minhash, quality  # noqa: E402
from test_llm_operators import documents, ids_of  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, results = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        results.append(docs)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    kept, alone, mixed, packed = ([r.asDict() for r in d.collect()] for d in results)

    verdict = {r["doc_id"]: r["kept"] for r in quality.judge(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    assert sorted(r["doc_id"] for r in kept) == sorted(i for i, v in verdict.items() if v)

    component = brute.components([(r["doc_id"], r["text"]) for r in kept], corpus_pipeline.NEAR_PERCENT)
    assert sorted(r["doc_id"] for r in alone) == sorted(i for i, c in component.items() if i == c)

    sizes = Counter()
    for r in alone:
        sizes[r["source"]] += len(brute.words(r["text"]))
    wanted, copies = brute.targets(dict(sizes)), Counter(r["doc_id"] for r in mixed)
    for r in alone:
        rate = wanted[r["source"]] / sizes[r["source"]]
        assert copies[r["doc_id"]] in (int(rate), int(rate) + 1)

    ids = ids_of({(r["doc_id"], r["text"]) for r in mixed})
    assert sum(r["length"] for r in packed) == sum(len(ids[i]) * n for i, n in copies.items())
    assert Counter(r["doc_id"] for r in packed if r["start"] == 0) == copies


def test_near_copies_from_080(spark):
    """Likeness 0.80 to 0.84 goes in the stage and stays in op8's links; under 0.80 stays in both."""
    def text(k, changed, of=200):
        return " ".join(f"new{k}x{i}" if of - changed <= i else f"w{k}x{i}" for i in range(of))

    rows, less = [], set()
    for k, changed in enumerate((17, 18, 20, 21, 22, 23, 40)):
        rows += [(10 * k, text(k, 0), "en", "a", 1), (10 * k + 1, text(k, changed), "en", "a", 1)]
        if brute.jaccard(brute.shingles(rows[-2][1]), brute.shingles(rows[-1][1])) < 0.8:
            less.add(10 * k + 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stays = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()}
    assert stays == {r[0] for r in rows if r[0] % 10 == 0} | less and 0 < len(less) < 4
    assert {r["doc_id"] for r in minhash.near_duplicates(docs).where("kept").collect()} > stays
    for percent, bands in ((85, minhash.BANDS), (corpus_pipeline.NEAR_PERCENT, minhash.BANDS_80)):
        assert (1 - (percent / 100) ** minhash.ROWS) ** bands < 1e-6


def test_near_dedup_of_a_table(spark):
    """The stage on the whole table against all pairs at 0.80."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sets = {r["doc_id"]: brute.shingles(r["text"]) for r in docs.select("doc_id", "text").collect()}
    holders, label = {}, {i: i for i in sets}
    for i, own in sorted(sets.items()):
        for near in {j for g in own for j in holders.get(g, ())}:
            if 100 * len(own & sets[near]) >= 80 * len(own | sets[near]):
                low, high = sorted((label[i], label[near]))
                label = {k: low if v == high else v for k, v in label.items()}
        for g in own:
            holders.setdefault(g, []).append(i)
    stays = sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, SF).collect())
    assert stays == sorted(i for i, v in label.items() if i == v)


def test_equal_rows_of_a_kept_document(spark):
    """One of the equal rows of a kept document stays; other rows of its id and rows without id stay."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, "en", "a", 1)] * 3 + [(1, text, "en", "b", 1), (2, text + " end", "en", "a", 1), (3, "alone", "en", "a", 1), (3, "alone", "en", "a", 1),
                                           (None, text, "en", "a", 1), (None, text, "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_dedup(spark, docs, SF)
    assert out.columns == docs.columns
    assert sorted(((r["doc_id"], r["source"]) for r in out.collect()), key=str) == [(1, "a"), (1, "b"), (3, "a"), (None, "a"), (None, "a")]


def test_odd_and_empty_documents(spark):
    for kind in ("odd", "empty"):
        docs = documents(spark, kind)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            docs = out
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert packed.count() >= 0


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).where("length < 1 OR length > 2048 OR offset + length > 2048").count() == 0


def test_texts_stay_where_they_are_after_near_dedup(spark):
    """Ids that go or come twice are broadcast behind their count: no join shuffles the documents' texts."""
    rows = [(i, f"some words of their own number {i} and {i * 7} end", "en", "a", 1) for i in range(40)]
    rows += [(100 + i, rows[i][1], "en", "a", 1) for i in range(10)] + [rows[20], rows[21], (21, "another text of a known id here", "en", "a", 1), (None, "x y", "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        left = corpus_pipeline.near_dedup(spark, docs, SF)
        plan = left._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        found = Counter(tuple(r) for r in left.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert found == Counter({r: 1 for r in rows if r[0] is None or r[0] < 100})
