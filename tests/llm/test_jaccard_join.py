"""The n-gram Jaccard join against all pairs: whole tables, hot groups, chains at the threshold, odd rows."""

from __future__ import annotations

import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from ledgerline.llm import jaccard_join as jj  # noqa: E402
from ledgerline.llm import queries, sets  # noqa: E402
from test_llm_operators import SF, documents, sf_rows  # noqa: E402


def found(spark, rows, percent=85, size=4):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = jj.jaccard_components(docs, size=size, percent=percent).collect()
    assert len(out) == len(rows)
    return {r["doc_id"]: r["component_id"] for r in out}, {r["doc_id"]: r["n_shingles"] for r in out}


def edits(rng, words, k):
    out = list(words)
    for _ in range(k):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**9)}"
    return " ".join(out)


def families(seed, n_bases, of, most):
    """Near copies by random edits of a base text, with likeness on either side of the threshold."""
    rng, rows = random.Random(seed), []
    for b in range(n_bases):
        base = [f"w{b}x{rng.randrange(10**6)}" for _ in range(120)]
        rows += [(len(rows) + i, edits(rng, base, rng.randrange(most))) for i in range(of)]
    return rows


def test_table(spark):
    got = {r["doc_id"]: r.asDict() for r in queries.QUERIES["op11_jaccard_join"](spark, SF).collect()}
    rows = sf_rows()
    want = brute.components(rows, 85, 4)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(got[i]["n_shingles"] == len(brute.shingles(t, 4)) for i, t in rows)
    assert len(set(want.values())) < len(want)


@pytest.mark.parametrize("small", [96, 4])
def test_families(spark, monkeypatch, small):
    """One large family with passages that others share, and many small ones, also when regions are split deeper."""
    monkeypatch.setattr(jj, "SMALL", small)
    rng = random.Random(7)
    rows = families(1, 1, 120, 8) + [(1000 + i, t) for i, t in families(2, 12, 9, 7)]
    rows += [(3000 + i, " ".join(["a passage that very many of these texts share"] * 2 + [f"own{i}x{rng.randrange(9)}" for _ in range(30)]))
             for i in range(60)]
    got, _ = found(spark, rows)
    assert got == brute.components(rows, 85, 4)


def test_regions_are_split(spark, monkeypatch):
    """Families that share rare passages stand in one block; regions part them."""
    monkeypatch.setattr(jj, "SMALL", 6)
    steps = []
    split = jj.Join.split
    monkeypatch.setattr(jj.Join, "split", lambda self, members, turn: (lambda pw: (steps.append((pw[0].count(), pw[1].count())), pw)[1])(
        split(self, members, turn)))
    rng, rows = random.Random(3), []
    for b in range(10):
        own = [f"f{b}w{i}" for i in range(100)]
        for i in range(8):
            body = edits(rng, own, i % 5).split()
            at = rng.randrange(90)
            rows.append((len(rows), " ".join(body[:at] + "one rare passage of five words".split() + body[at:])))
    # the shared passage is put first in the order, so that it is a block
    monkeypatch.setattr(jj, "rarity", lambda source, of: _passage_first(of))
    got, _ = found(spark, rows)
    assert got == brute.components(rows, 85, 4)
    assert any(parts for parts, _ in steps)


def _passage_first(of):
    counts = np.full(sets.BUCKETS, 9, np.int64)
    counts[sets.bucket(of(b"one rare passage of five words"))] = 0
    return counts


@pytest.mark.parametrize("percent, size", [(60, 4), (80, 5), (95, 1), (100, 4)])
def test_other_thresholds(spark, percent, size):
    rows = families(4, 5, 14, 12)
    got, n = found(spark, rows, percent, size)
    assert got == brute.components(rows, percent, size)
    assert all(n[i] == len(brute.shingles(t, size)) for i, t in rows)


def test_ties_at_the_threshold(spark):
    """17 of 20 shingles link, 16 of 19 (84.2 %) don't; a chain is one component."""
    def text(own, shared):
        return " ".join(f"s{i}" for i in range(shared + 3)) + "".join(f" {own}{i}" for i in range(3))
    rows = [(1, " ".join(f"s{i}" for i in range(20))), (2, text("p", 17)), (3, text("q", 16)), (4, text("q", 16) + " z")]
    got, _ = found(spark, rows)
    assert got == brute.components(rows, 85, 4)


@pytest.mark.parametrize("kind", ["odd", "empty"])
def test_odd_rows(spark, kind):
    docs = documents(spark, kind)
    got = jj.jaccard_components(docs).collect()
    assert len(got) == docs.count()
    want = brute.components([(r["doc_id"], r["text"]) for r in docs.collect()], 85, 4)
    for r in got:
        assert r["component_id"] == want.get(r["doc_id"])


def test_texts_under_one_id(spark):
    """Different texts of one id: all its rows are in one component, equal sets link."""
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    docs = spark.createDataFrame([(1, a), (1, b), (2, b), (3, a + " end"), (4, a), (5, b + " end")], "doc_id long, text string")
    once = sorted(map(tuple, jj.jaccard_components(docs).select("doc_id", "component_id").collect()))
    assert once == sorted(map(tuple, jj.jaccard_components(docs.repartition(3)).select("doc_id", "component_id").collect()))
    component = dict(once)
    assert component[1] == component[2] == component[4] == 1


def test_very_long_text(spark):
    long = " ".join(f"w{i % 40_000}" for i in range(200_000))
    rows = [(1, long), (2, long + " tail"), (3, "short one"), (4, "SHORT one"), (5, "short")]
    got, n = found(spark, rows)
    assert got == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5} and n[1] == 40_000


def test_counts_of_shingles_reach_the_driver_as_columns(spark):
    """All counts of the sketch, without a Python object per bucket (87 MB here before)."""
    import tracemalloc

    from ledgerline.llm import minhash
    texts = [" ".join(f"w{d}x{i}" for i in range(1000)) for d in range(300)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = np.zeros(sets.BUCKETS, np.int64)
    for text in texts:
        np.add.at(want, sets.bucket(minhash.set_of(text and text.encode())), 1)
    tracemalloc.start()
    try:
        counts = sets.rarity(docs, minhash.set_of)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert np.array_equal(counts, want)
    assert peak < 20e6
    assert not sets.rarity(docs.limit(0), minhash.set_of).any()
