"""Fill-in-middle: chunk summaries against plain counting, the query against SQL and a plain version."""

from __future__ import annotations

import hashlib
import os
import random
import re
import sys

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from ledgerline.llm import infilling, queries  # noqa: E402
from test_llm_operators import SF, documents  # noqa: E402


def plain(doc_id, text, seed=1):
    """(n, form, prefix, middle, output) by slicing the text."""
    text = text or ""
    hexed = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexed[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(text)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


TEXTS = st.text(alphabet=st.sampled_from(list("ab \t\n<PSM>é東😀")), max_size=60)


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.integers(1, 40), st.sampled_from(["chars", "words"]))
def test_summaries_combine(text, size, unit):
    """Cut anywhere between characters, the chunks' summaries add up to the text's, and every unit is found."""
    data = text.encode()
    memo = infilling.ChunkMemo(unit)
    whole = infilling.Text(data, memo)
    # chunks of any size, not only those that the rolling hash would choose
    ends = [e for e in range(size, len(data), size) if data[e] & 0xC0 != 0x80] + [len(data)] * bool(data)
    whole.ends, whole.parts = ends, [memo.of(data[a:b]) for a, b in zip([0, *ends], ends)]
    rebuilt = infilling.Text.__new__(infilling.Text)
    rebuilt.data, rebuilt.unit, rebuilt.ends, rebuilt.parts = data, unit, ends, whole.parts
    rebuilt.combine()
    if unit == "chars":
        bounds = [len(text[:k].encode()) for k in range(len(text) + 1)]
    else:
        bounds = [0, *(len(text[:m.end()].encode()) for m in re.finditer(r"[^\x20\x09-\x0D]+", text))]
    assert rebuilt.units == len(bounds) - 1
    assert [rebuilt.byte_at(k) for k in range(len(bounds))] == bounds
    assert rebuilt.whole.marked == any(s in text for s in ("<P>", "<S>", "<M>"))


def test_chunks_follow_content():
    """Equal passages give equal chunks wherever they stand; chunks are whole, bounded and cut between characters."""
    rng = random.Random(5)
    shared = "".join(rng.choice("abcdefgé 東") for _ in range(20_000)).encode()
    chunks = []
    for k in (0, 1, 7, 4000):
        data = ("x" * k).encode() + shared
        ends = infilling.cut_points(data)
        assert ends[-1] == len(data)
        own = [data[a:b] for a, b in zip([0, *ends], ends)]
        assert max(map(len, own)) <= infilling.LONGEST_CHUNK
        for c in own:
            c.decode()
        chunks.append(set(own))
    assert len(set.intersection(*chunks)) > 0.9 * min(map(len, chunks))
    same = ("é" * 40_000).encode()
    assert b"".join(same[a:b] for a, b in zip([0, *infilling.cut_points(same)], infilling.cut_points(same))) == same


def test_blocks_do_not_show(monkeypatch):
    data = random.Random(3).randbytes(50_000).translate(bytes(32 + i % 90 for i in range(256)))
    whole = infilling.cut_points(data)
    monkeypatch.setattr(infilling, "BLOCK", 1000)
    assert infilling.cut_points(data) == whole and len(whole) > 50


def test_memo_is_bounded():
    memo = infilling.ChunkMemo("chars", limit=100)
    for i in range(50):
        assert memo.of(f"chunk {i}".encode()).units == len(f"chunk {i}")
        assert sum(map(len, memo.known)) <= 110


@pytest.mark.parametrize("kind", ["odd", "empty"])
def test_odd_rows(spark, kind):
    docs = documents(spark, kind).withColumnRenamed("size", "form")
    rows = infilling.fill_in_middle(docs)
    assert set(rows.columns) == {*docs.columns, "n", "form", "prefix_units", "middle_units", "output"}
    rows = rows.withColumn("back", infilling.restored(rows["output"], rows["form"])).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r["n"], r["form"], r["prefix_units"], r["middle_units"], r["output"]) == plain(r["doc_id"], r["text"])
        assert r["back"] == (r["text"] or "")


def test_every_form_and_very_long_texts(spark):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choice("ab <é東PSM>") for _ in range(rng.randrange(40)))) for i in range(400)]
    rows += [(1000 + i, ("é東a b" * 300_000)[i:]) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = infilling.fill_in_middle(docs)
    got = {r["doc_id"]: r for r in out.withColumn("back", infilling.restored(out["output"], out["form"])).collect()}
    for i, text in rows:
        r = got[i]
        assert (r["n"], r["form"], r["prefix_units"], r["middle_units"], r["output"]) == plain(i, text)
        assert r["back"] == text
    assert {r["form"] for r in got.values()} == {"plain", "psm", "spm"}


def test_words_are_not_cut(spark):
    rows = [(i, f"  one two  three four {i} \n five") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for r in infilling.fill_in_middle(docs, unit="words", fim_percent=100, spm_percent=0).collect():
        pieces = re.fullmatch("<P>(.*)<S>(.*)<M>(.*)", r["output"], re.S).groups()
        assert [len(brute.words(p)) for p in pieces] == [r["prefix_units"], r["n"] - r["prefix_units"] - r["middle_units"], r["middle_units"]]
        assert r["n"] == 6


def test_query_against_sql_and_plain(spark):
    got = {r["doc_id"]: r.asDict() for r in queries.QUERIES["op13_fill_in_middle"](spark, SF).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    found = con.execute(queries.SQL["op13_fill_in_middle"])
    names = [c[0] for c in found.description]
    sql = {r[0]: dict(zip(names, r)) for r in found.fetchall()}
    assert got == sql
    for i, text in con.execute("SELECT doc_id, text FROM documents").fetchall():
        n, form, prefix, middle, output = plain(i, text)
        assert got[i] == {"doc_id": i, "n": n, "form": form, "prefix_chars": prefix, "middle_chars": middle,
                          "output_sha256": brute.sha256(output), "restored_sha256": brute.sha256(text)}
