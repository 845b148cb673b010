"""The prefix trie against a plain version and SQL, with one shard and with many."""

from __future__ import annotations

import hashlib
import os
import random
import sys
import zlib
from collections import defaultdict

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from ledgerline.llm import conversations, queries  # noqa: E402
from test_llm_operators import SF  # noqa: E402

TURNS = "conv_id long, turn long, role string, text string, path string, key string, shard string"


def plain(rows):
    """Nodes of rebuilt conversations, every prefix looked at; ties of a turn by digest as stated."""
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            one = (role or "", text or "")
            digest = hashlib.md5(f"{len(one[0].encode())}:{one[0]}{one[1]}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0, digest), one))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        path = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)

    def below(p):
        return [p, *(q for k in children[p] for q in below(k))]

    out = []
    for p, cs in members.items():
        sub = below(p)
        out.append({
            "conv_id": min(cs), "depth": len(p), "parent_conv_id": min(members[p[:-1]]) if p else None, "n_convs": len(cs),
            "n_children": len(children[p]), "n_leaves": sum(not children[q] for q in sub),
            "saved_tokens": sum((len(members[q]) - 1) * len(brute.words(q[-1][1])) for q in sub if q),
            "ends_sha256": hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()})
    return sorted(out, key=lambda r: (r["depth"], r["conv_id"]))


def trie(df, **kw):
    lists = conversations.turn_lists(df)
    rows = conversations.prefix_trie(conversations.paths_of(conversations.rebuilt(lists)), **kw).collect()
    return sorted((r.asDict() for r in rows), key=lambda r: (r["depth"], r["conv_id"]))


def many(seed=1, n=400):
    """A hot conversation and first turn, copies, a long conversation, odd rows."""
    rng, rows = random.Random(seed), []
    for c in range(n):
        if c % 3 == 0:
            turns = [("user", "hot first turn"), ("assistant", "hot answer here")]
        else:
            turns = [("user", "hot first turn")] * (c % 2) + [("user", f"t {rng.randrange(4)}") for _ in range(rng.randrange(1, 6))]
        rows += [(c, t, r, x, "a", "b", "c") for t, (r, x) in enumerate(turns)]
    rows += [(1000, t, "user", f"long {t % 3}", None, None, None) for t in range(300)]
    rows += [(1001, t, "user", f"long {t % 3}", None, None, None) for t in range(290)]
    rows += [(2001, None, None, None, None, None, None), (2001, 0, "a", "bc", None, None, None), (2001, 0, "ab", "c", None, None, None),
             (2001, 0, "ab", "c", None, None, None), (None, 1, "x", "y", None, None, None), (2002, 5, "a", "", None, None, None),
             (2003, 1, "u", "\t  \n", None, None, None), (2023, 1, "u", "é 東 " * 9000, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shards, depth", [(1, 256), (3, 256), (40, 256), (40, 2), (7, 0)])
def test_any_sharding(spark, shards, depth):
    rows = many()
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    assert trie(df, shards=shards, depth=depth) == plain(rows)


def test_children_that_cannot_wait(spark, monkeypatch):
    """A bound on waiting children and on id blocks changes no result."""
    monkeypatch.setattr(conversations, "WAITING", 1)
    monkeypatch.setattr(conversations, "ID_BLOCK", 3)
    rows = many(2, 150)
    batches = conversations._scan(frozenset([conversations.ROOT]))
    paths = conversations.paths_of(conversations.rebuilt(conversations.turn_lists(spark.createDataFrame(rows, TURNS))))
    import pyarrow as pa
    flat = sorted(((0, bytes(r["path"]), r["conv_id"], r["words"]) for r in paths.collect()), key=lambda r: r[1:3])
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*flat)], ["shard", "path", "conv_id", "words"])
    found = [r for b in batches(iter([batch])) for r in b.to_pylist()]
    late = [r for r in found if r["kind"] == "late"]
    known = {r["key"]: r["conv_id"] for r in found if r["kind"] != "partial" and r["key"] is not None and r["ids"] is None}
    assert late and {r["parent"] for r in late} <= set(known)
    nodes = {(r["depth"], r["conv_id"]): (r["parent_conv_id"] if r["kind"] == "node" else known.get(r["parent"]), r["n_convs"])
             for r in found if r["kind"] in ("node", "late") and r["depth"] > 1}
    assert nodes == {(r["depth"], r["conv_id"]): (r["parent_conv_id"], r["n_convs"]) for r in plain(rows) if r["depth"] > 1}
    blocks = [r for r in found if r["kind"] == "ends"]
    assert [r["block"] for r in blocks] == list(range(len(blocks)))


def test_late_children_by_join(spark, monkeypatch):
    """Children handed on before their parent closes get its id by a join (the bound is read where the scan runs)."""
    source = conversations._scan

    def low_bound(skeleton):
        inner = source(skeleton)

        def scanned(batches):
            from ledgerline.llm import conversations as c
            c.WAITING, c.ID_BLOCK = 2, 3
            yield from inner(batches)
        return scanned

    monkeypatch.setattr(conversations, "_scan", low_bound)
    rows = many(3, 200)
    assert trie(spark.createDataFrame(rows, TURNS), shards=2) == plain(rows)


def test_empty_and_single(spark):
    assert trie(spark.createDataFrame([], TURNS)) == []
    one = [(7, 0, "user", "a b", None, None, None)]
    assert trie(spark.createDataFrame(one, TURNS)) == plain(one)
    turnless = [(7, 0, "user", "a b", None, None, None), (8, 0, "user", "c", None, None, None)]
    assert trie(spark.createDataFrame(turnless, TURNS)) == plain(turnless)
    assert any(zlib.crc32(str(c).encode()) % 4 > 0 for c in (7, 8))


def test_skeleton_numbers():
    a, b, c = (bytes([k]) * 16 for k in (1, 2, 3))
    found = conversations.skeleton_of([(a + b, 1), (a + c, 2), (b, 0)])
    assert [(pre, last, kids) for _, _, pre, last, kids in found] == [(0, 4, 2), (1, 3, 2), (2, 2, 0), (3, 3, 0), (4, 4, 0)]


def test_query_against_sql_and_plain(spark):
    got = sorted((r.asDict() for r in queries.QUERIES["op12_prefix_trie"](spark, SF).collect()), key=lambda r: (r["depth"], r["conv_id"]))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    found = con.execute(queries.SQL["op12_prefix_trie"])
    names = [d[0] for d in found.description]
    sql = sorted((dict(zip(names, r)) for r in found.fetchall()), key=lambda r: (r["depth"], r["conv_id"]))
    assert got == sql
    assert got == plain(con.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall())
