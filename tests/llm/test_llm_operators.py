"""The ten operators against brute force: odd rows, empty tables, whole sf0.001 tables."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import os
import sys
import unicodedata
import zipfile
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from ledgerline.llm import (common, extraction, fingerprints, licenses, minhash, mixing, packing, quality, queries,  # noqa: E402
                            sharding, tokens, warc)

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PAGES = "page_id long, url string, html string"

PROSE = " ".join(f"word{i} of the story number{i % 7}" for i in range(40))
# the extra column names clash with columns that the operators add or use inside
ODD = [
    (5, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \t\n", None, None, 3), (4, "One two", "en", "b", 7),
    (7, PROSE, "en", "a", 1), (8, PROSE, "en", "b", 1), (8, PROSE, "en", "b", 1), (9, PROSE.upper(), None, "b", 1),
    (10, PROSE + " end", "de", None, 1), (11, "x" * 5000, "en", "a", 1), (12, ("same eight words in a row again " * 30), "en", "a", 1),
    (13, "All rights reserved.\nné à Paris 東京 ﬁn\n\n" + PROSE * 3, "fr", "a", 1), (None, PROSE, "en", "a", 1),
    (14, "Released under the MIT License.", "en", "a", 1), (15, "a<|endoftext|> b  c\x1c d  \n\n e's", "en", "a", 1),
]
KINDS = {"odd": ODD, "empty": []}


def documents(spark, kind):
    from pyspark.sql import functions as F
    return (spark.createDataFrame(KINDS[kind], DOCS).repartition(3)
            .withColumns({"size": F.lit("x"), "id": F.lit("y"), "key": F.lit(1), "label": F.lit(None).cast("string"), "shard": F.lit(9)}))


def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def run(spark, name):
    return [r.asDict() for r in queries.QUERIES[name](spark, SF).collect()]


def sf_rows():
    con = duckdb.connect()
    return con.execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def sf_pages():
    return duckdb.connect().execute(f"SELECT page_id, url, html FROM '{SF}/pages.parquet' ORDER BY page_id").fetchall()


# --- 1 licence scans ---------------------------------------------------------

def test_licenses(spark):
    found = {(r["doc_id"], r["license_id"]): r for r in licenses.scan_licenses(documents(spark, "odd")).collect()}
    assert set(found) == {(13, "all-rights-reserved"), (14, "mit")}
    assert found[13, "all-rights-reserved"]["scope"] == "line" and found[14, "mit"]["scope"] == "text"
    assert found[14, "mit"]["dice"] == 1.0
    assert licenses.scan_licenses(documents(spark, "empty")).count() == 0


def test_license_text_over_lines_and_near_text(spark):
    full = licenses.TEMPLATES["gpl-3.0"][1]
    wrapped = "Some title\n\n" + full.replace(" the ", "\nthe ").replace("hope", "wish") + "\n\n" + PROSE
    rows = licenses.scan_licenses(spark.createDataFrame([(1, wrapped)], "doc_id long, text string")).collect()
    assert [(r["license_id"], r["scope"]) for r in rows] == [("gpl-3.0", "paragraph")] and 0.9 < rows[0]["dice"] < 1


# --- 2 token counts ----------------------------------------------------------

def tokenizer(name):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokens.tokenizer_path(name))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'sZ é1! \n\t  ́\x1c\x85<|>") | st.characters(codec="utf-8"), max_size=40), max_size=5))
def test_chunks_encode_like_whole_texts(texts):
    for name, pattern in (("byte_bpe_50k.json", common.SPACED_CHUNK), ("word_bpe_49k.json", common.BARE_CHUNK)):
        whole = [tokenizer_once(name).encode(t, add_special_tokens=False).ids for t in texts]
        assert [sum(p) for p in table_once(name, pattern, False).parts(texts)] == [len(i) for i in whole]
        parts = [np.frombuffer(b"".join(p), "<u4").tolist() for p in table_once(name, pattern, True).parts(texts)]
        assert parts == whole


def test_every_letter_before_every_sign():
    """Letters that the normaliser turns into letter and mark don't end a word before a sign."""
    letters = [chr(i) for i in range(0x80, 0x10000) if chr(i).isalpha()]
    parted = [c for c in letters if len(unicodedata.normalize("NFC", c).lower()) > 1]
    assert len(parted) >= 60 and "\u0130" in parted and "\u0958" in parted
    texts = [f"ab{c}{q} x{c}{c}{q}{q}{c}" for c in parted for q in common.WORD_ENDS + "'-"] + [f"a{c}, {c}!" for c in letters]
    texts += ["T\u00dcRK\u0130YE CUMHUR\u0130YET\u0130.", "ANKARAL\u0130, GELD\u0130!", "\u0958."]
    table, whole = table_once("word_bpe_49k.json", common.BARE_CHUNK, True), tokenizer_once("word_bpe_49k.json")
    for text, parts in zip(texts, table.parts(texts)):
        assert np.frombuffer(b"".join(parts), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, ascii(text)


_MADE: dict = {}


def tokenizer_once(name):
    return _MADE.setdefault(name, None) or _MADE.__setitem__(name, tokenizer(name)) or _MADE[name]


def table_once(name, pattern, ids):
    if (name, ids) not in _MADE:
        _MADE[name, ids] = tokens.ChunkTable(tokens.tokenizer_path(name), pattern, ids)
    return _MADE[name, ids]


def test_full_chunk_table_and_long_texts(monkeypatch):
    monkeypatch.setattr(tokens, "TABLE_ENTRIES", 5)
    table = tokens.ChunkTable(tokens.tokenizer_path("byte_bpe_50k.json"), common.SPACED_CHUNK, False)
    whole = tokenizer("byte_bpe_50k.json")
    for text in (PROSE, PROSE[::-1], "y" * 300 + " z"):
        pieces = list(tokens.pieces_of(text, 50))
        assert "".join(pieces) == text and (len(pieces) > 5 or " " not in text[50:-3])
        assert sum(map(sum, table.parts(pieces))) == len(whole.encode(text, add_special_tokens=False))
    assert list(tokens.pieces_of("", 5)) == [""]


def test_token_counts(spark):
    whole = tokenizer("byte_bpe_50k.json")
    rows = tokens.with_token_counts(documents(spark, "odd"), tokens.tokenizer_path("byte_bpe_50k.json"), limit=10).collect()
    assert len(rows) == len(ODD) and rows[0]["size"] == "x"
    for r in rows:
        n = len(whole.encode(r["text"] or "", add_special_tokens=False))
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len((r["text"] or "").encode()), n > 10)
    assert tokens.with_token_counts(documents(spark, "empty"), tokens.tokenizer_path("byte_bpe_50k.json")).count() == 0


def test_token_counts_of_a_table(spark):
    whole, text = tokenizer("byte_bpe_50k.json"), dict(sf_rows())
    rows = run(spark, "op2_token_counts")
    assert len(rows) == len(text)
    assert all(r["n_tokens"] == len(whole.encode(text[r["doc_id"]], add_special_tokens=False)) for r in rows)


# --- 3 WARC ------------------------------------------------------------------

def b32(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_warc_round_trip(spark):
    odd = [(3, "u3", "same é"), (1, "u1\r\nX: y", "same é"), (2, None, None), (6, "u", ""), (4, "u", "PK\x05\x06 tricky \r\n\r\n"),
           (5, "u", "y" * 300_000), (None, "u", "same é"), (7, "u", "alone"), (7, "u", "alone")]
    pages = spark.createDataFrame(odd, PAGES).repartition(3)
    rows = [r.asDict() for r in warc.read_archives(warc.write_archives(pages), block_bytes=500).collect()]
    first = {"same é": 1, "": 2, "alone": 7}
    expected = sorted(((i is None, i, len((h or "").encode()), b32((h or "").encode()), first.get(h or "", i) if first.get(h or "", i) != i else None)
                       for i, _, h in odd), key=str)
    found = sorted(((r["page_id"] is None, r["page_id"], r["payload_bytes"], r["payload_digest"], r["refers_to"]) for r in rows), key=str)
    assert found == expected
    for r in rows:
        assert (r["record_type"] == "revisit") == (r["refers_to"] is not None) == (r["payload"] is None)
    assert warc.read_archives(warc.write_archives(spark.createDataFrame([], PAGES))).count() == 0


def test_least_bytes_of_a_revisit(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], PAGES)
    rows = {r["page_id"]: r["refers_to"] for r in warc.read_archives(warc.write_archives(pages, min_bytes=3)).collect()}
    assert rows == {1: None, 2: None, 3: None, 4: 3}


def test_warc_of_a_table(spark):
    rows = {r["page_id"]: r for r in run(spark, "op3_warc_packages")}
    pages = sf_pages()
    assert len(rows) == len(pages)
    assert all(rows[i]["payload_digest"] == b32(h.encode()) and rows[i]["payload_bytes"] == len(h.encode()) for i, _, h in pages)


def zip64_file(path, force):
    with zipfile.ZipFile(path, "w") as z:
        z.comment = b"PK\x05\x06 a comment that looks like an end record"
        for i in range(70_000 if force else 3):
            z.writestr(f"m{i}", b"data%d" % i)


@pytest.mark.parametrize("force", [False, True])
def test_package_directories(tmp_path, force):
    path = str(tmp_path / "x.zip")
    zip64_file(path, force)
    with open(path, "rb") as f:
        p = warc.Package(f)
        assert len(p.members) == (70_000 if force else 3)
        assert p.member("m2") == b"data2" and p.range("m1", 2, 2) == b"ta"
        with pytest.raises(ValueError):
            p.range("m1", 2, 100)


def foreign_package(path):
    """A package in the published form: two gzipped archives, a CDXJ and a gzipped CDX index, other kinds of records."""
    def record(kind, url, body, http=True, **more):
        block = (b"HTTP/1.0 200 OK\r\nserver:x\r\nContent-type: text/html;\r\n\tcharset=utf-8\r\n\r\n" + body) if http else body
        fields = {"warc-type": kind, "WARC-Target-URI": url, "WARC-Record-ID": f"<urn:uuid:{url}>", "content-TYPE":
                  "application/http;msgtype=response" if http else "application/warc-fields", **more, "Content-Length": str(len(block))}
        return gzip.compress(b"WARC/1.0\r\n" + "".join(f"{k}:{v}\r\n" for k, v in fields.items()).encode() + b"\r\n" + block + b"\r\n\r\n")

    def archive(records):
        places, at = [], 0
        for raw in records:
            places.append((at, len(raw)))
            at += len(raw)
        return b"".join(records), places

    a, at_a = archive([record("warcinfo", "i", b"software: x\r\n", False), record("response", "http://a.org/1", b"one", **{"WARC-Payload-Digest": f"sha1:{b32(b'one')}"}),
                       record("request", "http://a.org/1", b"GET", **{"Content-Type": "application/http;msgtype=request"})])
    b, at_b = archive([record("response", "http://b.org/2", b"two" * 9), record("resource", "urn:x", b"text", False)])
    cdxj = "!OpenWayback-CDXJ 1.0\n" + "\n".join(f'org,a)/{i} 20200101000000 {json.dumps({"offset": str(o), "length": str(n), "filename": "a.warc.gz"})}' for i, (o, n) in enumerate(at_a))
    cdx = " CDX N b a m s k r M S V g\n" + "\n".join(f"org,b)/{i} 20200101000000 http://b.org/{i} text/html 200 X - - {n} {o} b.warc.gz" for i, (o, n) in enumerate(at_b))
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        z.writestr("datapackage.json", "{}", compress_type=zipfile.ZIP_DEFLATED)
        for name, data in (("archive/a.warc.gz", a), ("archive/b.warc.gz", b), ("indexes/index.cdxj", cdxj), ("indexes/index.cdx.gz", gzip.compress(cdx.encode())), ("pages/pages.jsonl", "{}")):
            z.writestr(name, data)


def test_a_package_made_elsewhere(spark, tmp_path):
    path = str(tmp_path / "other.wacz")
    foreign_package(path)
    for block_bytes in (1, 1 << 20):
        rows = warc.read_archives(warc.manifest_of(spark, [path]), block_bytes).collect()
        assert sorted((r["url"], bytes(r["payload"]), r["record_type"], r["payload_digest"], r["payload_bytes"], r["page_id"]) for r in rows) == [
            ("http://a.org/1", b"one", "response", b32(b"one"), 3, None), ("http://b.org/2", b"two" * 9, "response", b32(b"two" * 9), 27, None),
            ("urn:x", b"text", "resource", b32(b"text"), 4, None)]


def test_index_lines_are_cdxj(spark, tmp_path):
    pages = spark.createDataFrame([(2, "https://www.b.org/x y", "p"), (1, "http://a.org/", "q")], PAGES).coalesce(1)
    [m] = warc.write_archives(pages).collect()
    with zipfile.ZipFile(m["package"].removeprefix("file:")) as z:
        lines = z.read("indexes/index.cdxj").decode().split("\n")
    assert lines == sorted(lines) and [x.split(" ", 2)[:2] for x in lines] == [["org,a)/", "20000101000000"], ["org,b)/x%20y", "20000101000000"]]
    assert json.loads(lines[0].split(" ", 2)[2])["filename"] == "data.warc.gz"


def test_ranges_are_read_by_many_tasks(spark):
    """As many tasks as the bytes ask for, whatever the exchange of ranges weighs."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    manifest = warc.write_archives(pages)
    size = manifest.agg({"size": "sum"}).first()[0]
    rows = warc.read_archives(manifest, block_bytes=size // 20, with_payload=False)
    assert rows.rdd.getNumPartitions() >= 20
    assert len({r["p"] for r in rows.selectExpr("spark_partition_id() AS p").distinct().collect()}) > 8


def test_record_kinds_of_a_table(spark):
    first, want = {}, {}
    for i, _, html in sorted(sf_pages()):
        want[i] = first.setdefault(html or "", i)
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in run(spark, "op3_warc_packages")}
    assert got == {i: ("response", None) if i == f else ("revisit", f) for i, f in want.items()}


def test_broken_packages():
    with pytest.raises(ValueError):
        warc.Package(io.BytesIO(b"no archive at all"))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", b"x" * 100)
    with pytest.raises(ValueError, match="compressed"):
        warc.Package(out).member("a")


# --- 4 fingerprints ----------------------------------------------------------

def test_fingerprints_odd(spark):
    rows = [r.asDict() for r in fingerprints.edited_fingerprints(documents(spark, "odd")).collect()]
    assert len(rows) == len(ODD)
    # the order: doc_id, NULL last; a repeated row is one document
    order = sorted({(r[0] is None, r[0] or 0, r[1] or "") for r in ODD})
    texts = [t for _, _, t in order]
    by_id = {(None if n else i): (t, e) for (n, i, t), e in zip(order, brute.edited(texts))}
    for r in rows:
        text, edit = by_id[r["doc_id"]]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == brute.sha256(edit)
        assert len(r["sketch"]) == min(fingerprints.K, len(brute.shingles(text)))
        assert len(r["edited_sketch"]) == min(fingerprints.K, len(brute.shingles(edit)))
    assert fingerprints.edited_fingerprints(documents(spark, "empty")).count() == 0
    alone = spark.createDataFrame([(1, "abcd")], "doc_id long, text string")
    assert fingerprints.edited_fingerprints(alone).first()["edited_sha256"] == brute.sha256("abab")


def test_fingerprints_of_a_table(spark):
    rows = sorted(run(spark, "op4_fingerprints"), key=lambda r: r["doc_id"])
    texts = [t for _, t in sf_rows()]
    edits = brute.edited(texts)
    assert len(rows) == len(texts)
    off = []
    for i, r in enumerate(rows):
        assert r["edited_sha256"] == brute.sha256(edits[i])
        a, b, c = brute.shingles(texts[i]), brute.shingles(edits[i]), brute.shingles(texts[(i + 1) % len(texts)])
        off += [abs(r["near_edited"] - brute.jaccard(a, b)), abs(r["near_next"] - brute.jaccard(a, c))]
        if len(a | b) <= fingerprints.K:
            assert r["near_edited"] == pytest.approx(brute.jaccard(a, b))
        assert (r["fingerprint"] == r["edited_fingerprint"]) == (a == b) or len(a) > fingerprints.K
    assert max(off) < 0.2 and sum(off) / len(off) < 0.03


def test_sketch_algebra(spark):
    from pyspark.sql import functions as F
    f = fingerprints
    w = [f"w{i}" for i in range(3000)]
    row = spark.createDataFrame([(" ".join(w), " ".join(w[:1500]), "", " ".join(w[1496:]))], "a string, b string, c string, d string")
    s = {c: f.sketch(F.col(c)) for c in "abcd"}
    r = row.select(f.distinct_count(s["a"]).alias("n"), f.containment(s["b"], s["a"]).alias("ba"), f.containment(s["a"], s["b"]).alias("ab"),
                   f.resemblance(s["a"], s["b"]).alias("j"), f.resemblance(s["c"], s["c"]).alias("cc"), f.resemblance(s["a"], s["c"]).alias("ac"),
                   (f.merge(s["b"], s["d"]) == s["a"]).alias("merged")).first()
    assert abs(r["n"] / 2996 - 1) < 0.3 and r["ba"] > 0.85 and abs(r["ab"] - 0.5) < 0.15 and abs(r["j"] - 0.5) < 0.15
    assert (r["cc"], r["ac"], r["merged"]) == (1.0, 0.0, True)
    parts = row.select(F.lit(1).alias("k"), s["b"].alias("sketch")).union(row.select(F.lit(1), s["d"]))
    assert f.merge_parts(parts, "k").first()["sketch"] == row.select(s["a"].alias("s")).first()["s"]


# --- 5 mixing ----------------------------------------------------------------

def test_targets_and_copies(spark):
    rows = [r.asDict() for r in mixing.with_copies(documents(spark, "odd")).collect()]
    assert len(rows) == len(ODD) and all(r["key"] == 1 for r in rows)
    sizes = {}
    for _, text, _, source, _ in ODD:
        sizes[source] = sizes.get(source, 0) + len(brute.words(text))
    wanted = brute.targets(sizes)
    for r in rows:
        assert r["size"] == len(brute.words(r["text"])) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(wanted[r["source"]])
        assert r["copies"] in {int(r["target"] / r["source_size"]), int(r["target"] / r["source_size"]) + 1} and r["copies"] <= 3
    assert mixing.with_copies(documents(spark, "empty")).count() == 0
    mixed = mixing.mix(documents(spark, "odd"))
    assert mixed.columns == documents(spark, "odd").columns and mixed.count() == sum(r["copies"] for r in rows)


@settings(max_examples=8, deadline=None)
@given(sizes=st.lists(st.integers(0, 60), min_size=1, max_size=7))
def test_levels(spark, sizes):
    rows = [(f"s{i}" if i else None, n) for i, n in enumerate(sizes)]
    found = {r["source"]: r["target"] for r in mixing.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    assert found == pytest.approx({k: float(v) for k, v in brute.targets(dict(rows)).items()})


# --- 6 main text -------------------------------------------------------------

def test_main_text_of_odd_pages():
    t = extraction.main_text
    assert (t(None), t(""), t("<nav>a</nav><script>var a='<p>x</p>'</script>"), t("<!-- never closed")) == ("", "", "", "")
    page = """<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><a href=/>x</a></nav>
    <div class="cookie-notice">We use cookies <div>deeply</div> all over</div><div id=sidebar>links</div>
    <article><header><h1>Head&amp;line</h1></header><p>First <b>bold<i>both</b> text<p>Second&nbsp;para &lt;p&gt;
    <form><input name=q>search</form><aside>by the way</aside><ul><li>one<li>two</ul><pre>a
      b</pre><table><tr><td>c1<td>c2</table><div class="ad">Buy</div><p>Last.</p>
    <section class="comments"><article class="comment">Nice!</article></section></article><footer>(c)</footer>"""
    assert t(page) == "Head&line First boldboth text Second para <p> one two a b c1 c2 Last."


def test_main_text_without_article():
    body = "A long paragraph with enough words to be the main text of this page, and then some more of it."
    page = (f"<body><div><a href=/a>Home</a> <a href=/b>About</a></div><div id='content'><h2>Title of it</h2><p>{body}</p><p>{body}</p></div>"
            f"<ul>{'<li><a href=/x>A long link title that goes on and on for a while</a></li>' * 5}</ul><div class='footer'>{body}</div></body>")
    found = extraction.main_text(page)
    assert found == f"Title of it {body} {body}"
    assert extraction.main_text("<p>short</p>") == "short"
    assert extraction.main_text("<p>" * 20_000 + "deep") == "deep"


LONG = "A long paragraph with enough words to be the main text of this page, and then some more of it."


@pytest.mark.parametrize("wrap", [
    "div class='has-sidebar'", "div class='layout no-sidebar'", "div class='content with-sidebar'", "div class='search-results'",
    "div class='elementor-widget-theme-post-content'", "form id='aspnetForm'", "div class='sidebar'", "div style='display:none'",
    "nav", "div class='widget social'", "div class='comments'"])
@pytest.mark.parametrize("tag", ["article", "article class='post comments-open'", "article class='post hentry category-social'", "main", "div role=main"])
def test_main_text_keeps_wrapped_articles(wrap, tag):
    name = tag.split()[0]
    inner = f"<{tag}><h2 id='social-history'>Head</h2><section id='related-work'><p>{LONG}</p></section><div class='related-posts'>More</div></{name}>"
    assert extraction.main_text(f"<body><div class='menu'>M</div><{wrap}>{inner}</{wrap.split()[0]}><footer>(c)</footer>") == f"Head {LONG}"


def test_main_text_reads_attributes():
    """Names of attributes and whole words count, not words inside other values."""
    def page(inner):
        return f"<body><article><h1>Title</h1><p>First words of the story here.</p>{inner}</article></body>"
    base = "Title First words of the story here."
    for tag in ('data-k="a hidden b"', 'title="the hidden cost"', 'style="color: red"', 'data-style="display:none"'):
        assert extraction.main_text(page(f"<p {tag}>Kept.</p>")) == base + " Kept."
    for tag in ("hidden", 'hidden=""', 'aria-hidden="true"', 'style="color:red; display : none"'):
        assert extraction.main_text(page(f"<p {tag}>Gone.</p>")) == base
    for name in ("comments", "newsletter", "cookie-notice", "reader_comments"):
        gone = name != "reader_comments"
        assert extraction.main_text(page(f'<section id="{name}"><p>Inside.</p></section>')) == base + ("" if gone else " Inside.")
    for name in ("related-work", "social-history", "search", "forms"):
        assert extraction.main_text(page(f'<section id="{name}"><p>Inside.</p></section>')) == base + " Inside."


def test_main_text_never_is_a_notice():
    notice = "<div class='cookie-notice'><p>" + "We use cookies to make this site better. " * 20 + "</p></div>"
    story = "<h1>Story</h1><p>" + "Some words of a short story that was written. " * 4 + "</p>"
    assert extraction.main_text(f"<body>{notice}<div>{story}</div></body>") == "Story " + ("Some words of a short story that was written. " * 4).strip()


def test_main_text_keeps_short_blocks_between_adverts():
    ad = "<div class='ad'><p>Buy now and save.</p></div>"
    long = "A paragraph of the article that is long enough to rise above all that stands around it, twice over. "
    page = f"<body><ul><li><a href='/'>Home</a></li><li><a href='/a'>All</a></li><li><a href='/b'>Us</a></li></ul><h1>Head</h1>{ad}<p>{long}</p>{ad}<p>Short.</p>{ad}<h2>Then</h2>{ad}<p>{long}</p></body>"
    assert extraction.main_text(page) == f"Head {long}Short. Then {long}".strip()


def test_main_text_keeps_most_of_the_text():
    for wrap in ("form id='aspnetForm'", "div class='widget'"):
        name = wrap.split()[0]
        assert extraction.main_text(f"<{wrap}><p>{LONG}</p><p>{LONG}</p></{name}><div class='ad'>Buy</div>") == f"{LONG} {LONG}"
        assert extraction.main_text(f"<main><{wrap}><p>{LONG}</p></{name}></main><p>x</p>") == LONG
    story = f"<article><p>{LONG}</p></article>"
    comments = f"<section class='comments'><article><p>{LONG} {LONG}</p></article></section>"
    assert extraction.main_text(story + comments) == extraction.main_text(f"<main>{story}{comments}</main>") == LONG


def test_block_sums_and_regions():
    assert extraction.block_sums([1, 2, 3, 4], 3) == [6, 9, 7, 4]
    assert extraction.regions([0, 0, 50, 40, 0, 0, 0, 5], 60) == [(0, 4)]
    assert extraction.regions([], 1) == []


def test_main_text_of_a_table(spark):
    rows, pages = {r["page_id"]: r for r in run(spark, "op6_main_text")}, sf_pages()
    assert len(rows) == len(pages)
    for i, url, page in pages:
        assert rows[i]["text"] == brute.article_text(page) and rows[i]["n_chars"] == len(rows[i]["text"]) and rows[i]["url"] == url
    odd = spark.createDataFrame([(1, "u", None), (2, None, "")], PAGES)
    assert [(r["text"], r["n_chars"]) for r in extraction.extract(odd).collect()] == [("", 0), ("", 0)]
    assert extraction.extract(spark.createDataFrame([], PAGES)).count() == 0


# --- 7 sharding --------------------------------------------------------------

def shard_rows(df, shards=8):
    return [r.asDict() for r in sharding.shard_by_bytes(df, "h", "doc_id", "bytes", shards).collect()]


def with_hash(df):
    from pyspark.sql import functions as F
    return df.select("*", (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("bytes"), F.xxhash64("text").alias("h"))


def check_shards(rows, shards=8):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    assert set(by) <= set(range(shards))
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    return [sum(r["bytes"] for r in by.get(s, [])) for s in range(shards)]


def test_shards_odd(spark):
    rows = shard_rows(with_hash(documents(spark, "odd")))
    assert len(rows) == len(ODD)
    sizes = check_shards(rows)
    assert max(sizes) - sum(sizes) / 8 <= max(r["bytes"] for r in rows)
    assert shard_rows(with_hash(documents(spark, "empty"))) == []


def test_shards_of_one_large_group(spark):
    same = spark.createDataFrame([(i * 7 - 500, "copy " * 20) for i in range(400)] + [(10_000 + i, f"own {i}") for i in range(800)], "doc_id long, text string")
    sizes = check_shards(shard_rows(with_hash(same)))
    assert max(sizes) - min(sizes) <= 2 * 101


def test_shards_of_a_table(spark):
    rows, text = run(spark, "op7_byte_shards"), dict(sf_rows())
    assert len(rows) == len(text)
    for r in rows:
        raw = text[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
    sizes = check_shards([r | {"bytes": r["size"]} for r in rows])
    assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in rows)


# --- 8 near duplicates --------------------------------------------------------

def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 2000, np.uint64)
    sets = [a[:1], a[:3], a[:1000], a[100:1100], a]
    filled = minhash.sketches(sets, 400)
    assert (filled != minhash._EMPTY).all()
    assert abs((filled[2] == filled[3]).mean() - 900 / 1100) < 0.08 and abs((filled[2] == filled[4]).mean() - 0.5) < 0.1
    assert minhash.band_keys(filled[:1], 80, 5).shape == (1, 80) and minhash.sketches([], 8).shape == (0, 8)


def near(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return [r.asDict() for r in minhash.near_duplicates(df).collect()]


def check_near(found, rows):
    wanted = brute.components(rows)
    assert len(found) == len(rows)
    for r in found:
        assert r["component_id"] == wanted.get(r["doc_id"]) and r["kept"] == (r["doc_id"] is None or r["component_id"] == r["doc_id"])


def test_near_duplicates_odd(spark):
    rows = [r[:2] for r in ODD]
    found = near(spark, rows)
    check_near(found, rows)
    counts = {i: len(brute.shingles(t)) for i, t in rows}
    assert all(r["n_shingles"] == counts[r["doc_id"]] for r in found)
    assert minhash.near_duplicates(documents(spark, "empty")).count() == 0


def test_near_duplicates_in_a_group_without_one_centre(spark):
    """Chains, stars and unlinked neighbours that share most of their words."""
    rng = np.random.default_rng(5)
    base, rows = [f"b{i}" for i in range(120)], []
    for i in range(120):
        words = list(base)
        for at in rng.choice(120, int(rng.integers(0, 9)), replace=False):
            words[at] = f"x{rng.integers(0, 10**6)}"
        rows.append((i, " ".join(words)))
    for i in range(40):  # a chain: each differs a little from the one before
        rows.append((200 + i, " ".join(f"c{k}" for k in range(i * 3, i * 3 + 120))))
    check_near(near(spark, rows), rows)


def test_near_duplicates_of_a_table(spark):
    rows = sf_rows()
    check_near(run(spark, "op8_near_duplicates"), rows)


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(40, 10, -1)] + [(100, x) for x in range(101, 160)] + [(5, 5)]
    found = {r["node"]: r["label"] for r in minhash.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found.get(n, n) == 11 for n in range(11, 42)) and all(found[n] == 100 for n in range(101, 160))


# --- 9 packing -----------------------------------------------------------------

def test_each_word_is_encoded_once(monkeypatch):
    """Plain words go to the tokenizer once, whatever signs follow, without marks between; ids are those of whole texts."""
    path = tokens.tokenizer_path("word_bpe_49k.json")
    table, whole = tokens.ChunkTable(path, common.BARE_CHUNK, True), tokenizer_once("word_bpe_49k.json")

    class Counting:
        made = 0

        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def encode_batch_fast(self, *args, **kinds):
            found = self.tokenizer.encode_batch_fast(*args, **kinds)
            Counting.made += sum(len(e.ids) for e in found)
            return found

    for name in {"tokenizer", "bare"} & set(vars(table)):
        monkeypatch.setattr(table, name, Counting(getattr(table, name)))
    words = [f"w{chr(97 + i)}thond{chr(97 + j)}\u00e9" for i in range(20) for j in range(20)]
    texts = [" ".join(w + sign for w in words[k::3]) for k, sign in enumerate(["", ",", "."])] + [" ".join(words).upper()]
    texts += [".\n ".join(words[:50]) + "!? ", " <|endoftext|>, It's x" + "y" * 200 + ". \x1c\u00c9t\u00e9, 12,5 \u0130.", ""]
    want = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    distinct = sum(len(whole.encode(w, add_special_tokens=False).ids) for w in words)
    ids = [np.frombuffer(b"".join(p), "<u4").tolist() for p in table.parts(texts[:3])]
    assert ids == want[:3] and Counting.made <= distinct + 10
    for entries in (tokens.TABLE_ENTRIES, 5):
        monkeypatch.setattr(tokens, "TABLE_ENTRIES", entries)
        for group in (texts, texts[3:], texts[:1], []):
            found = [np.frombuffer(b"".join(p), "<u4").tolist() for p in table.parts(group)]
            assert found == [want[texts.index(t)] for t in group]
            assert all(len(c) <= tokens.TABLE_CHUNK for c in [*table.words, *table.known])


def test_cut_and_shared_bins():
    for n in (1, 63, 64, 100, 2047, 2048, 2049, 10_000):
        lengths = packing.cut(n)
        assert sum(lengths) == n and all(x == 2048 or x < 64 or x & (x - 1) == 0 for x in lengths)
    left = {1024: 1, 512: 3, 64: 5, 7: 200}
    placed = packing.shared_bins(left)
    assert sorted((a, b) for a, b, _, _ in placed) == sorted((a, i) for a, n in left.items() for i in range(n))
    ends = {}
    for length, _, number, offset in sorted(placed, key=lambda p: p[2:]):
        assert ends.get(number, 0) == offset
        ends[number] = offset + length
    assert max(ends.values()) <= 2048 and len(ends) == 3  # 4280 tokens


def ids_of(rows):
    t = tokenizer("word_bpe_49k.json")
    return {i: t.encode(x or "", add_special_tokens=False).ids + [1] for i, x in rows}


def test_packing_odd(spark):
    unique = [r for i, r in enumerate(ODD) if r[0] not in {x[0] for x in ODD[:i]}]
    KINDS["unique"] = unique
    path = tokens.tokenizer_path("word_bpe_49k.json")
    pieces = [r.asDict() for r in packing.pack(documents(spark, "unique"), path).collect()]
    brute.check_packing(pieces, ids_of([r[:2] for r in unique]))
    assert packing.pack(documents(spark, "empty"), path).count() == 0
    assert packing.pack(documents(spark, "odd"), path).where("start = 0").count() == len(ODD)


def test_packing_of_a_table(spark):
    pieces, ids = run(spark, "op9_packed_sequences"), ids_of(sf_rows())
    n = brute.check_packing(pieces, ids)
    total = sum(map(len, ids.values()))
    assert n <= -(-total // 2048) * 1.03 + 1


# --- 10 quality rules ------------------------------------------------------------

def test_quality_odd(spark):
    rows = [r.asDict() for r in quality.judge(documents(spark, "odd")).collect()]
    assert len(rows) == len(ODD)
    text = {r[0]: r[1] for r in ODD}
    for r in rows:
        for k, v in brute.statistics(text[r["doc_id"]]).items():
            assert r[k] == v, (r["doc_id"], k)
        assert r["kept"] == (not r["base_failed"])  # too few rows for a verdict
    assert quality.judge(documents(spark, "empty")).count() == 0
    kept = quality.filter_quality(documents(spark, "odd"))
    assert kept.columns == documents(spark, "odd").columns and kept.count() == sum(r["kept"] for r in rows)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c\n", "é", " "]), max_size=60).map(" ".join), min_size=1, max_size=6))
def test_repeated_windows(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in quality.statistics(df).collect():
        for k, v in brute.statistics(texts[r["doc_id"]]).items():
            assert r[k] == v


def mcd_brute(x, support, steps, floor):
    """The same concentration steps in numpy, with exact quantiles."""
    centre = np.median(x, axis=0)
    cov = np.diag((1.4826 * np.median(np.abs(x - centre), axis=0)) ** 2 + floor**2)
    factor = quality.consistency(x.shape[1], support)
    for _ in range(steps):
        d = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(cov), x - centre)
        near_rows = x[d <= np.sort(d)[int(np.ceil(support * len(d))) - 1]]
        centre, cov = near_rows.mean(axis=0), factor * np.cov(near_rows.T, bias=True) + np.diag(floor**2)
    return np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(cov), x - centre)


def test_mcd_against_numpy(spark):
    rng = np.random.default_rng(3)
    good = rng.multivariate_normal([0, 1, 2, 3], np.diag([1, 4, 9, 1]) + 0.5, 300)
    x = np.vstack([good, rng.normal(30, 1, (60, 4))])
    names = quality.FEATURES
    df = spark.createDataFrame([("p", *map(float, r)) for r in x], "pool string, " + ", ".join(f"{n} double" for n in names))
    shapes = quality.fit(df, floor=dict.fromkeys(names, 0.1))
    found = sorted(r["d"] for r in df.join(shapes, "pool").select(quality.Shape(names).distance().alias("d")).collect())
    wanted = np.sort(mcd_brute(x, quality.SUPPORT, quality.STEPS, np.full(4, 0.1)))
    assert np.allclose(found, wanted, rtol=0.02)
    assert (np.array(found) > 100).sum() == 60


def test_small_groups_are_judged_in_their_language(spark):
    """Groups under 40 rows have a verdict, in their own language and drawn to their own source."""
    rng = np.random.default_rng(7)

    def text(size, symbols=0):
        words = ["".join(rng.choice(list("abcdefghij"), max(1, int(rng.normal(size, 1))))) for _ in range(80)]
        return " ".join(words + ["#$%&|" * 4] * symbols)

    groups = {("de", "a"): (12, 9), ("de", "b"): (30, 6), ("en", "a"): (60, 4), ("fr", "a"): (4, 5)}
    rows = [(text(size), *key) for key, (n, size) in groups.items() for _ in range(n)]
    junk = [(text(9, 40), "de", "a"), (text(6, 40), "de", "b"), (text(4, 40), "en", "a")]
    rows = [(i, *r) for i, r in enumerate(rows + junk)]
    schema = "doc_id long, text string, lang string, source string"
    found = {r["doc_id"]: r for r in quality.judge(spark.createDataFrame(rows, schema)).collect()}
    good = len(rows) - len(junk)
    assert all((found[i]["distance"] is None) == (rows[i][2] == "fr") for i in found)
    assert [found[i]["kept"] for i in range(good, len(rows))] == [False] * 3
    assert all(found[i]["kept"] for i in range(good))
    # other languages' rows change nothing
    alone = quality.judge(spark.createDataFrame([r for r in rows if r[2] == "de"], schema)).collect()
    assert all(r["distance"] == pytest.approx(found[r["doc_id"]]["distance"]) for r in alone)
    # a small group is drawn to its own rows: the few long words of a are nearer than with all rows in one source
    pooled = quality.judge(spark.createDataFrame([r[:3] + ("all",) for r in rows if r[2] == "de"], schema)).collect()
    own = [r["doc_id"] for r in pooled if rows[r["doc_id"]][3] == "a" and r["doc_id"] < good]
    far = {r["doc_id"]: r["distance"] for r in pooled}
    assert np.median([found[i]["distance"] for i in own]) < 0.95 * np.median([far[i] for i in own])


def test_quality_of_a_table(spark):
    rows, text = run(spark, "op10_quality_rules"), dict(sf_rows())
    assert len(rows) == len(text)
    for r in rows:
        wanted = brute.statistics(text[r["doc_id"]])
        assert {k: r[k] for k in wanted} == wanted
        assert not (r["kept"] and r["base_failed"])
    labels = dict(duckdb.connect().execute(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    clean = [r["kept"] for r in rows if labels.get(r["doc_id"]) == 1 and not r["base_failed"]]
    assert sum(clean) / len(clean) > 0.97
