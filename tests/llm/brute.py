"""Plain Python versions of the operators' definitions, for small tables."""

from __future__ import annotations

import hashlib
import html
import re
import zlib
from collections import Counter, defaultdict

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORDS.findall(text or "")


def shingles(text, size=5):
    w = words((text or "").translate(LOWER))
    return frozenset([tuple(w)] if 0 < len(w) < size else [tuple(w[i:i + size]) for i in range(len(w) - size + 1)])


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def components(rows, percent=85, size=5):
    """doc_id -> smallest reachable doc_id for rows (doc_id, text), all pairs that share a shingle compared."""
    sets = [(i, shingles(t, size)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    holders = defaultdict(list)
    for n, (_, s) in enumerate(sets):
        for g in s:
            holders[g].append(n)
    shared = Counter((a, b) for ns in holders.values() for k, b in enumerate(ns) for a in ns[:k])
    for (a, b), c in shared.items():
        if 100 * c >= percent * (len(sets[a][1]) + len(sets[b][1]) - c):
            x, y = find(sets[a][0]), find(sets[b][0])
            parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in parent}


def edited(texts):
    """Edited text of each of the texts, which stand in ascending doc_id."""
    out = []
    for i, t in enumerate(texts):
        half = len(t) // 2
        out.append(t[:len(t) - half] + texts[(i + 1) % len(texts)][:half])
    return out


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def targets(sizes, weights=(5, 2, 1), most=3):
    """Targets per source by sharing out the excess again and again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target, open_ = sum(sizes.values()), {}, set(names)
    while open_:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s]}
        if not over:
            return target | share
        target |= {s: most * sizes[s] for s in over}
        open_ -= over
    return target


def article_text(page):
    """Text of the article element of a page that has one and no markup tricks in it."""
    inside = page[page.index("<article>"):page.index("</article>")]
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inside)).split())


def statistics(text):
    w = words(text)
    seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if seen[tuple(w[i:i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    n, repeated = len(w), len(covered)
    return {"n_words": n, "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": repeated,
            "base_failed": n < 20 or 100 * repeated > 30 * n}


def check_packing(pieces, ids_of, capacity=2048):
    """Assert that pieces (dicts) hold every id once and sequences are gapless and not overfull."""
    import numpy as np
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    assert set(by_doc) == set(ids_of)
    for doc_id, own in by_doc.items():
        at, ids = 0, ids_of[doc_id]
        for p in sorted(own, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            at += p["length"]
            assert p["ids_crc32"] == zlib.crc32(np.array(ids[p["start"]:at], "<u4").tobytes())
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity
    return len(by_sequence)
