"""Fill-in-middle transformation by content-defined chunks and a memo of their summaries.

A rolling hash over the last 32 bytes cuts the UTF-8 bytes of a text where its
high bits are zero, so equal passages of different texts fall into equal chunks
wherever they stand. A chunk's summary says how many units it holds and what a
neighbour must know of its two ends; summaries of neighbours combine (a monoid),
so the units of a text are the combined summaries of its chunks. A worker keeps
summaries by chunk content (equal bytes, not only equal hashes) in a table of
bounded size, and a passage that many documents share is counted once. A cut
after k units is located by running totals over the chunks; only the chunk that
holds it is looked through.

Units are code points (``chars``) or words between white space of ASCII
(``words``: a unit ends with its word, leading white space belongs to the next).

A text keeps its order (form ``plain``) if it is empty, holds a sentinel or the
draw says so; else prefix, middle and suffix are dealt as ``psm`` or ``spm``.
All draws come from the document's id and a seed, so reruns agree.

Defined results: NULL texts are empty texts (0 units, ``plain``); a NULL id
draws as an empty id; equal ids draw alike; very long texts are hashed in blocks, so memory follows
one text, not the number of texts; repeated rows are transformed each, alike;
an empty table gives an empty result; extra columns pass through, those named
like a new column are replaced.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The sentinels and the shares of the forms, in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FIM_PERCENT, SPM_PERCENT = 90, 20
SEED = 1

WINDOW = 32                  # bytes that the rolling hash sees
CHUNK_BITS = 9               # a chunk of 512 bytes on average
LONGEST_CHUNK = 8192         # a chunk is cut here at the latest
BLOCK = 1 << 20              # bytes hashed at once
TABLE_BYTES = 64 << 20       # chunk bytes that one worker remembers

_SPACE = b" \t\n\x0b\x0c\r"
_SENTINELS = tuple(s.encode() for s in (PREFIX, SUFFIX, MIDDLE))
_EDGE = max(map(len, _SENTINELS)) - 1


def _gear() -> np.ndarray:
    """A 32-bit number per byte value, from a fixed rule."""
    x = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(32))).astype(np.uint32)


GEAR = _gear()


def rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the last ``WINDOW`` bytes at every place: each byte's number, shifted by its age."""
    h = GEAR[data]
    age = 1
    while age < WINDOW:          # doubles the window at each step
        h[age:] += h[:-age] << np.uint32(age)
        age *= 2
    return h


def cut_points(data: bytes) -> list[int]:
    """Ends of the chunks of a text: content decides, whatever stands more than a window before."""
    raw, ends = np.frombuffer(data, np.uint8), []
    # high bits hold all bytes of the window, low bits only the last few
    top = np.uint32(((1 << CHUNK_BITS) - 1) << (32 - CHUNK_BITS))
    for start in range(0, len(raw), BLOCK):
        lead = min(start, WINDOW - 1)
        h = rolling(raw[start - lead:start + BLOCK])[lead:]
        ends.append(np.flatnonzero((h & top) == 0) + start + 1)
    found = np.concatenate(ends) if ends else np.empty(0, np.int64)
    found = found[found < len(raw)]
    found = found[(raw[found] & 0xC0) != 0x80]      # only in front of a character
    out, last = [], 0
    for end in [*found.tolist(), len(raw)]:
        while end - last > LONGEST_CHUNK:
            last += LONGEST_CHUNK
            while raw[last] & 0xC0 == 0x80:
                last -= 1
            out.append(last)
        if end > last:
            out.append(end)
            last = end
    return out


@dataclass(frozen=True, slots=True)
class Summary:
    """What a stretch of text tells its neighbours.

    ``units`` ended inside, whether a unit is ``open`` at the end and whether
    the stretch ``starts`` inside a unit; first and last bytes and whether a
    sentinel was seen.
    """

    units: int
    starts: bool
    open: bool
    head: bytes
    tail: bytes
    marked: bool

    def then(self, other: Summary) -> Summary:
        """The summary of this stretch and the next one together.

        A word open at the end of one and going on in the next is one unit;
        it is counted where it ends.
        """
        ended = self.open and not other.starts
        joint = self.tail + other.head
        return Summary(self.units + ended + other.units, self.starts, other.open,
                       (self.head + other.head)[:_EDGE] if len(self.head) < _EDGE else self.head,
                       (self.tail + other.tail)[-_EDGE:] if len(other.tail) < _EDGE else other.tail,
                       self.marked or other.marked or any(s in joint for s in _SENTINELS))


def summary(chunk: bytes, unit: str) -> Summary:
    """A chunk's own summary."""
    raw = np.frombuffer(chunk, np.uint8)
    marked = any(s in chunk for s in _SENTINELS)
    if unit == "chars":
        return Summary(int(((raw & 0xC0) != 0x80).sum()), False, False, chunk[:_EDGE], chunk[-_EDGE:], marked)
    gap = np.isin(raw, np.frombuffer(_SPACE, np.uint8))
    # a word ends where white space follows it; one that runs to the chunk's end is open
    ended = int((~gap[:-1] & gap[1:]).sum())
    return Summary(ended, not gap[0], not gap[-1], chunk[:_EDGE], chunk[-_EDGE:], marked)


EMPTY = Summary(0, False, False, b"", b"", False)


def unit_end(chunk: bytes, k: int, unit: str) -> int:
    """Bytes of ``chunk`` up to the end of its k-th unit."""
    raw = np.frombuffer(chunk, np.uint8)
    if unit == "chars":
        starts = np.flatnonzero((raw & 0xC0) != 0x80)
        return len(chunk) if k >= len(starts) else int(starts[k])
    gap = np.isin(raw, np.frombuffer(_SPACE, np.uint8))
    ends = np.flatnonzero(~gap & np.append(gap[1:], True)) + 1
    return int(ends[k - 1])


class ChunkMemo:
    """Summaries by chunk content; emptied when its chunks exceed a bound."""

    def __init__(self, unit: str, limit: int = TABLE_BYTES):
        if unit not in ("chars", "words"):
            raise ValueError("unit must be 'chars' or 'words'")
        self.unit, self.limit, self.held, self.known = unit, limit, 0, {}

    def of(self, chunk: bytes) -> Summary:
        found = self.known.get(chunk)
        if found is None:
            if self.held > self.limit:
                self.held, self.known = 0, {}
            found = self.known[chunk] = summary(chunk, self.unit)
            self.held += len(chunk)
        return found


class Text:
    """A text as chunks with running unit counts."""

    def __init__(self, data: bytes, memo: ChunkMemo):
        self.data, self.unit, self.ends = data, memo.unit, cut_points(data)
        starts = [0, *self.ends[:-1]]
        self.parts = [memo.of(data[a:b]) for a, b in zip(starts, self.ends)]
        self.combine()

    def combine(self) -> None:
        """Running totals of ended units, and the summary of the whole text."""
        whole = list(accumulate(self.parts, Summary.then))
        self.whole = whole[-1] if whole else EMPTY
        self.totals = [w.units for w in whole]
        self.units = self.whole.units + self.whole.open

    def byte_at(self, k: int) -> int:
        """Bytes of the text up to the end of its k-th unit."""
        if k <= 0:
            return 0
        at = bisect_left(self.totals, k)
        if at == len(self.totals):    # the word that is open at the end of the text
            return len(self.data)
        start = self.ends[at - 1] if at else 0
        before = self.totals[at] - self.parts[at].units
        if before >= k:               # the unit ended with the chunk before
            return start
        return start + unit_end(self.data[start:self.ends[at]], k - before, self.unit)


def _draws(seed: int, id_col: Column) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _rearranged(unit: str, fim_percent: int, spm_percent: int):
    """An Arrow function (text, h1..h4) -> the dealt text and where it was cut."""
    tags = [s.encode() for s in (PREFIX, SUFFIX, MIDDLE)]

    def deal(text: str, draws: tuple, memo: ChunkMemo) -> tuple:
        data = text.encode()
        whole = Text(data, memo)
        n = whole.units
        h1, h2, h3, h4 = draws
        if not data or whole.whole.marked or h3 % 100 >= fim_percent:
            return n, "plain", None, None, text
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        i, j = whole.byte_at(a), whole.byte_at(b)
        prefix, middle, suffix = data[:i], data[i:j], data[j:]
        p, s, m = tags
        spm = h4 % 100 < spm_percent
        out = b"".join((s, suffix, p, prefix, m, middle) if spm else (p, prefix, s, suffix, m, middle))
        return n, "spm" if spm else "psm", a, b - a, out.decode()

    @F.pandas_udf("n long, form string, prefix_units long, middle_units long, output string")
    def rearranged(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        memo = ChunkMemo(unit)
        for text, *draws in batches:
            rows = [deal(t or "", d, memo) for t, d in zip(text, zip(*(x.tolist() for x in draws)))]
            n, form, prefix, middle, output = zip(*rows) if rows else ((),) * 5
            yield pd.DataFrame({
                "n": pd.Series(n, dtype="int64"), "form": pd.Series(form, dtype="object"),
                "prefix_units": pd.Series(prefix, dtype="Int64"), "middle_units": pd.Series(middle, dtype="Int64"),
                "output": pd.Series(output, dtype="object")})

    return rearranged


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, unit: str = "chars",
                   fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """Add n (units), form, prefix_units, middle_units and output (the dealt text) to every row."""
    dealt = _rearranged(unit, fim_percent, spm_percent)(F.coalesce(F.col(text_col), F.lit("")), *_draws(seed, F.col(id_col)))
    new = ["n", "form", "prefix_units", "middle_units", "output"]
    rows = docs.select(*[F.col(c) for c in docs.columns if c not in new], dealt.alias("_dealt"))
    return rows.select(*[c for c in rows.columns if c != "_dealt"], *[F.col(f"_dealt.{c}").alias(c) for c in new])


def restored(output: Column, form: Column) -> Column:
    """The text before it was dealt.

    A sentinel's first place after its piece is the sentinel that was put
    there: no piece holds one, and none can start in a piece and end in a tag.
    """
    size = len(PREFIX)
    body = F.substr(output, F.lit(size + 1))
    first = F.when(form == "psm", F.lit(SUFFIX)).otherwise(F.lit(PREFIX))
    lead = F.when(form == "psm", F.substring_index(body, SUFFIX, 1)).otherwise(F.substring_index(body, PREFIX, 1))
    rest = F.substr(body, F.length(lead) + F.length(first) + 1)
    second = F.substring_index(rest, MIDDLE, 1)
    middle = F.substr(rest, F.length(second) + size + 1)
    return (F.when(form == "plain", output).when(form == "psm", F.concat(lead, middle, second))
            .otherwise(F.concat(second, middle, lead)))


def oracle_sql(seed: int = SEED) -> str:
    """The digest columns from the definition, with substring over code points."""
    p, s, m = PREFIX, SUFFIX, MIDDLE
    return f"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex FROM documents),
numbers AS (
  SELECT doc_id, text, length(text) AS n,
         list_transform(range(4), lambda i: CAST('0x' || substr(hex, 8 * i + 1, 8) AS BIGINT)) AS h
  FROM drawn),
places AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(text, '{p}') OR contains(text, '{s}') OR contains(text, '{m}') OR h[3] % 100 >= {FIM_PERCENT}
              THEN 'plain' WHEN h[4] % 100 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form
  FROM numbers),
pieces AS (
  SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix FROM places)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{p}' || prefix || '{s}' || suffix || '{m}' || middle
              ELSE '{s}' || suffix || '{p}' || prefix || '{m}' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM pieces"""
