"""Token counts: whole texts encoded inside Arrow functions, lengths only come back.

A text is cut into chunks at safe boundaries: before a run of white space that
follows another character. The byte-level pre-tokenizer takes white space only
in front of a word, so none of its pieces crosses such a cut, and special
strings hold no white space; the sum of the chunks' token counts is therefore
the count of the whole text. Texts are worked through in groups of a bounded
number of bytes, whatever the rows; chunks seen before are counted from a
bounded table, and only new ones go to the tokenizer, in batches of their own.

For token ids a group of texts is cut at white space, its chunks are told apart
and the ids are put together by Arrow, so Python meets each chunk once a group.

Defined results: NULL and empty texts have 0 bytes and 0 tokens; a text
without white space is one chunk; repeated rows are counted each; an empty
table gives an empty result; extra columns pass through unless their name is
one of the new columns, which then replaces them.
"""

from __future__ import annotations

import os
import re
import string
import sys
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import BARE_CHUNK, SAFE_CUT, SEPARATORS, SPACED_CHUNK, UNICODE_SPACE, WORD_ENDS, byte_batches

GROUP_CHARS = 1_000_000      # characters worked through at once
TABLE_ENTRIES = 800_000      # chunks remembered by one Python worker
TABLE_CHUNK = 64             # longer chunks are not remembered
ENCODE_BYTES = 200_000       # UTF-8 bytes in one call of the tokenizer
JOINED_CHUNKS = 2000         # chunks without white space that are encoded as one text
WIDE_SPACE = UNICODE_SPACE.replace("\t-\r ", "[") + "]"   # white space beyond ASCII
MARK = "\x01"                # stands between them, if the tokenizer gives it an id of its own


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class ChunkTable:
    """Token ids (or counts) of chunks, worked out once by the tokenizer.

    ``ids=True`` keeps little-endian unsigned 32-bit ids as bytes. The tables are
    emptied when they are full, so their memory is bounded whatever the texts hold.
    Chunks without white space are cut once more, behind a letter and before a
    sign that ends a word. Words of plain letters are encoded many at a time, and
    the ids that end a word tell them apart; other pieces have a mark between,
    where the tokenizer keeps the mark to itself. Texts are lower-cased (A-Z) before
    they are cut, where the tokenizer would do so and no special string comes of it,
    so that fewer chunks differ.
    """

    def __init__(self, path: str, pattern: re.Pattern, ids: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per Spark task
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.pattern, self.ids, self.known, self.words = pattern, ids, {}, {}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        normal = self.tokenizer.normalizer
        self.folds = normal is not None and normal.normalize_str(string.ascii_uppercase) == string.ascii_lowercase
        alone, apart = self._ids(MARK), self._ids(f"a {MARK} b")
        self.mark = alone[0] if pattern is BARE_CHUNK and apart == self._ids("a") + alone + self._ids("b") and len(alone) == 1 else None
        self.inner = inner_chunks(normal) if ids and pattern is BARE_CHUNK else None
        self.plain, self.ends = plain_words(normal), self._word_ends()
        self.bare = Tokenizer.from_file(path) if self.inner is not None and self.ends is not None else self.tokenizer
        if self.bare is not self.tokenizer:
            self.bare.normalizer = None  # it leaves plain words as they are

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _folded(self, text: str) -> str:
        if not self.folds:
            return text
        lower = text.encode().lower().decode()
        return text if any(s in lower for s in self.special) else lower

    def _word_ends(self):
        """Whether an id is the last of a word, for every id; None if the tokenizer doesn't tell."""
        import numpy as np
        if not (suffix := getattr(self.tokenizer.model, "end_of_word_suffix", None)):
            return None
        vocab = self.tokenizer.get_vocab()
        ends = np.zeros(max(vocab.values()) + 1, bool)
        ends[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
        return ends

    def _cut(self, texts: list[str]) -> pa.ListArray:
        """What lies between white space, in every text."""
        column = pa.array(texts, pa.string())
        if self.folds:
            column = pc.ascii_lower(column)
            if self.special and holds(column, "|".join(map(re.escape, self.special))):
                column = pa.array(map(self._folded, texts), pa.string())
        if holds(column, SEPARATORS.pattern):
            return pa.array(map(self.pattern.findall, column.to_pylist()), pa.list_(pa.string()))
        return pc.utf8_split_whitespace(column) if holds(column, WIDE_SPACE) else pc.ascii_split_whitespace(column)

    def _learn(self, chunks: list[str], into: dict) -> None:
        import numpy as np
        if self.ids and self.mark is not None:
            joined = [c for c in chunks if MARK not in c]
            chunks = [c for c in chunks if MARK in c]
            for start in range(0, len(joined), JOINED_CHUNKS):
                group = joined[start:start + JOINED_CHUNKS]
                found = self.tokenizer.encode_batch_fast([f" {MARK} ".join(group) + f" {MARK}"], add_special_tokens=False)[0].ids
                found = np.array(found, "<u4")
                ends, packed = (4 * np.flatnonzero(found == self.mark)).tolist(), found.tobytes()
                if len(ends) == len(group):
                    into.update((c, packed[a:b]) for c, a, b in zip(group, [0, *(e + 4 for e in ends)], ends))
                else:
                    chunks += group
        for group in byte_batches(chunks, ENCODE_BYTES):
            done = self.tokenizer.encode_batch_fast(group, add_special_tokens=False)
            if self.ids:
                into.update(zip(group, (np.array(e.ids, "<u4").tobytes() for e in done)))
            else:
                into.update(zip(group, map(len, done)))

    def _learn_words(self, words: list[str]) -> None:
        """Words of plain letters: each is one pre-token, so its last id is the only one that ends a word."""
        import numpy as np
        if self.ends is None:
            return self._learn(words, self.words)
        for start in range(0, len(words), JOINED_CHUNKS):
            group = words[start:start + JOINED_CHUNKS]
            found = np.array(self.bare.encode_batch_fast([" ".join(group)], add_special_tokens=False)[0].ids, "<u4")
            ends, packed = (4 * np.flatnonzero(self.ends[found]) + 4).tolist(), found.tobytes()
            if len(ends) == len(group):
                self.words.update((w, packed[a:b]) for w, a, b in zip(group, [0, *ends], ends))
            else:
                self._learn(group, self.words)

    def _found(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks without white space: of a plain word and the signs behind it, or of the pieces that ``inner`` cuts."""
        if len(self.words) + len(self.known) > TABLE_ENTRIES:
            self.words, self.known = {}, {}
        stems = [c.rstrip(WORD_ENDS) for c in chunks]
        out = list(map(self.words.get, stems))
        missing = [i for i, ids in enumerate(out) if ids is None]
        new = list(filter(self.plain.fullmatch, {stems[i] for i in missing}))
        self._learn_words(new)
        cut = {}
        for i in missing:
            out[i] = self.words.get(stems[i])
            if out[i] is None:
                c, out[i], stems[i] = chunks[i], b"", chunks[i]
                cut[i] = [c] if "<" in c and any(s in c for s in self.special) else self.inner.findall(c)
        signs = [c[len(w):] for c, w in zip(chunks, stems) if len(c) > len(w)]
        pieces = set(signs).union(*cut.values()).difference(self.known)
        self._learn(list(pieces), self.known)
        get, behind = self.known.__getitem__, map(self.known.__getitem__, signs)
        out = [ids + next(behind) if len(c) > len(w) else ids for c, w, ids in zip(chunks, stems, out)]
        for i, parts in cut.items():
            out[i] = b"".join(map(get, parts))
        for table, added in ((self.words, new), (self.known, pieces)):
            for c in added:
                if len(c) > TABLE_CHUNK:
                    del table[c]
        return out

    def _joined(self, texts: list[str]) -> list[bytes]:
        """Per text its ids: every chunk is looked up once, and Arrow puts the ids together."""
        cut = self._cut(texts)
        chunks = cut.flatten().dictionary_encode()
        found = pa.array(self._found(chunks.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.binary())
        return pc.binary_join(pa.ListArray.from_arrays(cut.offsets, found.take(chunks.indices)), b"").to_pylist()

    def parts(self, texts: list[str]) -> Iterator[list]:
        """Per text the counts of its chunks, in order, or their id bytes (in one where white space cuts)."""
        if self.inner is not None:
            yield from ([packed] for packed in self._joined(texts))
            return
        cut = [self.pattern.findall(self._folded(t)) for t in texts]
        new = set().union(*cut).difference(self.known)
        if len(self.known) + len(new) > TABLE_ENTRIES:
            self.known = {}
            new = set().union(*cut)
        long = [c for c in new if len(c) > TABLE_CHUNK]
        self._learn([c for c in new if len(c) <= TABLE_CHUNK], self.known)
        self._learn(long, self.known)
        get = self.known.__getitem__
        for chunks in cut:
            yield list(map(get, chunks))
        for c in long:
            del self.known[c]


@lru_cache(maxsize=2)
def kept_table(path: str, pattern: re.Pattern, ids: bool) -> ChunkTable:
    """The table of this worker process: its next task goes on with what the last one learnt."""
    return ChunkTable(path, pattern, ids)


def inner_chunks(normalizer) -> re.Pattern:
    """Pieces of a run without white space: a word that a sign follows, or the rest.

    A letter that normalisation turns into a letter and a mark (a capital I with a
    dot, many Indic letters) does not end a piece: the mark would go with the sign.
    """
    letters = [chr(i) for i in range(0x80, sys.maxunicode + 1) if chr(i).isalpha()]
    after = normalizer.normalize_str("\n".join(letters)).replace("\n", " ").split(" ") if normalizer is not None else letters
    if len(after) != len(letters):
        after = ["." for _ in letters]
    unsafe = "".join(c for c, n in zip(letters, after) if not n or not n[-1].isalpha())
    return re.compile(rf"[^\W\d_]*[^\W\d_{re.escape(unsafe)}](?=[{re.escape(WORD_ENDS)}])|.+", re.S)


def holds(column: pa.Array, pattern: str) -> bool:
    return bool(pc.any(pc.match_substring_regex(column, pattern)).as_py())


def plain_words(normalizer) -> re.Pattern:
    """Words of a-z and those Latin letters that normalisation leaves as they are."""
    letters = [c for c in map(chr, range(0x80, 0x250)) if c.isalpha()]
    kept = [c for c in letters if normalizer is None or normalizer.normalize_str(c) == c]
    return re.compile(f"[a-z{''.join(kept)}]+")


def pieces_of(text: str, limit: int) -> Iterator[str]:
    """Cut a long text at safe boundaries into pieces of about ``limit`` characters."""
    start = 0
    while len(text) - start > limit and (cut := SAFE_CUT.search(text, start + limit)):
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def count_tokens(path: str, pattern: re.Pattern = SPACED_CHUNK) -> Column:
    """An Arrow function text -> number of tokens (NULL counts as empty)."""

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = ChunkTable(path, pattern, ids=False)
        for batch in batches:
            out = [0] * len(batch)
            rows = ((i, piece) for i, text in enumerate(batch) if text
                    for piece in pieces_of(text, GROUP_CHARS))
            for owners, texts in _groups(rows, GROUP_CHARS):
                for i, counts in zip(owners, table.parts(texts)):
                    out[i] += sum(counts)
            yield pd.Series(out, dtype="int64")

    return counted


def _groups(rows: Iterator[tuple[int, str]], limit: int) -> Iterator[tuple[list[int], list[str]]]:
    owners, texts, held = [], [], 0
    for i, text in rows:
        if texts and held + len(text) > limit:
            yield owners, texts
            owners, texts, held = [], [], 0
        owners.append(i)
        texts.append(text)
        held += len(text)
    if texts:
        yield owners, texts


def with_token_counts(docs: DataFrame, path: str, limit: int = 512, text_col: str = "text") -> DataFrame:
    """Add n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) to every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = docs.withColumns({"n_bytes": F.octet_length(text).cast("long"), "n_tokens": count_tokens(path)(text)})
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
