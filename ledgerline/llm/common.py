"""Small helpers the operators share: word arrays, global order, text chunks."""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.sources.tables import materialize

# White space between words in the contracts: space and \t \n \v \f \r.
WORD_GAP = r"[\x20\x09-\x0D]+"

# Characters that Unicode calls White_Space (what \s means to the tokenizers).
UNICODE_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def word_array(text: Column) -> Column:
    """Words of a text in order; NULL gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only (no locale, no other letters)."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it in ``body`` as a variable.

    An expression named inside a lambda is worked out again for every element;
    a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def window_hashes(hashes: Column, size: int) -> Column:
    """One hash per run of ``size`` neighbours; ``hashes`` is a lambda variable of that length at least."""
    starts = F.sequence(F.lit(0), F.size(hashes) - size)
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(size)]))


def shingle_hashes(words: Column, size: int) -> Column:
    """64-bit hashes of all runs of ``size`` words of an array, repeats included.

    Fewer words give the whole run as one shingle; no words give no shingle.
    """
    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: (
        F.when(F.size(h) == 0, F.array().cast("array<bigint>"))
        .when(F.size(h) < size, F.array(F.xxhash64(h)))
        .otherwise(window_hashes(h, size))))


def with_global_index(rows: DataFrame, order: list[Column], name: str = "idx") -> DataFrame:
    """Number the rows 0..n-1 in a total order without bringing them to one task.

    The rows are range-partitioned and sorted (one exchange), written once so
    that the numbering is fixed, and each partition's start is a prefix sum over
    one count per partition. The order should include a tie-breaker.
    """
    placed = materialize(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id()), f"order-{name}")
    part, local = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    starts = counts.select("_part", (F.sum("_n").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_start"))
    return (placed.withColumn("_part", part).join(starts, "_part")
            .withColumn(name, F.col("_start") + local).drop("_part", "_at", "_start"))


def byte_batches(texts: Iterable[str], limit: int) -> Iterator[list[str]]:
    """Group texts into lists of at most ``limit`` bytes in UTF-8 (one text at least)."""
    group, held = [], 0
    for text in texts:
        size = len(text) if text.isascii() else len(text.encode())
        if group and held + size > limit:
            yield group
            group, held = [], 0
        group.append(text)
        held += size
    if group:
        yield group


# A chunk is a run of white space and the word after it; a cut stands only
# between a non-space and a white-space character.
SPACED_CHUNK = re.compile(f"[{UNICODE_SPACE}]*[^{UNICODE_SPACE}]+|[{UNICODE_SPACE}]+")
# What lies between white space; str.split() gives the same for texts without these four separators.
BARE_CHUNK = re.compile(f"[^{UNICODE_SPACE}]+")
SEPARATORS = re.compile("[\x1c-\x1f]")
# Signs before which a word ends if a letter stands there (pre-tokens hold either letters,
# or one number, or other signs); it must still be a letter after normalisation.
WORD_ENDS = ".,;:!?#*$%&"
SAFE_CUT = re.compile(f"(?<=[^{UNICODE_SPACE}])[{UNICODE_SPACE}]")
