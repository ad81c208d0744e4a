"""Document fingerprints by I-Match with several randomised lexicons.

The lexicon holds the terms whose share of documents lies in a band: neither
so common that they say nothing nor so rare that an edit brings them in.  As a
term of the band is in at least ``LOW`` of all documents, the lexicon has at
most (mean distinct terms per document) / ``LOW`` terms at any size of the
corpus, and may be sent to every task.  A document's distinct lexicon terms,
sorted, are hashed once for each of ``SUBSETS`` random subsets of the lexicon.
Only DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import whole_row

#: Band of a term's share of documents.
LOW, HIGH = 0.005, 0.3
#: Random subsets of the lexicon, disjoint: a term's hash deals it to one of ``thin`` lots, of which the first
#: ``SUBSETS`` are used.  ``fingerprints`` deals the whole band to ``SUBSETS`` lots; with more lots, ``THIN`` where
#: nothing is said, a caller gets a smaller lexicon.
SUBSETS, THIN = 24, 64
#: Cells of the lookup table by the low bits of a term's hash.
CELLS = 4096

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms_of(text: Column) -> Column:
    """Hashes of the distinct words (white space between, A-Z lower-cased) of a text."""
    plain = F.translate(F.coalesce(text, F.lit("")), _UPPER + "\t\n\x0b\x0c\r", _LOWER + "     ")
    words = F.filter(F.split(plain, " "), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lot_of(term: Column, thin: int = THIN) -> Column:
    return F.pmod(F.xxhash64(term, F.lit(0)), F.lit(thin))


def lexicon(terms: DataFrame, column: str = "terms", low: float = LOW, high: float = HIGH,
            subsets: int = SUBSETS, thin: int = THIN) -> list[int]:
    """The terms of the used subsets in the band, counted in the distinct terms of every document."""
    n = terms.count()
    return [r.term for r in terms.select(F.explode(column).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
            .where((F.col("df") >= low * n) & (F.col("df") <= high * n) & (F.col("df") > 1) & (lot_of(F.col("term"), thin) < subsets)).select("term").collect()]


def _table(words: list[int]) -> Column:
    """The lexicon as a constant array of comma lists, found by the low bits of a term."""
    cells: list[list[str]] = [[] for _ in range(CELLS)]
    for w in sorted(words):
        cells[w % CELLS].append(str(w))
    return F.split(F.lit(";".join(",".join(c) for c in cells)), ";")


def with_fingerprint(rows: DataFrame, text_col: str, words: list[int], out: str = "fingerprint",
                     subsets: int = SUBSETS, thin: int = THIN) -> DataFrame:
    """``rows`` with the hashes of the sorted lexicon terms in each random subset, as hexadecimal text.

    Columns of ``rows`` may have any name; one named ``out`` is replaced.  Null
    and empty texts have the hash of no terms; repeated rows repeat.

    Subset k holds the terms of ``words`` in lot k of ``thin``, the number that ``lexicon`` was given.
    A subset without any of the text's terms takes the hash of all its terms instead, so that
    different texts outside the lexicon stay apart.
    """
    table = _table(words)
    names = [c for c in rows.columns if c != out]
    # columns of their own that the next step names twice, or the optimizer would move them into its lambda
    step = rows.select(whole_row(names).alias("row"), terms_of(F.col(text_col)).alias("terms"))
    step = step.withColumns({
        "known": F.array_sort(F.filter("terms", lambda t: F.find_in_set(
            t.cast("string"), F.get(table, F.pmod(t, F.lit(CELLS)).cast("int"))) > 0)),
        "every": F.xxhash64(F.array_sort("terms"), F.lit(-1))})
    numbers, none = F.sequence(F.lit(0), F.lit(subsets - 1)), F.xxhash64(F.array().cast("array<bigint>"))
    hashes = F.transform(numbers, lambda k: F.xxhash64(
        F.filter("known", lambda t: lot_of(t, thin) == k)))
    step = step.withColumn("parts", F.when(F.size("known") == 0, F.transform(numbers, lambda k: none)).otherwise(hashes))
    text = lambda value, k: F.lpad(F.hex(F.shiftrightunsigned(F.xxhash64(value, k), 32)), 8, "0")
    own = F.transform("parts", lambda v, k: text(F.when(v == none, F.col("every")).otherwise(v), k))
    none_own = F.transform(numbers, lambda k: text(F.col("every"), k))
    return step.select("row.*", F.array_join(F.when(F.size("known") == 0, none_own).otherwise(own), "").alias(out))


def likeness(a: Column, b: Column, subsets: int = SUBSETS) -> Column:
    """Share of subsets whose hashes agree, 0 to 1."""
    same = F.lit(0)
    for k in range(subsets):
        same = same + (F.substring(a, 8 * k + 1, 8) == F.substring(b, 8 * k + 1, 8)).cast("int")
    return same / F.lit(float(subsets))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``fingerprint``.

    Null texts count as empty; equal texts have equal fingerprints.  Terms outside the band do not
    count unless a subset has no other; every term of the band is in one subset.  An empty table gives an empty
    result.  A column of ``docs`` named ``fingerprint`` is replaced.
    """
    words = lexicon(docs.select(terms_of(F.col(text_col)).alias("terms")), thin=SUBSETS)
    return with_fingerprint(docs, text_col, words, thin=SUBSETS)
