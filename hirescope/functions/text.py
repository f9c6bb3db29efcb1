"""Text functions H1-H3: normalise, tokenise, n-grams. All JVM-side expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters kept by the normaliser (a-z, 0-9, + # . / -);
# every other character separates tokens.
TOKEN_CLASS = r"[a-z0-9+#./\-]+"


def norm(col: Column | str) -> Column:
    """H1: lower-case; any char outside ``a-z 0-9 + # . / -`` and space -> space;
    runs of spaces -> one space; trim.

    Computed as the runs of kept characters joined by one space, which is the
    same string, in one regex pass instead of two replaces and a trim.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.array_join(F.regexp_extract_all(F.lower(c), F.lit(TOKEN_CLASS), 0), " ")


def tokens(normed: Column | str) -> Column:
    """H2: whitespace tokens of an already normalised string; '' gives []."""
    c = F.col(normed) if isinstance(normed, str) else normed
    return F.array_remove(F.split(c, " "), "")


def text_tokens(text: Column | str) -> Column:
    """H1+H2 in one regex pass: the tokens of ``norm(text)``.

    The runs of kept characters in the lower-cased text are exactly the
    whitespace tokens of the normalised text. Extracting the runs is several
    times faster than splitting on their complement.
    """
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN_CLASS), 0)


def ngrams(toks: Column | str, n: int) -> Column:
    """H3: every run of ``n`` consecutive tokens joined by one space."""
    t = F.col(toks) if isinstance(toks, str) else toks
    if n < 1:
        raise ValueError("n must be >= 1")
    if n == 1:
        return t
    return F.when(F.size(t) >= n, F.transform(
        F.sequence(F.lit(1), F.size(t) - n + 1),
        lambda i: F.array_join(F.slice(t, i, n), " "),
    )).otherwise(F.array().cast("array<string>"))


def all_ngrams(toks: Column | str, lengths: Iterable[int]) -> Column:
    """n-grams of every length in ``lengths`` in one array."""
    ls = sorted(set(int(x) for x in lengths))
    if not ls:
        return F.array().cast("array<string>")
    if len(ls) == 1:
        return ngrams(toks, ls[0])
    return F.flatten(F.array(*[ngrams(toks, n) for n in ls]))


def count_ngrams(toks: Column | str, n: int) -> tuple[Column, Column]:
    """How many n-grams, and how many distinct ones, a token array has. Distinct ones are
    told apart by a 64-bit hash of their tokens, so no n-gram is ever built as a string."""
    t = F.col(toks) if isinstance(toks, str) else toks
    places = F.size(t) - (n - 1)
    if n == 1:
        return places, F.size(F.array_distinct(t))
    marks = F.transform(F.sequence(F.lit(0), places - 1), lambda i: F.xxhash64(*[F.get(t, i + k) for k in range(n)]))
    return F.greatest(places, F.lit(0)), F.when(places > 0, F.size(F.array_distinct(marks))).otherwise(0)
