"""Text as columns: words, paragraphs, sentences, shingles, rates. All of it stays in Spark's own expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Frequent words by which a language is told.
STOP_WORDS = {
    "de": "der die das und nicht ein eine ist mit den von sich auf dem als im",
    "en": "the and of to in that was he it his with as had for on not",
    "es": "el la que los de una por las del con se su al más pero como",
    "fr": "le la les et des un une que qui dans il elle pas sur au ne",
    "pl": "się nie na jest że do jak ale po przez od za pod kiedy bo gdy",
    "pt": "não que uma os do da ao em com se para mais quando porque dos pelo",
}
ENGLISH = STOP_WORDS["en"].split()


def _array(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def ws_words(c: Column | str) -> Column:
    """What white space separates."""
    return F.filter(F.split(c, r"\s+"), lambda x: x != "")


def ascii_words(c: Column | str) -> Column:
    """Runs of a-z and 0-9 of the lower-cased text, apostrophes within words dropped."""
    return F.regexp_extract_all(F.regexp_replace(F.lower(c), "(?<=[a-z0-9])['’](?=[a-z0-9])", ""), F.lit("[a-z0-9]+"), F.lit(0))


def alpha_words(c: Column | str) -> Column:
    return F.regexp_extract_all(c, F.lit("[A-Za-z']+"), F.lit(0))


def punct_tokens(c: Column | str) -> Column:
    """Words and single signs of the lower-cased text, after Unicode."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\s]"), F.lit(0))


def paragraphs(c: Column | str, separator: str = "\n") -> Column:
    """The non-blank pieces between separators, trimmed."""
    return F.filter(F.transform(F.split(c, separator), lambda x: F.trim(x)), lambda x: F.trim(F.regexp_replace(x, r"\s", "")) != "")


def sentences(c: Column | str) -> Column:
    """Pieces that end with . ! or ?, blanks around them dropped; what stands behind the last end counts as one."""
    return F.filter(F.transform(F.regexp_extract_all(c, F.lit(r"[^.!?]+[.!?]*"), F.lit(0)), lambda x: F.trim(x)), lambda x: x != "")


def runs(words: Column, size: int, stride: int = 1) -> Column:
    """All runs of `size` words as strings, every `stride`-th; none if there are fewer words."""
    last = F.size(words) - size + 1
    starts = F.when(last >= 1, F.sequence(F.lit(1), last, F.lit(stride))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i, size), " "))


def hashed_runs(words: Column, size: int, stride: int = 1) -> Column:
    """64-bit hashes of the runs, without building their strings. `words` must be a column at hand, not an expression."""
    last = F.size(words) - size
    starts = F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(stride))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))


def stop_share(words: Column, stops: Sequence[str] = ENGLISH) -> Column:
    """Share of stop words among the words; 0 for no words."""
    known = _array(stops)
    hit = F.size(F.filter(words, lambda w: F.array_contains(known, w)))
    return F.when(F.size(words) > 0, hit / F.size(words)).otherwise(F.lit(0.0))


def hits_of(words: Column, stops: Sequence[str]) -> Column:
    """How many of the words are stop words."""
    known = _array(stops)
    return F.size(F.filter(words, lambda w: F.array_contains(known, w)))


def rate(c: Column | str, pattern: str, words: Column) -> Column:
    """Matches in a thousand words; 0 for no words."""
    return F.when(words > 0, F.regexp_count(c, F.lit(pattern)) * 1000.0 / words).otherwise(F.lit(0.0))


def distinct_share(grams: Column) -> Column:
    return F.when(F.size(grams) > 0, F.size(F.array_distinct(grams)) / F.size(grams)).otherwise(F.lit(1.0))


def squashed(c: Column | str) -> Column:
    """Newlines of one kind, inner white space one blank, none at the ends."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, "\r\n?", "\n"), r"\s+", " "))


def prefix_key(c: Column | str) -> Column:
    """The first two words, lower case, digits as 0: units of one template share it."""
    w = ws_words(F.lower(c))
    return F.regexp_replace(F.array_join(F.slice(w, 1, 2), " "), "[0-9]", "0")


def slug(c: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def title_key(c: Column | str) -> Column:
    """A title without brackets, a leading number of the show and the article, for comparison."""
    plain = F.regexp_replace(F.lower(c), r"\([^)]*\)|\[[^\]]*\]", " ")
    plain = F.regexp_replace(plain, r"^\s*(?:episode|no\.|nr\.|#)?\s*[0-9]+\s*[:.-]\s*", "")
    return F.trim(F.regexp_replace(F.regexp_replace(plain, r"^\s*(?:the|a|an)\s+", ""), r"[^\p{L}\p{N}]+", " "))


def tail_words(c: Column | str, n: int) -> Column:
    """The last n words."""
    w = ws_words(c)
    return F.array_join(F.slice(w, F.greatest(F.size(w) - n + 1, F.lit(1)), n), " ")


def hash_below(c: Column | str, share: float, digits: int = 8) -> Column:
    """A deterministic lottery: whether the first digits of the sha1 fall into this share of their range."""
    return F.substring(F.sha1(c), 1, digits) < F.lit(f"{int(share * 16**digits):0{digits}x}")


def lot(c: Column | str, share: float, digits: int = 12) -> Column:
    """The same by sha256."""
    return F.substring(F.sha2(c, 256), 1, digits) < F.lit(f"{int(share * 16**digits):0{digits}x}")
