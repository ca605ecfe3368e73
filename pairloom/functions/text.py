"""String normalisation as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.lexicon import CHINESE, Lexicon, word_pattern

# Java's \s knows ASCII blanks only; this class is what Python's str.split()
# treats as white space, U+3000 included.
_BLANKS = r"\s\x1c-\x1f\x85\p{Z}"
BLANK = f"[{_BLANKS}]"


def replace_each(text: Column, pairs: Iterable[tuple[str, str]]) -> Column:
    """Literal replacements, one after the other."""
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs, text)


def remove_each(text: Column, patterns: Iterable[str]) -> Column:
    """Regex removals, one after the other."""
    return reduce(lambda t, p: F.regexp_replace(t, p, ""), patterns, text)


def contains_any(text: Column, words: Iterable[str]) -> Column:
    """Plain substring tests: they work on the bytes, a regex on a copy."""
    return reduce(or_, (text.contains(w) for w in words))


def or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def strip(text: Column) -> Column:
    """Remove white space at both ends."""
    return F.regexp_replace(text, rf"\A{BLANK}+|{BLANK}+\z", "")


def collapse_blanks(text: Column) -> Column:
    """NULL to '', runs of white space to one blank, trimmed."""
    return F.trim(F.regexp_replace(or_empty(text), BLANK + "+", " "))


def tidy_caption(text: Column, lex: Lexicon = CHINESE) -> Column:
    """Collapse blanks, merge doubled separators, trim punctuation."""
    return F.btrim(
        replace_each(collapse_blanks(text), lex.separator_merges),
        F.lit(lex.caption_trim),
    )


def squeeze_caption(text: Column, lex: Lexicon = CHINESE) -> Column:
    """Delete all white space and full stops, shorten wordings, trim."""
    bare = F.regexp_replace(or_empty(text), f"[{_BLANKS}{lex.full_stop}]+", "")
    return F.btrim(replace_each(bare, lex.wordings), F.lit(lex.query_trim))


def tidy_query(text: Column, lex: Lexicon = CHINESE) -> Column:
    """Search-query form of a caption; '' when it ends up too short."""
    q = _tidied(squeeze_caption(text, lex), lex)
    return F.when(F.length(q) < lex.min_query_len, F.lit("")).otherwise(q)


def _tidied(text: Column, lex: Lexicon) -> Column:
    """Wordings, comma runs and ends of text without white space.

    Queries derived from a squeezed caption hold none, so the costly scan for
    it can go.  Trimming once at the end is enough because no wording touches a
    trimmed character.
    """
    q = replace_each(text, (*lex.wordings, *lex.query_wordings))
    return F.btrim(F.regexp_replace(q, f"{lex.comma}{{2,}}", lex.comma), F.lit(lex.query_trim))


def tidy_queries(items: Column, lex: Lexicon = CHINESE) -> Column:
    """Tidy every squeezed element, drop the ones that end up too short.

    Most derived queries are tidy: one pattern test spares them the wordings.
    The length rule is a filter of its own, because inside the lambda it would
    compute each element twice.
    """
    words = [old for old, _ in (*lex.wordings, *lex.query_wordings)]
    untidy = word_pattern((*words, lex.comma * 2))
    tidied = F.transform(
        items,
        lambda q: F.when(q.rlike(untidy), _tidied(q, lex)).otherwise(F.btrim(q, F.lit(lex.query_trim))),
    )
    return F.filter(tidied, lambda q: F.length(q) >= lex.min_query_len)


def distinct_queries(items: Column, lex: Lexicon = CHINESE) -> Column:
    """Tidy queries, first occurrences only."""
    return F.array_distinct(tidy_queries(items, lex))


def once_per_text(df: DataFrame, work: Callable[[DataFrame], DataFrame], text: str = "text") -> DataFrame:
    """``df`` with the columns that ``work`` adds to a frame of its ``text``, which sees each different one once.

    Captions repeat, and the rules cost far more than moving a caption.
    """
    done = work(df.select(text).distinct())
    done = done.withColumnRenamed(text, "__once")
    return df.join(done, F.col(text).eqNullSafe(F.col("__once"))).drop("__once")
