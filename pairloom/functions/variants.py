"""Rule-based shorter variants of a caption."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.lexicon import CHINESE, Lexicon
from pairloom.functions.text import contains_any, replace_each, tidy_caption


def compress_caption(text: Column, lex: Lexicon = CHINESE) -> Column:
    return tidy_caption(replace_each(tidy_caption(text, lex), lex.compressions), lex)


def drop_background(text: Column, lex: Lexicon = CHINESE) -> Column:
    """Drop clauses about the scene that mention nobody."""
    clauses = F.transform(F.split(text, lex.clause_split), lambda c: tidy_caption(c, lex))
    kept = F.filter(
        clauses,
        lambda c: (c != "")
        & (~contains_any(c, lex.background_terms) | contains_any(c, lex.person_terms)),
    )
    return tidy_caption(F.array_join(kept, lex.comma), lex)


def subject_parts(text: Column, lex: Lexicon = CHINESE) -> Column:
    """One compressed part per described subject."""
    parts = F.transform(
        F.split(text, lex.subject_split),
        lambda p: compress_caption(F.regexp_replace(tidy_caption(p, lex), lex.subject_cues, ""), lex),
    )
    return F.filter(parts, lambda p: p != "")


def shows_something(text: Column, lex: Lexicon = CHINESE) -> Column:
    """A visual term together with a person or vehicle term."""
    return contains_any(text, lex.visual_terms) & contains_any(
        text, (*lex.person_terms, *lex.actor_terms)
    )


def with_variants(
    df: DataFrame,
    *,
    text: str = "text",
    out: str = "variants",
    original: str = "tidied",
    min_len: int = 8,
    max_len: int = 55,
    max_new: int = 2,
    split_subjects: bool = False,
    lex: Lexicon = CHINESE,
) -> DataFrame:
    """Add the tidied caption and the array of at most ``max_new`` variants.

    The steps are separate projections on purpose: each is used several times
    further on and must not be inlined.
    """
    steps = df.withColumn(original, tidy_caption(F.col(text), lex))
    steps = steps.withColumn("__compact", compress_caption(F.col(original), lex))
    found = F.array("__compact", drop_background(F.col("__compact"), lex))
    if split_subjects:
        found = F.concat(found, subject_parts(F.col(original), lex))
    steps = steps.withColumn("__found", F.transform(found, lambda v: tidy_caption(v, lex)))
    good = F.filter(
        "__found",
        lambda v: (v != "")
        & (v != F.col(original))
        & F.length(v).between(min_len, max_len)
        & shows_something(v, lex),
    )
    return steps.withColumn(out, F.slice(F.array_distinct(good), 1, max_new)).drop(
        "__compact", "__found"
    )
