"""Colour-object attributes of a caption and the queries built from them."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.functions.lexicon import CHINESE, AttributeRule, Family, Lexicon, word_pattern
from pairloom.functions.text import (
    contains_any,
    distinct_queries,
    remove_each,
    replace_each,
    squeeze_caption,
    tidy_queries,
)

def _no_strings() -> Column:
    return F.array().cast(T.ArrayType(T.StringType()))


def _join_gaps(text: Column, lex: Lexicon) -> Column:
    return F.btrim(F.regexp_replace(text, lex.separator_runs, lex.comma), F.lit(lex.query_trim))


def drop_noise(text: Column, lex: Lexicon = CHINESE) -> Column:
    """Remove scene descriptions inside the caption."""
    return _without_noise(squeeze_caption(text, lex), lex)


def _without_noise(squeezed: Column, lex: Lexicon) -> Column:
    # an opener takes the rest of its clause along, so one pass does for all
    openers = word_pattern(lex.noise_openers) + lex.clause_rest
    bare = F.regexp_replace(squeezed, openers, "")
    return _join_gaps(replace_each(bare, ((w, "") for w in lex.noise_words)), lex)


def drop_secondary(text: Column, lex: Lexicon = CHINESE) -> Column:
    """Remove clauses about a second person; ``text`` should be a column."""
    bare = F.when(
        contains_any(text, lex.secondary_cues), remove_each(text, lex.secondary_clauses)
    ).otherwise(text)
    return _join_gaps(bare, lex)


def main_subject(text: Column, lex: Lexicon = CHINESE) -> Column:
    """First person word; where two start together the longer one."""
    words = sorted(lex.subjects, key=lambda w: (-len(w), w))
    found = F.regexp_extract(text, word_pattern(words), 0)
    result = F.when(found == "", F.lit(lex.default_subject)).otherwise(found)
    for word, alias in lex.subject_aliases:
        result = F.when(found == word, F.lit(alias)).otherwise(result)
    return result


def full_colour(colour: Column, lex: Lexicon = CHINESE) -> Column:
    """Short colour name to its long form, others unchanged."""
    table = F.create_map(*(F.lit(v) for pair in lex.short_colours for v in pair))
    return F.coalesce(F.try_element_at(table, colour), colour)


def _with_hits(df: DataFrame, lex: Lexicon) -> DataFrame:
    """Add one array of regex matches per scan: ``hits_0``, ``hits_1``, .."""
    columns = {}
    for at, rules in enumerate(lex.scans()):
        things = [thing for rule in rules for thing in rule.objects]
        pattern = F.lit(lex.pattern(rules[0].shape, things))
        hits = F.regexp_extract_all("main", pattern, F.lit(0))
        columns[f"hits_{at}"] = F.when(contains_any(F.col("main"), things), hits).otherwise(_no_strings())
    return df.withColumns(columns)


def _phrases(rule: AttributeRule, lex: Lexicon) -> Column:
    """Phrases of one rule, from the matches of its scan."""
    at, rules = next((i, scan) for i, scan in enumerate(lex.scans()) if rule in scan)
    hits, pattern = F.col(f"hits_{at}"), lex.rule_pattern(rule)
    if len(rules) > 1:
        own = lambda hit: reduce(or_, (hit.endswith(thing) for thing in rule.objects))
        hits = F.filter(hits, own)
    return F.transform(
        hits,
        lambda hit: F.concat(
            F.lit(rule.verb),
            full_colour(F.regexp_extract(hit, pattern, 1), lex),
            F.regexp_extract(hit, pattern, 2),
        ),
    )


def _raw_phrases(role: str, lex: Lexicon) -> Column:
    """All attribute phrases of one role as the rules word them."""
    found = [_phrases(rule, lex) for rule in lex.rules if rule.role == role]
    if role == lex.action_role:
        found += [
            F.when(contains_any(F.col("main"), cues), F.array(F.lit(label))).otherwise(_no_strings())
            for label, cues in lex.actions
        ]
    return F.concat(*found) if found else _no_strings()


def _family(attrs: Column, family: Family) -> Column:
    def belongs(attr: Column) -> Column:
        if family.whole:
            return attr.isin(*family.words)
        hit = contains_any(attr, family.words)
        return attr.contains(family.needs) & hit if family.needs else hit

    return F.slice(F.filter(attrs, belongs), 1, 2)


def query_combinations(
    attrs: Column, subject: Column, families: dict[str, Column], lex: Lexicon = CHINESE
) -> Column:
    """Single attributes, matching pairs, and one query of the first four."""

    def ask(what: Column) -> Column:
        return F.concat(what, F.lit(lex.particle), subject)

    def pairs(lefts: Column, rights: Column) -> Column:
        return F.flatten(
            F.transform(
                lefts,
                lambda a: F.transform(
                    F.filter(rights, lambda b: b != a), lambda b: ask(F.concat(a, b))
                ),
            )
        )

    full = F.when(
        F.size(attrs) >= 3, F.array(ask(F.array_join(F.slice(attrs, 1, 4), "")))
    ).otherwise(_no_strings())
    return F.concat(
        F.transform(attrs, ask),
        *(pairs(families[left], families[right]) for left, right in lex.family_pairs),
        full,
    )


def _with_main(df: DataFrame, text: str, lex: Lexicon) -> DataFrame:
    out = df.withColumn("raw", squeeze_caption(F.col(text), lex))
    # squeezing again is what the rules do; it can shorten a wording once more
    out = out.withColumn("__quiet", drop_noise(F.col("raw"), lex))
    out = out.withColumn("main", drop_secondary(F.col("__quiet"), lex)).drop("__quiet")
    return _with_hits(out.withColumn("subject", main_subject(F.col("main"), lex)), lex)


def with_attributes(
    df: DataFrame, *, text: str = "text", lex: Lexicon = CHINESE
) -> DataFrame:
    """Add ``raw``, ``main``, ``subject``, one array per role, and ``attrs``."""
    out = _with_main(df, text, lex)
    out = out.select(
        *df.columns,
        "raw",
        "main",
        "subject",
        *(distinct_queries(_raw_phrases(r, lex), lex).alias(f"role_{r}") for r in lex.roles),
    )
    return out.withColumn(
        "attrs", distinct_queries(F.concat(*(F.col(f"role_{r}") for r in lex.roles)), lex)
    )


def with_attrs_only(
    df: DataFrame, *, text: str = "text", lex: Lexicon = CHINESE
) -> DataFrame:
    """As ``with_attributes`` without the arrays per role, which cost most.

    Tidying twice and then dropping repeats gives what dropping them per role
    first would; only the first rider and shield phrases are wanted by role.
    """
    out = _with_main(df, text, lex)
    out = out.withColumns({f"raw_{r}": _raw_phrases(r, lex) for r in lex.roles})
    phrases = F.concat(*(F.col(f"raw_{r}") for r in lex.roles))

    def first(role: str) -> Column:
        return F.get(tidy_queries(F.col(f"raw_{role}"), lex), F.lit(0))

    return out.select(
        *df.columns,
        "raw",
        "main",
        "subject",
        distinct_queries(tidy_queries(phrases, lex), lex).alias("attrs"),
        first(lex.rider_role).alias("rider"),
        first(lex.shield_role).alias("shield"),
    )


def with_attribute_queries(
    df: DataFrame,
    *,
    text: str = "text",
    out: str = "queries",
    max_new: int = 10,
    lex: Lexicon = CHINESE,
) -> DataFrame:
    """Add the array of at most ``max_new`` derived queries."""
    steps = with_attrs_only(df, text=text, lex=lex)
    steps = steps.withColumns(
        {f"family_{f.name}": _family(F.col("attrs"), f) for f in lex.families}
    )
    families = {f.name: F.col(f"family_{f.name}") for f in lex.families}
    combos = query_combinations(F.col("attrs"), F.col("subject"), families, lex)
    steps = steps.withColumn("__combos", F.slice(distinct_queries(combos, lex), 1, max_new))

    def maybe(condition: Column, value: Column) -> Column:
        return F.when(condition, F.array(value)).otherwise(_no_strings())

    listed = F.concat(
        maybe((F.col("main") != "") & (F.col("main") != F.col("raw")), F.col("main")),
        maybe(F.length("raw") <= lex.short_caption_len, F.col("raw")),
        F.col("__combos"),
        maybe(
            F.col("rider").isNotNull() & F.col("shield").isNotNull(),
            F.concat("rider", "shield", F.lit(lex.particle), "subject"),
        ),
    )
    kept = F.filter(distinct_queries(listed, lex), lambda q: q != F.col("raw"))
    return steps.select(*df.columns, F.slice(kept, 1, max_new).alias(out))
