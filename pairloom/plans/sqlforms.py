"""The text rules as SQL expressions, used to check the Spark ones."""

from __future__ import annotations

from pairloom.functions.lexicon import CHINESE as LEX

BLANK = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def replace_each(x: str, pairs) -> str:
    for old, new in pairs:
        x = f"replace({x}, {quote(old)}, {quote(new)})"
    return x


def remove_each(x: str, patterns) -> str:
    for pattern in patterns:
        x = f"regexp_replace({x}, {quote(pattern)}, '', 'g')"
    return x


def collapse(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{BLANK}+', ' ', 'g'), ' ')"


def strip(x: str) -> str:
    return rf"regexp_replace(coalesce({x}, ''), '\A{BLANK}+|{BLANK}+\z', '', 'g')"


def tidy_caption(x: str) -> str:
    return f"trim({replace_each(collapse(x), LEX.separator_merges)}, {quote(LEX.caption_trim)})"


def compress(x: str) -> str:
    return tidy_caption(replace_each(tidy_caption(x), LEX.compressions))


def has_any(x: str, words) -> str:
    return f"regexp_matches({x}, {quote('|'.join(words))})"


def drop_background(x: str) -> str:
    clauses = f"list_transform(string_split_regex({x}, {quote(LEX.clause_split)}), lambda c: {tidy_caption('c')})"
    kept = (
        f"list_filter({clauses}, lambda c: c <> '' AND (NOT {has_any('c', LEX.background_terms)}"
        f" OR {has_any('c', LEX.person_terms)}))"
    )
    return tidy_caption(f"array_to_string({kept}, {quote(LEX.comma)})")


def subject_parts(x: str) -> str:
    # no lookahead here: mark the cut first
    cues = LEX.subject_split.split("(?=", 1)[1].rstrip(")")
    marked = rf"regexp_replace({x}, '，({cues})', chr(1) || '\1', 'g')"
    cut = f"string_split_regex({marked}, '[；;。\\x01]')"
    part = f"regexp_replace({tidy_caption('p')}, {quote(LEX.subject_cues)}, '')"
    return f"list_filter(list_transform({cut}, lambda p: {compress(part)}), lambda p: p <> '')"


def squeeze(x: str) -> str:
    bare = f"regexp_replace(coalesce({x}, ''), '(?:{BLANK}|{LEX.full_stop})+', '', 'g')"
    return f"trim({replace_each(bare, LEX.wordings)}, {quote(LEX.query_trim)})"


def query_form(x: str) -> str:
    """Tidied query before the length rule."""
    q = replace_each(squeeze(x), LEX.query_wordings)
    return f"trim(regexp_replace({q}, '{LEX.comma}+', {quote(LEX.comma)}, 'g'), {quote(LEX.query_trim)})"


def query_forms(xs: str) -> str:
    return (
        f"list_filter(list_transform({xs}, lambda q: {query_form('q')}),"
        f" lambda q: length(q) >= {LEX.min_query_len})"
    )


def join_gaps(x: str) -> str:
    return f"trim(regexp_replace({x}, '{LEX.separator_runs}', {quote(LEX.comma)}, 'g'), {quote(LEX.query_trim)})"


def drop_noise(x: str) -> str:
    patterns = (*(w + LEX.clause_rest for w in LEX.noise_openers), *LEX.noise_words)
    return join_gaps(remove_each(squeeze(x), patterns))


def drop_secondary(x: str) -> str:
    return join_gaps(remove_each(x, LEX.secondary_clauses))


def distinct(xs: str) -> str:
    """First occurrences of a list column, order kept."""
    return f"list_filter({xs}, lambda x, i: list_position({xs}, x) = i)"


def subject(x: str) -> str:
    words = "|".join(sorted(LEX.subjects, key=lambda w: (-len(w), w)))
    found = f"regexp_extract({x}, '{words}', 0)"
    aliases = " ".join(f"WHEN {quote(w)} THEN {quote(a)}" for w, a in LEX.subject_aliases)
    return f"CASE {found} WHEN '' THEN {quote(LEX.default_subject)} {aliases} ELSE {found} END"


def _colour(x: str) -> str:
    whens = " ".join(f"WHEN {quote(s)} THEN {quote(f)}" for s, f in LEX.short_colours)
    return f"CASE {x} {whens} ELSE coalesce({x}, '') END"


def role_list(role: str) -> str:
    parts = []
    for rule in LEX.rules:
        if rule.role == role:
            # the plain alternation here, to check the grouped one
            colour = "|".join((*LEX.colours, *(c for c, _ in LEX.short_colours)))
            p = quote(
                f"{rule.lead}({colour}){'?' if rule.colour_optional else ''}{LEX.particle}?"
                f"{rule.filler}({'|'.join(rule.objects)})"
            )
            pairs = f"list_zip(regexp_extract_all(main, {p}, 1), regexp_extract_all(main, {p}, 2))"
            parts.append(f"list_transform({pairs}, lambda z: {quote(rule.verb)} || {_colour('z[1]')} || z[2])")
    if role == LEX.action_role:
        parts += [
            f"CASE WHEN {has_any('main', cues)} THEN [{quote(label)}] ELSE []::VARCHAR[] END"
            for label, cues in LEX.actions
        ]
    return query_forms(" || ".join(parts) if parts else "[]::VARCHAR[]")


def attributes_cte(source: str) -> str:
    """CTEs ending in ``attributed``: source plus main, subject, roles, attrs."""
    roles = LEX.roles
    return f"""
a_raw AS (SELECT *, {squeeze('text')} AS raw FROM {source}),
a_main AS (SELECT *, {drop_secondary(drop_noise('raw'))} AS main FROM a_raw),
a_roles AS (SELECT *, {subject('main')} AS subject,
  {', '.join(f'{role_list(r)} AS l_{r}' for r in roles)} FROM a_main),
a_once AS (SELECT *, {', '.join(f'{distinct("l_" + r)} AS role_{r}' for r in roles)} FROM a_roles),
a_list AS (SELECT *, {query_forms(' || '.join('role_' + r for r in roles))} AS l_attrs FROM a_once),
attributed AS (SELECT *, {distinct('l_attrs')} AS attrs FROM a_list)"""


def queries_cte(source: str, max_new: int) -> str:
    """CTEs ending in ``queried``: one list ``queries`` per row."""
    def belongs(f) -> str:
        if f.whole:
            return f"a IN ({', '.join(map(quote, f.words))})"
        return has_any("a", f.words) + (f" AND contains(a, {quote(f.needs)})" if f.needs else "")

    families = ", ".join(
        f"list_filter(attrs, lambda a: {belongs(f)})[1:2] AS f_{f.name}" for f in LEX.families
    )
    ask = lambda x: f"{x} || {quote(LEX.particle)} || subject"
    pairs = " || ".join(
        f"flatten(list_transform(f_{a}, lambda a: list_transform(list_filter(f_{b}, lambda b: b <> a),"
        f" lambda b: {ask('a || b')})))"
        for a, b in LEX.family_pairs
    )
    combos = (
        f"list_transform(attrs, lambda a: {ask('a')}) || {pairs} || "
        f"CASE WHEN len(attrs) >= 3 THEN [{ask(chr(97) + 'rray_to_string(attrs[1:4], ' + quote('') + ')')}] ELSE [] END"
    )
    rider, shield = f"role_{LEX.rider_role}", f"role_{LEX.shield_role}"
    listed = (
        f"CASE WHEN main <> '' AND main <> raw THEN [main] ELSE [] END || "
        f"CASE WHEN length(raw) <= {LEX.short_caption_len} THEN [raw] ELSE [] END || combos[1:{max_new}] || "
        f"CASE WHEN len({rider}) > 0 AND len({shield}) > 0 THEN [{ask(rider + '[1] || ' + shield + '[1]')}] ELSE [] END"
    )
    return f"""{attributes_cte(source)},
b_family AS (SELECT *, {families} FROM attributed),
b_combos AS (SELECT *, {query_forms(combos)} AS l_combos FROM b_family),
b_once AS (SELECT *, {distinct('l_combos')} AS combos FROM b_combos),
b_list AS (SELECT *, {query_forms(listed)} AS l_queries FROM b_once),
queried AS (SELECT *, list_filter({distinct('l_queries')}, lambda q: q <> raw)[1:{max_new}] AS queries FROM b_list)"""


def variants_cte(source: str, *, max_new: int, min_len: int, max_len: int, split_subjects: bool) -> str:
    """CTEs ending in ``varied``: the tidied caption and a list ``variants``."""
    found = f"[compact, {drop_background('compact')}]"
    if split_subjects:
        found += f" || {subject_parts('tidied')}"
    good = (
        f"list_filter(found, lambda v: v <> '' AND v <> tidied AND length(v) BETWEEN {min_len} AND {max_len}"
        f" AND {has_any('v', LEX.visual_terms)} AND {has_any('v', (*LEX.person_terms, *LEX.actor_terms))})"
    )
    return f"""
v_tidy AS (SELECT *, {tidy_caption('text')} AS tidied FROM {source}),
v_compact AS (SELECT *, {compress('tidied')} AS compact FROM v_tidy),
v_found AS (SELECT *, list_transform({found}, lambda v: {tidy_caption('v')}) AS found FROM v_compact),
v_good AS (SELECT *, {good} AS good FROM v_found),
varied AS (SELECT *, {distinct('good')}[1:{max_new}] AS variants FROM v_good)"""
