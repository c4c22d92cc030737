"""Row predicates: topic relatedness, validity and presence."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
import re

from pyspark.sql import Column, functions as F

from scholarweave import vocabulary as V
from scholarweave.functions.text import ColumnOrName, blank_to_null, col, strip, to_number, tokens


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def contains_any(
    c: ColumnOrName, words: Sequence[str], whole_word: bool = False
) -> Column:
    """Does the text hold one of ``words``, ignoring case? Null counts as no.

    Words match inside longer words too ("ces" in "resources") unless
    ``whole_word`` is set. The one-element array lower-cases each text once
    for all words; a plain OR chain would do it once per word.
    """
    text = col(c)
    if whole_word:
        pattern = r"(?i)(?<![\p{L}\p{N}_])(" + "|".join(map(re.escape, words)) + r")(?![\p{L}\p{N}_])"
        hit = text.rlike(pattern)
    else:
        groups = by_shared_part([w.lower() for w in words])
        hit = F.exists(
            F.array(F.lower(text)),
            lambda t: any_of([_has_part(t, part, group) for part, group in groups]),
        )
    return F.coalesce(hit, F.lit(False))


def by_shared_part(words: Sequence[str]) -> list[tuple[str, list[str]]]:
    """Words grouped by a part, between spaces, that several of them hold; others stand alone.

    A text without the part has none of its words, so it is searched once for all of them.
    """
    left, groups = list(dict.fromkeys(words)), []
    while left:
        holders = {part: [w for w in left if part in w] for w in left for part in w.split()}
        part = max(holders, key=lambda p: (len(holders[p]), len(p)), default="")
        if len(holders.get(part, [])) < 2:
            return groups + [(w, [w]) for w in left]
        groups.append((part, holders[part]))
        left = [w for w in left if part not in w]
    return groups


def _has_part(text: Column, part: str, words: Sequence[str]) -> Column:
    has = F.contains(text, F.lit(part))
    return has if part in words else has & any_of([F.contains(text, F.lit(w)) for w in words])


def is_related(c: ColumnOrName, whole_word: bool = False) -> Column:
    """Short-list relatedness of one text."""
    return contains_any(c, V.RELATED_KEYWORDS, whole_word)


def is_related_article(title: ColumnOrName, abstract: ColumnOrName) -> Column:
    return is_related(title) | is_related(abstract)


def work_text(work: Column) -> Column:
    """All searchable text of a work; missing fields are skipped."""
    words = F.filter(work["keywords"], lambda k: k != "")
    names = F.transform(work["institutions"], lambda i: i["name"])
    fields = [
        work["title"], work["abstract"], work["fullText"],
        F.array_join(words, " "), F.array_join(names, " "),
    ]
    return F.concat_ws(" ", *[F.nullif(f, F.lit("")) for f in fields])


def is_related_work(work: Column, whole_word: bool = False) -> Column:
    """Long-list relatedness over title, abstract, full text, keywords and institutions."""
    return contains_any(work_text(work), V.RELATED_KEYWORDS_LONG, whole_word)


def is_related_record(columns: Sequence[ColumnOrName]) -> Column:
    """Long-list relatedness over separate columns; the first hit decides."""
    return any_of([contains_any(c, V.RELATED_KEYWORDS_LONG) for c in columns])


def is_present(c: ColumnOrName) -> Column:
    """Neither null nor blank."""
    return F.coalesce(strip(col(c).cast("string")) != "", F.lit(False))


def any_missing(columns: Sequence[ColumnOrName]) -> Column:
    return any_of([col(c).isNull() for c in columns])


def needs_enrichment(columns: Sequence[ColumnOrName], keys: Sequence[ColumnOrName]) -> Column:
    """Some field is missing and every key needed to look it up is there."""
    return any_missing(columns) & all_of([is_present(k) for k in keys])


def already_enriched(columns: Sequence[ColumnOrName]) -> Column:
    return all_of([col(c).isNotNull() for c in columns])


def has_id_prefix(c: ColumnOrName, prefix: str = V.WORK_ID_PREFIX) -> Column:
    return F.coalesce(F.startswith(col(c), F.lit(prefix)), F.lit(False))


def is_known_pi(c: ColumnOrName) -> Column:
    """A name that is neither blank nor the default."""
    name = F.lower(blank_to_null(c))
    return F.coalesce(name != V.UNKNOWN_PI.lower(), F.lit(False))


def is_valid_pi(c: ColumnOrName) -> Column:
    """A known name of at least two words."""
    return is_known_pi(c) & (F.size(tokens(c)) >= 2)


def has_doi(external_ids: Column, doi: ColumnOrName) -> Column:
    """Is ``doi`` among the external ids, ignoring case?"""
    wanted = F.lower(col(doi))
    hit = F.exists(
        external_ids,
        lambda e: (F.lower(e["external-id-type"]) == "doi")
        & (F.lower(e["external-id-value"]) == wanted),
    )
    return F.coalesce(hit, F.lit(False))


