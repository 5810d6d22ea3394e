"""Ordered keyword and pattern rules. The order of the rules is their meaning."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from trailkeep.functions.extract import query_id, url_path
from trailkeep.functions.text import SPACE, WORD_END, WORD_START, let
from trailkeep.rules import (
    ACTION_TERMS, BOILERPLATE_PHRASES, EXCLUDED_PATHS, FUNDING_PROGRAMMES, SECTOR_TERMS, SLUG_WORDS,
    STATUS_DENIED, STATUS_DONE, STATUS_NEAR, STATUS_PLANNED, STATUS_RUNNING, shortest_terms,
)


def mentions_any(text: Column, terms: Iterable[str], word: bool = False) -> Column:
    """Whether a lower-case text holds any term, as a substring or (``word``) as whole words."""
    terms = list(terms)
    if word:
        return text.rlike(_phrase(map(re.escape, terms)))
    return reduce(Column.__or__, (F.contains(text, F.lit(t)) for t in shortest_terms(terms)))


def _phrase(alternatives: Iterable[str]) -> str:
    """Any of the patterns as whole words."""
    alternatives = list(alternatives)
    first = {a[0] for a in alternatives}
    # The first letters are looked at before the more expensive word boundary.
    lead = f"(?=[{''.join(sorted(first))}])" if all(c.isalnum() for c in first) else ""
    return f"{lead}{WORD_START}(?:{'|'.join(alternatives)}){WORD_END}"


def _first_of(rules: Iterable[tuple[Column, str]], default: str | None) -> Column:
    rules = list(rules)
    head, label = rules[0]
    chain = F.when(head, F.lit(label))
    for condition, label in rules[1:]:
        chain = chain.when(condition, F.lit(label))
    return chain if default is None else chain.otherwise(F.lit(default))


def classify_keywords(text: Column, rules: Mapping[str, Sequence[str]] = SECTOR_TERMS,
                      default: str | None = "other", word: bool = False) -> Column:
    """First category, in declared order, with any of its keywords in the text."""
    return let(F.lower(text), lambda lower: _first_of(
        ((mentions_any(lower, terms, word), name) for name, terms in rules.items()), default
    ))


def classify_regex(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """First label whose whole-word pattern matches in any case; null if none does."""
    if not rules:
        return F.lit(None).cast("string")
    return _first_of(((text.rlike("(?iu)" + _phrase([p])), label) for label, p in rules), None)


def _names_programme(lower: Column, short: str | None, long_name: str) -> Column:
    """Whether a lower-case text names a programme; the word test runs only where the letters occur."""
    named = F.contains(lower, F.lit(long_name))
    return named if short is None else named | (F.contains(lower, F.lit(short)) & lower.rlike(_phrase([re.escape(short)])))


def classify_funding(text: Column) -> Column:
    """The funding programme a text states; null if none."""
    return let(F.lower(text), lambda lower: _first_of(
        ((_names_programme(lower, short, name), label) for label, short, name in FUNDING_PROGRAMMES), None
    ))


def infer_status(text: Column) -> Column:
    """Status category of a text. A denied or future completion leaves it unstated (null)."""
    denied = f"{WORD_START}(?:{'|'.join(STATUS_DENIED)}){SPACE}+(?:{'|'.join(STATUS_DONE)}){WORD_END}"

    def status(lower: Column) -> Column:
        return (
            F.when(mentions_any(lower, STATUS_DONE) & lower.rlike(denied), F.lit(None).cast("string"))
            .when(mentions_any(lower, STATUS_DONE) & lower.rlike(_phrase(STATUS_DONE)), "completed")
            .when(lower.rlike(STATUS_NEAR), "near_completion")
            .when(mentions_any(lower, STATUS_RUNNING) & lower.rlike(_phrase(STATUS_RUNNING)), "ongoing")
            .when(lower.rlike(_phrase(STATUS_PLANNED)), "planned")
        )

    return let(F.lower(text), status)


def is_relevant(title: Column, body: Column, topic: tuple[str | None, str] = FUNDING_PROGRAMMES[0][1:],
                actions: Sequence[str] = ACTION_TERMS) -> Column:
    """Whether a page names the topic (short name as a word, or long name) and any action."""
    return let(F.lower(F.concat_ws(" ", title, body)),
               lambda lower: _names_programme(lower, *topic) & mentions_any(lower, actions))


def is_record_unit(paragraph: Column, actions: Sequence[str] = ACTION_TERMS,
                   subjects: Mapping[str, Sequence[str]] = SECTOR_TERMS,
                   boilerplate: Sequence[str] = BOILERPLATE_PHRASES) -> Column:
    """Whether a paragraph reports an action on a subject and is no boilerplate."""
    terms = [t for group in subjects.values() for t in group]
    return let(F.lower(paragraph), lambda lower: (
        mentions_any(lower, actions) & mentions_any(lower, terms) & ~mentions_any(lower, boilerplate)
    ))


def looks_like_record_url(url: Column, slug_words: Sequence[str] = SLUG_WORDS) -> Column:
    """A post id, a year folder or a slug word, outside listing and upload folders."""
    path = F.lower(url_path(url))
    hinted = query_id(url).isNotNull() | path.rlike("/20[0-9]{2}/")
    if slug_words:
        hinted = hinted | mentions_any(F.lower(url), slug_words)
    return ~mentions_any(path, EXCLUDED_PATHS) & hinted
