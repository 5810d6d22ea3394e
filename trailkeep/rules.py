"""Rule data: fixed word lists and patterns, and builders for the ones a site supplies itself."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

# Small stopword list, negations are not in it.
STOPWORDS = (
    "a an the and or of to in on at for from by with as is are was were be been being it its "
    "this that these those"
).split()

# Fixed value: ASCII punctuation.
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Words that mark an activity of a project.
ACTION_TERMS = (
    "construction", "construct", "rehabilitation", "rehabilitate", "procurement", "purchase",
    "installation", "install", "drilling", "development", "grading", "completion", "commissioned",
    "project", "projects",
)

# Sector keywords, in order of precedence.
SECTOR_TERMS = {
    "water_sanitation": (
        "water", "borehole", "sanitation", "latrine", "toilet", "reticulation", "waste management",
    ),
    "education": (
        "school", "classroom", "education", "pupil", "student", "desk", "bursary", "skills development",
    ),
    "health": (
        "health", "clinic", "hospital", "maternity", "medical", "rural health post",
        "rural health centre", "rural health center",
    ),
    "agriculture": ("agriculture", "farmer", "farming", "livestock", "fisheries", "irrigation"),
    "infrastructure": (
        "road", "bridge", "market", "electricity", "electrification", "staff house",
        "civic centre", "civic center",
    ),
}

# Phrases of boilerplate paragraphs.
BOILERPLATE_PHRASES = (
    "issued by the council secretary", "published by", "all rights reserved", "contact information",
)

# Funding programmes as (label, abbreviation, long name).
FUNDING_PROGRAMMES = (
    ("CDF", "cdf", "constituency development fund"),
    ("LGEF", "lgef", "local government equalisation fund"),
    ("World Bank", None, "world bank"),
)

# Wording of the status categories.
STATUS_DONE = ("completed", "commissioned", "handed over", "officially opened")
STATUS_DENIED = ("not", "yet to be", "will be", "to be")
STATUS_RUNNING = ("ongoing", "underway", "in progress", "being constructed")
STATUS_PLANNED = (
    "planned", "proposed", "approved", "ground[- ]breaking", "will be constructed", "to be constructed",
)
STATUS_NEAR = r"near(?:ing)? completion|almost complete|9[0-9]\s*%\s*complete"

# Allowed categories.
STATUS_VALUES = ("planned", "ongoing", "near_completion", "completed", "unspecified")
SECTOR_VALUES = ("education", "health", "water_sanitation", "agriculture", "infrastructure", "other")
LEVEL_VALUES = ("district", "constituency", "ward")

# Suffixes of a printed amount.
AMOUNT_SUFFIXES = {"thousand": 1e3, "million": 1e6, "m": 1e6, "billion": 1e9, "bn": 1e9}

# Verbs that open the short name of a project.
NAME_VERBS = (
    "construction", "rehabilitation", "procurement", "purchase", "installation", "drilling",
    "grading", "completion", "development", "provision",
)

# URL paths that never hold a record, and words that hint at one.
EXCLUDED_PATHS = ("/category/", "/tag/", "/author/", "/feed/", "/wp-content/")
SLUG_WORDS = ("cdf", "project")

# Menu words of contact pages.
CONTACT_MENU = (
    "who we are", "about us", "contact us", "contact", "administration", "department",
    "council structure", "staff",
)

# Texts that a reader takes for a missing value.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Column lists of the tables.
PROJECT_COLUMNS = (
    "project_id", "project_name", "sector", "constituency", "funding_source", "funding_amount_zmw",
    "status", "date_reported", "description", "source_url",
)
POST_COLUMNS = ("title", "date", "body_text", "url")
CONTACT_COLUMNS = (
    "record_id", "name", "role_title", "department", "phone", "email", "office_address",
    "source_page", "source_url",
)
PROFILE_COLUMNS = (
    "record_id", "level", "name", "population", "population_year", "population_male",
    "population_female", "households", "area_km2", "province", "neighboring_districts", "notes",
    "source_url", "secondary_source_url",
)
PROFILE_COUNTS = ("population", "population_year", "population_male", "population_female", "households")
PROFILE_MEASURES = ("population", "population_male", "population_female", "households", "area_km2")


def shortest_terms(terms: Sequence[str]) -> list[str]:
    """The terms that decide an any-substring test: one that contains another term adds nothing."""
    unique = list(dict.fromkeys(terms))
    return [t for t in unique if not any(o != t and o in t for o in unique)]


def place_rules(wards: Sequence[str] = (), constituencies: Sequence[str] = (),
                ward_only: Sequence[str] = ()) -> list[tuple[str, str]]:
    """Ordered (place, pattern): wards, then names that count only with ``Ward`` behind them, then wide areas.

    ``ward_only`` is for a ward that shares its name with the town: the bare name would also match
    the name of the council.
    """
    def named(place: str, tail: str) -> tuple[str, str]:
        return place, re.escape(place) + tail

    return (
        [named(p, r"(?:\s+Ward)?") for p in wards]
        + [named(p, r"\s+Ward") for p in ward_only]
        + [named(p, r"(?:\s+Constituency)?") for p in constituencies]
    )


@dataclass(frozen=True)
class FactTemplate:
    """A sentence with captures. ``fields`` maps a column to a capture number or to a constant text.

    ``remark`` is an optional (pattern, text with ``{}``) whose capture is added to the note.
    """

    pattern: str
    fields: dict[str, int | str]
    note: str
    remark: tuple[str, str] | None = None


def census_templates(unit: str) -> list[FactTemplate]:
    """The three population sentences, in order, for the named district."""
    return [
        FactTemplate(
            r"2010 Census by the Central Statistical Office \(CSO\), " + re.escape(unit)
            + r" District had ([\d,]+) households and a population of ([\d,]+), consisting of"
            r" ([\d,]+) males and ([\d,]+) females",
            {"households": 1, "population": 2, "population_male": 3, "population_female": 4,
             "population_year": "2010"},
            "2010 Census by the Central Statistical Office (CSO)",
            (r"growth rate of ([\d.]+)%", "; annual population growth rate reported as {}%"),
        ),
        FactTemplate(
            r"rise to approximately ([\d,]+) by (\d{4})",
            {"population": 1, "population_year": 2},
            "Growth-rate projection from the 2010 Census, not an actual census count",
        ),
        FactTemplate(
            r"(\d{4}) Census of Population and Housing indicates significant growth, with the"
            r" district\W?s population increasing to ([\d,]+) residents",
            {"population_year": 1, "population": 2},
            "2022 Census of Population and Housing",
        ),
    ]


@dataclass(frozen=True)
class SiteRules:
    """What a caller supplies for one site; word lists default to the fixed ones above."""

    base_url: str
    site_name: str | None = None
    topic: tuple[str | None, str] = FUNDING_PROGRAMMES[0][1:]
    places: Sequence[tuple[str, str]] = ()
    slug_words: Sequence[str] = SLUG_WORDS
    action_terms: Sequence[str] = ACTION_TERMS
    sector_terms: dict[str, Sequence[str]] = field(default_factory=lambda: dict(SECTOR_TERMS))
    boilerplate: Sequence[str] = BOILERPLATE_PHRASES
    id_prefix: str = "REC-"
