"""Date rules: ordered patterns, of which the first that gives a possible date wins."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: month names by language, and the number of each
FRENCH = {"janvier": 1, "février": 2, "fevrier": 2, "mars": 3, "avril": 4, "mai": 5, "juin": 6, "juillet": 7, "août": 8, "aout": 8, "septembre": 9, "octobre": 10, "novembre": 11, "décembre": 12, "decembre": 12}
DUTCH = {"januari": 1, "februari": 2, "maart": 3, "april": 4, "mei": 5, "juni": 6, "juli": 7, "augustus": 8, "augutus": 8, "september": 9, "oktober": 10, "november": 11, "december": 12}
DUTCH_SHORT = {"jan": 1, "feb": 2, "mrt": 3, "apr": 4, "mei": 5, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "okt": 10, "nov": 11, "dec": 12}
MONTHS_URL = DUTCH | DUTCH_SHORT


def month_name(month: Column, table: dict[str, int]) -> Column:
    """The usual name of a month by its number."""
    usual = {n: name for name, n in reversed(table.items())}
    return F.element_at(F.lit([usual[n] for n in range(1, 13)]), month)


@dataclass(frozen=True)
class Rule:
    """A pattern and what its groups are: Y year, y two-digit year, M month, D day, N month name, F fallback day 1."""

    pattern: str
    groups: str
    names: tuple = ()


def _named(table: dict[str, int]) -> tuple[str, tuple]:
    return "|".join(sorted(table, key=lambda x: (-len(x), x))), tuple(sorted(table.items()))


_FR, _FR_NAMES = _named(FRENCH)
_NL, _NL_NAMES = _named(DUTCH)
_URL, _URL_NAMES = _named(MONTHS_URL)

_ANY = r"([a-zéûèêô]{3,9})"

# fixed values: the patterns by what they read, in the order in which they are tried
RULES: dict[str, tuple[Rule, ...]] = {
    "cms_path": (
        Rule(r"(?<!\d)(20\d{2})(0[1-9]|1[0-2])([0-2]\d|3[01])(?!\d)", "YMD"),
        Rule(r"(?<!\d)(20\d{2})\.(\d{2})\.(\d{2})(?!\d)", "YMD"),
        Rule(r"(\d{1,2})\.(\d{1,2})\.(20\d{2})(?!\d)", "DMY"),
        Rule(r"(20\d{2})-(\d{2})-(\d{2})(?!\d)", "YMD"),
        Rule(r"-([0-2]\d|3[01])(0[1-9]|1[0-2])(20\d{2})-", "DMY"),
        Rule(r"/wp-content/uploads/(20\d{2})/(\d{2})/", "YM"),
        Rule(r"(?i)-(\d{2})-(\d{2})-(\d{2})(?:-en-pdf)?\.pdf$", "DMy"),
        Rule(r"-(\d{2})-(\d{2})-(20\d{2})(?!\d)", "DMY"),
        Rule(rf"(?iu)/seances-(20\d{{2}})/(?:.*/)?(\d{{1,2}})[a-z]*[-_]{_ANY}\.pdf$", "YDN", _FR_NAMES),
        Rule(r"/seances-(20\d{2})/", "Y"),
        Rule(rf"(?iu)[_-](\d{{1,2}})-{_ANY}-(20\d{{2}})(?=[^a-z]|$)", "DNY", _FR_NAMES),
        Rule(r"(?iu)/(\d{1,2})-([a-zéûèêô]+)-(20\d{2})/", "DNY", _FR_NAMES),
        Rule(r"(?i)[^0-9](\d{2})(0[1-9]|1[0-2])(20\d{2})\.[a-z]{2,4}$", "DMY"),
        Rule(r"(?<!\d)(\d{2})\.(\d{2})\.(\d{2})(?!\d)", "yMD"),
    ),
    "link_text": (
        Rule(r"(\d{1,2})/(\d{1,2})/(\d{4})", "DMY"),
        Rule(r"(\d{1,2})/(\d{1,2})/(\d{2})(?!\d{2})", "DMy"),
        Rule(r"(\d{1,2})\.(\d{1,2})\.(20\d{2})(?!\d)", "DMY"),
        Rule(r"(20\d{2})-(\d{2})-(\d{2})(?!\d)", "YMD"),
        Rule(rf"(?iu)(\d{{1,2}})\s+{_ANY}\.?\s+(20\d{{2}})(?!\d)", "DNY", _FR_NAMES),
    ),
    "folder_path": (
        Rule(r"/(20\d{2})-(\d{2})/", "YM"),
        Rule(r"(20\d{2})-(0[1-9]|1[0-2])-([0-2]\d|3[01])(?!\d)", "YMD"),
        Rule(r"(20\d{2})_(0[1-9]|1[0-2])_([0-2]\d|3[01])(?!\d)", "YMD"),
        Rule(r"(?<!\d)(20\d{2})(0[1-9]|1[0-2])([0-2]\d|3[01])(?!\d)", "YMD"),
    ),
    "file_stem": (
        Rule(r"[._-](\d{2})[._-](\d{2})[._-](20\d{2})(?!\d)", "DMY"),
        Rule(r"(20\d{2})[._-](\d{2})[._-](\d{2})(?!\d)", "YMD"),
        Rule(r"(\d{2})[._-](\d{2})[._-](\d{2})(?!\d)", "yMD"),
        Rule(r"^\D*(?:\d{1,7}\D+)*(\d{4})(\d{2})(\d{2})", "YMD"),
        Rule(r"^\D*(?:\d{1,7}\D+)*(\d{2})(\d{2})(\d{4})", "DMY"),
    ),
    "french_text": (Rule(rf"(?iu)(\d{{1,2}})\s+({_FR})\s+(20\d{{2}})", "DNY", _FR_NAMES),),
    "spoken_french": (Rule(rf"(?iu)(\d{{1,2}})(?:er)?\s+({_FR})\s+(\d{{4}})", "DNY", _FR_NAMES),),
    "dutch_heading": (Rule(rf"(?i)^\s*(\d{{1,2}})\s+({_NL})\s+(\d{{4}})", "DNY", _NL_NAMES), Rule(r"(\d{2})-(\d{2})-(\d{4})", "DMY")),
    "dutch_url": (Rule(r"(?:^|[^0-9])(20\d{2})(\d{2})(\d{2})(?:[^0-9]|$)", "YMD"), Rule(rf"(?i)-(\d{{1,2}})-({_URL})-(20\d{{2}})", "DNY", _URL_NAMES)),
    "dutch_title": (Rule(rf"(?i)(\d{{1,2}})\s+({_NL})\s+(\d{{4}})", "DNY", _NL_NAMES),),
    "dutch_tail": (Rule(rf"(?i)-(\d{{1,2}})-({_NL})-(\d{{4}})$", "DNY", _NL_NAMES), Rule(r"GR_(\d{4})_(\d{2})_(\d{2})", "YMD")),
    "slash": (Rule(r"(\d{1,2})/(\d{1,2})/(\d{4})", "DMY"),),
    "slash_first": (Rule(r"^(\d{1,2})/(\d{1,2})/(\d{4})", "DMY"),),
    "slash_meeting": (Rule(r"(?iu)séance du\s+(\d{1,2})/(\d{2})/(\d{4})", "DMY"),),
    "slug": (Rule(r"^(\d{2})(\d{2})(\d{4})(?:-|$)", "DMY"),),
    "iso": (Rule(r"(\d{4})-(\d{2})-(\d{2})", "YMD"),),
    "folder_label": (Rule(r"^(\d{4})-(\d{2})-(\d{2})$", "YMD"), Rule(r"(\d{4})-(\d{2})-(\d{2})\s*$", "YMD"), Rule(r"(\d{2})-(\d{2})-(\d{4})\s*$", "DMY")),
    "path_folder": (Rule(r"/(\d{4})-(\d{2})-(\d{2})/", "YMD"),),
    "french_du": (Rule(rf"(?i)du\s+(\d{{1,2}})\s+({_FR})\s+(\d{{4}})", "DNY", _FR_NAMES), Rule(rf"(?i)de\s+({_FR})\s+(\d{{4}})", "NY", _FR_NAMES)),
}


def _by_rule(text: Column, rule: Rule) -> Column:
    part = {k: F.regexp_extract(text, rule.pattern, i) for i, k in enumerate(rule.groups, 1)}
    year = part["Y"] if "Y" in part else F.concat(F.lit("20"), part["y"])
    if "N" in part:
        month = F.try_element_at(F.create_map(*(F.lit(x) for pair in rule.names for x in (pair[0], f"{pair[1]:02d}"))), F.lower(part["N"]))  # null for a word that is no month
    else:
        month = F.lpad(part["M"], 2, "0") if "M" in part else F.lit("01")
    day = F.lpad(part["D"], 2, "0") if "D" in part else F.lit("01")
    return F.try_to_date(F.concat(year, F.lit("-"), month, F.lit("-"), day), "yyyy-MM-dd")


def parsed(text: Column, rules: str) -> Column:
    """Date that the first rule with a possible one finds; null if none does, or text is null."""
    return F.coalesce(*(F.when(text.rlike(r.pattern), _by_rule(text, r)) for r in RULES[rules]))


def du_with_fallback(text: Column, year: Column) -> Column:
    """french_du, and between its rules "du D month" of the fallback year."""
    bare = Rule(rf"(?i)du\s+(\d{{1,2}})\s+({_FR})", "DN", _FR_NAMES)
    day, name = F.lpad(F.regexp_extract(text, bare.pattern, 1), 2, "0"), F.lower(F.regexp_extract(text, bare.pattern, 2))
    month = F.try_element_at(F.create_map(*(F.lit(x) for pair in _FR_NAMES for x in (pair[0], f"{pair[1]:02d}"))), name)
    guess = F.when(text.rlike(bare.pattern), F.try_to_date(F.concat_ws("-", year.cast("string"), month, day), "yyyy-MM-dd"))
    first, last = RULES["french_du"]
    return F.coalesce(F.when(text.rlike(first.pattern), _by_rule(text, first)), guess, F.when(text.rlike(last.pattern), _by_rule(text, last)))


def label(timestamp: Column, identifier: Column) -> Column:
    """YYYYMMDD of an ISO timestamp, else the first eight characters of the id."""
    return F.coalesce(F.date_format(F.try_to_timestamp(timestamp), "yyyyMMdd"), F.substr(identifier, F.lit(1), F.lit(8)))


def cutoff(as_of: Column, n: int, mode: str) -> Column:
    """Oldest date of a look-back of n months, by one of the five definitions in use.

    days31, days30: so many days a month; calendar: same day n months earlier; clamped_next, clamped: first of the
    month after, or of, that month, but not before January of the current year.
    """
    if mode in ("days31", "days30"):
        return F.date_sub(as_of, int(mode[4:]) * n)
    if mode == "calendar":
        return F.add_months(as_of, -n)
    back = n - 1 if mode == "clamped_next" else n
    return F.make_date(F.year(as_of), F.greatest(F.lit(1), F.month(as_of) - back), F.lit(1))


def since(date: Column, limit: Column, keep_unknown: bool) -> Column:
    """Whether a date is at or after the limit; unknown dates stay or go."""
    return F.coalesce(date >= limit, F.lit(keep_unknown))
