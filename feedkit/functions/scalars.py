"""Row-wise expressions: null handling, dates, text, derived statistics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Points per unit of each statistic.
SCORE_WEIGHTS = {"pts": 1.0, "treb": 1.2, "ast": 1.5, "blk": 3.0, "stl": 3.0, "tov": -1.0}

# Minutes in a regulation game over all players, and per overtime period.
REGULATION_MINUTES = 240
OVERTIME_MINUTES = 25

# The ASCII characters that count as white space at the ends of a text.
ASCII_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "

# Month spellings in calendar order. Accepted in lower case or capitalised.
MONTHS = [
    ("jan", "january"),
    ("feb", "february"),
    ("mar", "march"),
    ("apr", "april"),
    ("may",),
    ("jun", "june"),
    ("jul", "july"),
    ("aug", "august"),
    ("sep", "sept", "september"),
    ("oct", "october"),
    ("nov", "november"),
    ("dec", "december"),
]


def norm_nan(c: Column) -> Column:
    """NaN becomes NULL, so that one missing marker is left. For float columns."""
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def is_number(c: Column) -> Column:
    """True where a text value is written as a number; null text is not a number, nor is ``12d`` or ``nan``."""
    return c.rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$") & c.try_cast("double").isNotNull()


def same_on_error(attempt: Column, original: Column) -> Column:
    """The attempted value, or the input where the attempt gave null."""
    return F.coalesce(attempt, original)


def lacks_text(c: Column, text: str) -> Column:
    """True where ``text`` does not occur in the value (e.g. playoff = no 'Regular Season' in the label)."""
    return ~c.contains(text)


def venue_is(c: Column, value: str, ignore_case: bool = False) -> Column:
    """Equality flag; one feed spells the value in any case, the other exactly."""
    return F.lower(c) == value.lower() if ignore_case else c == value


def game_id(date: Column, own: Column, other: Column, home: Column) -> Column:
    """``yymmdd_home_away``, the same from either side's row; null when a part is missing."""
    first = F.when(home, own).when(~home, other)
    second = F.when(home, other).when(~home, own)
    # concat, unlike concat_ws, gives null as soon as one part is null.
    return F.concat(F.date_format(date, "yyMMdd"), F.lit("_"), first, F.lit("_"), second)


def overtime_periods(minutes: Column) -> Column:
    """Number of overtime periods, truncated toward zero."""
    return ((minutes - REGULATION_MINUTES) / OVERTIME_MINUTES).cast("int")


def weighted_score(columns: Mapping[str, Column], weights: Mapping[str, float] = SCORE_WEIGHTS) -> Column:
    """Sum of value times weight, added in the order of ``weights``."""
    total = F.lit(0.0)
    for name, weight in weights.items():
        total = total + columns[name] * F.lit(weight)
    return total


def parse_date(c: Column, pattern: str) -> Column:
    """Text to a zone-less timestamp; null where the text does not follow the pattern."""
    return F.try_to_timestamp(c, F.lit(pattern)).cast("timestamp_ntz")


def format_date_sql(c: Column, wrap: str = "") -> Column:
    """Timestamp as ``yyyy-MM-dd HH:mm:ss``, optionally wrapped (``#`` for one desktop database)."""
    text = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return F.concat(F.lit(wrap), text, F.lit(wrap)) if wrap else text


def month_number(c: Column) -> Column:
    """1 to 12 for a known spelling, else null. Upper-case spellings are not known."""
    pairs = []
    for number, spellings in enumerate(MONTHS, start=1):
        for word in spellings:
            for text in (word, word.capitalize()):
                pairs += [F.lit(text), F.lit(number)]
    return F.create_map(*pairs)[c]


def escape_quotes(c: Column) -> Column:
    """Each single quote doubled, for text exports read by an SQL client."""
    return F.replace(c, F.lit("'"), F.lit("''"))


def clean_html(c: Column) -> Column:
    """Text taken from HTML: entities, newline runs and space runs to one space, non-ASCII dropped, ends stripped.

    Non-ASCII characters go after the spaces are collapsed, so ``"a é b"`` keeps two spaces.
    """
    c = F.replace(c, F.lit("&nbsp;"), F.lit(" "))
    # A run of newlines and spaces, but not a single space, which would be replaced by itself at every word.
    c = F.regexp_replace(c, "\n[\n ]*| [\n ]+", " ")
    c = F.regexp_replace(c, r"[^\x00-\x7F]+", "")
    return F.btrim(c, F.lit(ASCII_SPACE))


def abbrev_initial(c: Column) -> Column:
    """First letter of an abbreviated name such as ``J. Smith``."""
    return F.substring(c, 1, 1)


def abbrev_last(c: Column) -> Column:
    """Text after the initial, its point and the space."""
    return F.substr(c, F.lit(4))
