"""Casting, cleaning and text splitting of raw fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch import fixed

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def try_number(x: Column | str) -> Column:
    """Whole number or NULL; fractions round half away from zero."""
    exact = F.trim(_col(x)).try_cast("decimal(38,10)")
    return F.round(exact, 0).try_cast("bigint")


def try_double(x: Column | str) -> Column:
    """Double or NULL; type suffixes such as ``12d`` are not numbers."""
    text = F.trim(_col(x))
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def try_coordinate(x: Column | str) -> Column:
    """Plain decimal degrees; hemisphere letters and ``None`` give NULL."""
    return try_double(F.nullif(F.trim(_col(x)), F.lit("None")))


def try_timestamp(x: Column | str, pattern: str = fixed.REPORT_STAMP_FORMAT) -> Column:
    return F.try_to_timestamp(_col(x), F.lit(pattern))


# ISO first, then the slashed and epoch forms a feed may carry
_STAMP_PATTERNS = [
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS][.SSSSSS][.SSS][.SS][.S][XXX][X]",
    "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS][.SSSSSS][.SSS][.SS][.S][XXX][X]",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd",
    "yyyy/MM/dd HH:mm:ss",
    "yyyy/MM/dd",
    "dd/MM/yyyy HH:mm:ss",
    "dd/MM/yyyy",
]


# with month names or a half-day mark, after _plain_words
_WORDED_PATTERNS = [
    *[f"{day} yyyy{time}" for day in ("d MMM", "MMM d") for time in (" HH:mm:ss xx", " HH:mm:ss", " HH:mm", "", " h:mm:ss a", " h:mm a")],
    "yyyy-MM-dd h:mm:ss a",
    "yyyy-MM-dd h:mm a",
    "yyyy/MM/dd h:mm:ss a",
]


def _plain_words(text: Column) -> Column:
    """Without weekday and commas; months as three letters, zone names as +0000, half-days in capitals."""
    t = F.initcap(F.regexp_replace(text, ",", " "))
    t = F.regexp_replace(t, r"^(Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]* +", "")
    t = F.regexp_replace(t, r"\b(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\.?", "$1")
    t = F.regexp_replace(t, r" (Gmt|Utc|Z)$", " +0000")
    t = F.regexp_replace(F.regexp_replace(t, r"(\d) ?[Aa]m\b", "$1 AM"), r"(\d) ?[Pp]m\b", "$1 PM")
    return F.regexp_replace(t, " +", " ")


def parse_best_effort(x: Column | str) -> Column:
    """Timestamp from the date-time spellings seen in feeds, else NULL."""
    text = F.trim(_col(x).cast("string"))
    tries = [F.try_to_timestamp(text, F.lit(p)) for p in _STAMP_PATTERNS]
    epoch = F.when(text.rlike(r"^\d{10}$"), F.timestamp_seconds(text.try_cast("bigint")))
    plain = _plain_words(text)
    worded = F.when(
        text.rlike("[A-Za-z]{2}"), F.coalesce(*[F.try_to_timestamp(plain, F.lit(p)) for p in _WORDED_PATTERNS])
    )
    return F.coalesce(*tries, epoch, worded)


# The port functions below run over dozens of columns. They take a column name
# and build one SQL expression each, which keeps plan construction short.


def _quoted(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "\\'") + "'" for w in words)


def blank_to_null(name: str) -> Column:
    return F.expr(f"nullif(trim(`{name}`), '')")


def clean_categorical(name: str) -> Column:
    """Trimmed category; the case-sensitive no-data words become NULL."""
    words = _quoted(fixed.EMPTY_CATEGORY_WORDS)
    return F.expr(f"CASE WHEN trim(`{name}`) NOT IN ({words}) THEN trim(`{name}`) END")


def zero_to_null(name: str) -> Column:
    return F.expr(f"nullif(`{name}`, 0D)")


def has_word(name: str, words: list[str]) -> Column:
    """1 where the upper-cased value is one of the words, else 0 (NULL too)."""
    return F.expr(f"CASE WHEN upper(`{name}`) IN ({_quoted(words)}) THEN 1 ELSE 0 END")


def clean_status(x: Column | str) -> Column:
    text = F.trim(_col(x))
    return F.when(~text.isin(fixed.EMPTY_STATUS_WORDS), text)


def name_key(x: Column | str) -> Column:
    """Key under which port names are compared."""
    return F.upper(F.trim(_col(x)))


# --- page text ---------------------------------------------------------------


def strip(x: Column | str) -> Column:
    """Without surrounding white space of any kind (``trim`` removes blanks only)."""
    return F.trim(_col(x), F.lit(" \t\r\n"))


def stripped_or_null(x: Column | str) -> Column:
    return F.nullif(strip(x), F.lit(""))


def _size_parts(x: Column | str) -> Column:
    return F.split(F.regexp_replace(_col(x), "m", ""), "/")


def parse_size(x: Column | str) -> tuple[Column, Column]:
    """``229 / 32 m`` as (length, beam) text; both NULL unless exactly two parts."""
    parts = _size_parts(x)
    pair = F.size(parts) == 2
    return tuple(F.when(pair, stripped_or_null(F.get(parts, F.lit(i)))) for i in (0, 1))


def split_name_country(x: Column | str) -> tuple[Column, Column]:
    """``Port, Country`` as two trimmed texts; a missing country is NULL."""
    parts = F.split(_col(x), ",")
    return stripped_or_null(F.get(parts, F.lit(0))), strip(F.get(parts, F.lit(1)))


def parse_coord_sentence(x: Column | str) -> tuple[Column, Column]:
    """Coordinates at the end of a sentence such as ``... at 49.29N, 123.11W.``

    First line only; the latitude is the last word before the first comma, the
    longitude follows the last comma. No comma gives NULL for both.
    """
    line = F.get(F.split(strip(x), "\n"), F.lit(0))
    parts = F.split(line, ",")
    found = F.size(parts) >= 2
    lat = F.element_at(F.split(strip(F.get(parts, F.lit(0))), r"\s+"), -1)
    lon = F.regexp_replace(strip(F.element_at(parts, -1)), r"\.+$", "")
    return F.when(found, lat), F.when(found, lon)


def nav_status(x: Column | str) -> Column:
    """The line that follows ``Navigation Status``."""
    text = _col(x)
    pattern = r"Navigation Status\n([^\n]*)\n"
    return F.when(text.rlike(pattern), strip(F.regexp_extract(text, pattern, 1)))
