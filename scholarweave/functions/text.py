"""Text, number, name and identifier expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from scholarweave import vocabulary as V

ColumnOrName = Column | str

# Every code point that counts as white space in Unicode, not just the space.
WHITESPACE = (
    " \t\n\r\u000b\u000c\u001c\u001d\u001e\u001f\u0085      "
    "           　"
)
_SPACES = r"[\s\u001c-\u001f\u0085\p{Z}]+"
# Printable ASCII, whose only white space is the space.
_PLAIN = r"\A[ -~]*\z"
# Java would also read "12d" or "0x1p3" as a double; those are not numbers here.
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: ColumnOrName) -> Column:
    """Trim white space of every kind from both ends."""
    return F.btrim(col(c), F.lit(WHITESPACE))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed a single time.

    Spark computes an operand again for every branch it stands in, as in
    ``nullif``; that is dear where it is a regular expression over a long text.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def blank_to_null(c: ColumnOrName) -> Column:
    """The engine's single spelling of a missing text: null."""
    return F.nullif(strip(c), F.lit(""))


def norm_doi(c: ColumnOrName) -> Column:
    return F.lower(blank_to_null(c))


def norm_words(c: ColumnOrName) -> Column:
    """Lower case with runs of white space folded: the key for comparing titles."""
    folded = F.trim(once(col(c), fold_spaces))
    return once(F.lower(folded), lambda t: F.nullif(t, F.lit("")))


def fold_spaces(t: Column) -> Column:
    """A space for each run of white space; the search for every kind is for other texts than plain ones only."""
    spaces = F.when(F.contains(t, F.lit("  ")), F.regexp_replace(t, " {2,}", " ")).otherwise(t)
    return F.when(t.rlike(_PLAIN), spaces).otherwise(F.regexp_replace(t, _SPACES, " "))


def first_author(c: ColumnOrName) -> Column:
    """First word of the first listed author; null when there is none."""
    head = F.substring_index(F.substring_index(col(c), ";", 1), ",", 1)
    return first_token(head)


def tokens(c: ColumnOrName) -> Column:
    return F.split(strip(c), _SPACES)


def first_token(c: ColumnOrName) -> Column:
    return F.nullif(F.try_element_at(tokens(c), F.lit(1)), F.lit(""))


def last_token(c: ColumnOrName) -> Column:
    return F.nullif(F.try_element_at(tokens(c), F.lit(-1)), F.lit(""))


def encode_doi(c: ColumnOrName) -> Column:
    """Percent-encode; Spark form-encodes, so three characters are put right."""
    encoded = F.replace(F.url_encode(col(c)), F.lit("+"), F.lit("%20"))
    encoded = F.replace(encoded, F.lit("%7E"), F.lit("~"))
    return F.replace(encoded, F.lit("*"), F.lit("%2A"))


def last_path_segment(c: ColumnOrName) -> Column:
    return F.substring_index(col(c), "/", -1)


def to_number(c: ColumnOrName) -> Column:
    """Double where the text is a plain finite number, else null."""
    text = strip(col(c).cast("string"))
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def clean_year(c: ColumnOrName) -> Column:
    """Digits of a non-negative whole year as text; null for anything else."""
    number = to_number(c)
    return F.when(number > -1, number.try_cast("bigint").cast("string"))


def year_number(c: ColumnOrName) -> Column:
    return to_number(c).try_cast("int")


def year_column(df: DataFrame, name: str) -> Column:
    """Year of a text column, or of a numeric one without going through text."""
    if isinstance(df.schema[name].dataType, T.NumericType):
        return F.col(name).try_cast("int")
    return year_number(name)


def keywords(c: ColumnOrName) -> Column:
    """Comma-separated list as an array of distinct non-blank words."""
    parts = F.transform(F.split(col(c), ","), strip)
    return F.array_distinct(F.filter(parts, lambda p: p != ""))


def first_nonempty(*candidates: ColumnOrName) -> Column:
    return F.coalesce(*[blank_to_null(c) for c in candidates])


def fill_if_null(current: ColumnOrName, candidate: ColumnOrName) -> Column:
    return F.coalesce(col(current), col(candidate))


def override(current: ColumnOrName, candidate: ColumnOrName) -> Column:
    """The candidate where it is present, otherwise the current value."""
    return F.coalesce(F.nullif(col(candidate), F.lit("")), col(current))


def date_year(c: ColumnOrName) -> Column:
    return F.nullif(F.try_element_at(F.split(col(c), "-"), F.lit(1)), F.lit(""))


def date_month(c: ColumnOrName) -> Column:
    return F.nullif(F.try_element_at(F.split(col(c), "-"), F.lit(2)), F.lit(""))


def project_title(c: ColumnOrName) -> Column:
    """Leading words of an output title up to the first methodological word.

    Falls back to the first 100 characters when no word run is found.
    """
    text = col(c)
    return once(
        F.regexp_extract(text, V.PROJECT_TITLE, 1),
        lambda words: F.when(words != "", strip(words)).otherwise(F.substring(text, 1, 100)),
    )


def project_title_or_default(c: ColumnOrName) -> Column:
    text = col(c)
    tagged = F.contains(F.lower(text), F.lit(V.PROGRAMME_TAG))
    return F.when(tagged, text).otherwise(F.lit(V.DEFAULT_PROJECT_TITLE))


def short_label(title: ColumnOrName, year: ColumnOrName) -> Column:
    return F.concat(
        F.substring(col(title), 1, 20), F.lit("...\n"), col(year).cast("string")
    )
