"""Text expressions for wide meter lines and file names."""

from pyspark.sql import functions as F

from gridmill import fixed
from gridmill.functions.numbers import as_column

BLANKS = " \t\r\n\f\x0b"
# Possessive quantifiers: a cell is scanned once, without backtracking.
_DIGITS = "[0-9]++(?:_[0-9]++)*+"
NUMBER = rf"^[+-]?(?:{_DIGITS}[.]?(?:{_DIGITS})?|[.]{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"
NOT_A_NUMBER = r"^[+-]?(?i:nan|inf|infinity)$"


def stripped(text):
    return F.btrim(as_column(text), F.lit(BLANKS))


def blank_to_null(text):
    """Null for blank text; other text unchanged, outer blanks included."""
    return F.when(stripped(text) != "", as_column(text))


def starts_with_word(line, prefix):
    """Prefix test that ignores leading blanks."""
    return F.startswith(stripped(line), F.lit(prefix))


def head_and_values(line, head=fixed.META_CELLS):
    """The first cells of a line, then the uncut rest of it as last element."""
    return F.split(as_column(line), ",", head + 1)


def compact(values):
    """Comma-separated values without blank cells and without outer blanks.

    A later position in this text skips blank cells, while missing words and
    junk keep their place and only lose their value.
    """
    joined = F.regexp_replace(as_column(values), f"[{BLANKS}]*,[{BLANKS},]*", ",")
    return F.btrim(joined, F.lit(BLANKS + ","))


def count_numbers(values):
    """How many cells of a compacted text are numbers."""
    spaced = F.concat(F.lit(","), F.replace(as_column(values), F.lit(","), F.lit(",,")), F.lit(","))
    return F.regexp_count(spaced, F.lit("," + NUMBER.strip("^$") + ","))


def is_number(cell, allow_nan=False):
    """Whether a cell is a number; missing words and junk are not.

    Underscores between digits are digit separators. `nan` and `inf` count as
    missing unless `allow_nan` is set, since one of them spoils every total.
    """
    cell = as_column(cell)
    plain = cell.rlike(NUMBER)
    return plain | cell.rlike(NOT_A_NUMBER) if allow_nan else plain


def number(cell):
    """Double of a numeric cell."""
    return F.replace(as_column(cell), F.lit("_"), F.lit("")).try_cast("double")


def file_name(path):
    return F.substring_index(as_column(path), "/", -1)


def day_from_name(path):
    """Day number between the last underscore and the first dot of a file name."""
    last = F.substring_index(file_name(path), "_", -1)
    return F.coalesce(
        stripped(F.substring_index(last, ".", 1)).try_cast("int"), F.lit(fixed.DEFAULT_DAY)
    )
