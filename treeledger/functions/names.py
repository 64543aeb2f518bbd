"""Name rules as column expressions.  All are built-in functions, so they stay inside whole-stage code.

Letters and digits are ASCII in every pattern.  Character classes are written out instead of using case-insensitive
flags, and the end of text is ``\\n?\\z`` (a final newline may follow), so that Spark and any other RE2 or Java engine
agree on every input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points of the characters that count as white space at the ends of a cell.
_SPACES = [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029]
_SPACES += [0x202F, 0x205F, 0x3000]
WHITESPACE = "".join(map(chr, _SPACES))
# The same characters as a regular-expression class.
SPACE_CLASS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

# The name patterns.
FOLDER_CODE = rf"^{SPACE_CLASS}*([A-Za-z][0-9]+[A-Za-z]?){SPACE_CLASS}*(?:-|\z)"
STRICT_FOLDER = rf"^([A-Z][0-9]+[a-z]){SPACE_CLASS}*-{SPACE_CLASS}*[^\n]+\z"
BLOCK_IN_FILE = r"-[Bb][Ll]([0-9]+)-"
PLOT_IN_FILE = r"-([A-Za-z][0-9]+[A-Za-z]?)-[Bb][Ll]"
BLOCK_PREFIX = r"^[Bb][Oo]?[0-9]+-([^\n]+)\n?\z"
PLOT_NAME = r"^[A-Z]-[0-9]+[a-z]\n?\z"
BLOCK_NAME = r"^[Bb][Ll][0-9]+\n?\z"
TABLE_NAME = r"^[Rr][0-9]+-[SsTt][0-9]+\n?\z"
INVERTER_NAME = r"^[Ii][0-9]+\n?\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove white space of any kind from both ends (plain ``trim`` removes spaces only)."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def clean_cell(c: Column | str) -> Column:
    """Stripped text of a cell; blank and missing cells give null."""
    return F.nullif(strip(_col(c).cast("string")), F.lit(""))


def _capture(text: Column, pattern: str) -> Column:
    """The first group of the first match, or null.

    Unlike a test followed by an extraction, this refers to ``text`` once, so the optimizer can push it around without
    evaluating a computed ``text`` several times.
    """
    return F.get(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(0))


def _plot_name(code: Column) -> Column:
    """``a16A`` gives ``A-16a``."""
    return F.overlay(F.initcap(code), F.lit("-"), 2, 0)


def plot_from_folder(folder: Column | str) -> Column:
    """``A16a - 50 MW`` gives ``A-16a``: the text before the first dash, any case, suffix optional."""
    return _plot_name(_capture(_col(folder), FOLDER_CODE))


def plot_from_folder_strict(folder: Column | str) -> Column:
    """As :func:`plot_from_folder`, but case-sensitive and with the suffix, the dash and a tail required."""
    return _plot_name(_capture(strip(folder), STRICT_FOLDER))


def block_from_file(file_name: Column | str) -> Column:
    """The first ``-BL<digits>-`` of a file name as ``BL<digits>``; leading zeros are kept."""
    return F.concat(F.lit("BL"), _capture(_col(file_name), BLOCK_IN_FILE))


def plot_from_file(file_name: Column | str) -> Column:
    """The plot code right before ``-BL``; a space in place of the first dash gives null."""
    return _plot_name(_capture(_col(file_name), PLOT_IN_FILE))


def path_parts(path: Column | str) -> tuple[Column, Column]:
    """Folder and file name of a path with slashes of either kind."""
    clean = F.rtrim(F.regexp_replace(_col(path), r"[\\/]+", "/"), F.lit("/"))
    folder = F.when(clean.contains("/"), F.substring_index(F.substring_index(clean, "/", -2), "/", 1))
    return F.coalesce(folder, F.lit("")), F.substring_index(clean, "/", -1)


def strip_block_prefix(name: Column | str) -> Column:
    """``B01-R42-S01`` and ``BO4-R42-S01`` give ``R42-S01``; other values are unchanged."""
    return F.regexp_replace(_col(name), BLOCK_PREFIX, "$1")


def leaf_name(cell: Column | str) -> Column:
    """Cleaned cell without its block prefix."""
    return strip_block_prefix(clean_cell(cell))


def classify(name: Column | str, strict: bool = False) -> Column:
    """INVERTER or TABLE by pattern; an unclear name is a TABLE, or null when ``strict``."""
    c = _col(name)
    kind = F.when(c.rlike(INVERTER_NAME), F.lit("INVERTER")).when(c.rlike(TABLE_NAME), F.lit("TABLE"))
    return kind if strict else kind.when(c.isNotNull(), F.lit("TABLE"))


def is_plot(name: Column | str) -> Column:
    return _col(name).rlike(PLOT_NAME)


def is_block(name: Column | str) -> Column:
    return _col(name).rlike(BLOCK_NAME)


def is_table(name: Column | str) -> Column:
    return _col(name).rlike(TABLE_NAME)


def is_inverter(name: Column | str) -> Column:
    return _col(name).rlike(INVERTER_NAME)


def same_plot(a: Column | str, b: Column | str) -> Column:
    """Whether two plot names agree, ignoring case; a missing name never agrees."""
    return F.coalesce(F.upper(_col(a)) == F.upper(_col(b)), F.lit(False))


def shorten(c: Column | str, width: int = 30) -> Column:
    """Cut a long value for display and mark the cut."""
    text = _col(c)
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width - 3), F.lit("..."))).otherwise(text)


def label(name: Column | str, identifier: Column | str) -> Column:
    """A display name, or the first eight characters of the identifier."""
    return F.coalesce(_col(name), F.concat(F.substring(_col(identifier), 1, 8), F.lit("...")))
