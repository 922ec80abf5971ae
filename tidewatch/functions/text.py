"""String helpers with the trimming and splitting rules of the log formats."""

from pyspark.sql import Column, functions as F

# Every character that counts as white space in a log line.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
WORD = r"[\p{L}\p{N}_]+"


def strip(col: Column) -> Column:
    """Trim white space of every kind. Most texts have none at their ends, and that test is cheap."""
    blanks = F.lit(WHITESPACE)
    at_an_end = F.contains(blanks, F.left(col, F.lit(1))) | F.contains(blanks, F.right(col, F.lit(1)))
    return F.when(at_an_end, F.btrim(col, blanks)).otherwise(col)


def has_pieces(col: Column, separator: str, n: int) -> Column:
    """Whether the separator (a pattern) cuts the text into at least ``n`` pieces."""
    return F.size(F.split(col, separator)) >= n


def after(col: Column, marker: str) -> Column:
    """The text between the first and the second ``marker``; null without one."""
    return F.get(F.split(col, marker), F.lit(1))


def none_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit("None"))


def tokens(col: Column) -> Column:
    """Words of a trimmed text."""
    return F.split(F.translate(col, WHITESPACE, " " * len(WHITESPACE)), " +")


def first_containing(parts: Column, marker: str) -> Column:
    return F.get(F.filter(parts, lambda p: p.contains(marker)), F.lit(0))
