"""Text rules as Column -> Column functions.

There are two word counts and two kinds of blank on purpose: records are
measured by Unicode white space when they are taken in, and compared by plain
spaces afterwards.
"""

from pyspark.sql import functions as F

from verbalance import fixed


def clean(text):
    """Drop spaces at both ends, then turn each white-space run into one space.

    Only U+0020 is dropped at the ends, so a newline there leaves one space.
    """
    return F.regexp_replace(F.trim(text), fixed.SPACE_RUN, " ")


def normalize(text):
    """Lower case without punctuation. Inner double spaces stay."""
    return F.trim(F.regexp_replace(F.lower(text), fixed.NOT_WORD_OR_SPACE, ""))


def space_word_count(text):
    """Pieces between single spaces, empty ones included.

    NULL for NULL, however the session sizes NULL arrays.
    """
    return F.array_size(F.split(text, " "))


def unicode_word_count(text):
    """Words between runs of Unicode white space; no empty words."""
    pieces = F.split(text, f"[{fixed.PYTHON_SPACE}]+")
    return F.size(F.filter(pieces, lambda piece: piece != ""))


def is_blank(text):
    """NULL, empty, or nothing but Unicode white space."""
    return ~F.coalesce(text.rlike(f"[^{fixed.PYTHON_SPACE}]"), F.lit(False))


def count_difference(left, right):
    return F.abs(left - right)


def content_print(text):
    """SHA-256 of a text in 32 bytes, so that equality can be tested without moving it."""
    return F.unhex(F.sha2(text, 256))
