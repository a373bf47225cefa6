"""Parts of a file path. A dot that only leads the name starts no extension."""

from pyspark.sql import functions as F

from verbalance import fixed

_EXTENSION = r"(?s)^\.*[^.].*(\.[^.]*)\z"


def file_name(path):
    return F.substring_index(path, "/", -1)


def extension(path):
    """The last extension in lower case with its dot, or an empty string."""
    return F.lower(F.regexp_extract(file_name(path), _EXTENSION, 1))


def base_name(path):
    """The file name without its last extension."""
    name = file_name(path)
    return F.left(name, F.length(name) - F.length(extension(path)))


def file_type(path):
    return F.replace(extension(path), F.lit("."), F.lit(""))


def is_audio(path):
    return extension(path).isin(*fixed.AUDIO_EXTENSIONS)
