"""Audio files in a drop directory, found without reading their content."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from verbalance import fixed
from verbalance.functions import paths

# Schema of the binary file source, which a stream must declare.
_BINARY_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def _any_case(extension):
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in extension)


AUDIO_GLOB = "*{" + ",".join(_any_case(e) for e in fixed.AUDIO_EXTENSIONS) + "}"


class NoAudioFound(ValueError):
    """The input is missing, or holds no file with a supported extension."""


def audio_only(files):
    return files.where(paths.is_audio(F.col("path")))


def _place(spark, location):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def qualified(spark, location):
    """The location as the ``path`` column spells it."""
    system, path = _place(spark, location)
    return system.makeQualified(path).toString()


def is_folder(spark, location):
    system, path = _place(spark, location)
    return system.exists(path) and system.getFileStatus(path).isDirectory()


def _listed(reader, spark, location, columns=("path", "length")):
    """``columns`` of audio files that are, or are directly in, ``location``.

    The source would take folders below for partitions, so it lists them as well
    and their files are dropped here. The content column is pruned from the scan.
    """
    root, path = qualified(spark, location), F.col("path")
    parent = F.left(path, F.length(path) - F.length(paths.file_name(path)) - F.lit(1))
    return (
        reader.option("pathGlobFilter", AUDIO_GLOB)
        .option("recursiveFileLookup", True)
        .load(location)
        .select(*columns)
        .where((path == root) | (parent == root))
        .transform(audio_only)
    )


def discover(spark, location, with_content=False):
    """The audio files directly in ``location``, or that one file.

    ``with_content`` reads them through Spark as well, which opens whatever it can list; a file
    then has to fit in memory.
    """
    columns = ("path", "length", "content") if with_content else ("path", "length")
    supported = ", ".join(fixed.AUDIO_EXTENSIONS)
    try:
        found = _listed(spark.read.format("binaryFile"), spark, location, columns)
    except AnalysisException as error:
        raise NoAudioFound(f"input path not found: {location}") from error
    if found.isEmpty():
        raise NoAudioFound(f"no audio files in {location}; supported: {supported}")
    return found


def stream_audio(spark, location, max_files_per_trigger=100_000):
    """The audio files of ``location`` as a stream; a micro-batch has a bounded number.

    A file counts as new however old it is: copies often keep the time of their original.
    """
    reader = spark.readStream.format("binaryFile").schema(_BINARY_FILES)
    reader = reader.option("maxFileAge", "36500d")
    return _listed(reader.option("maxFilesPerTrigger", max_files_per_trigger), spark, location)
