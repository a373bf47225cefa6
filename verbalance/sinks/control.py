"""Small control files: lists of what is live, read and written by the driver.

They go through Hadoop's client, so any store that Spark writes to will do. A file is
complete as soon as it has its name, and is never changed.
"""

import json

VERSIONS = "_versions"
_DIGITS = 12


def _system(spark, path):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def exists(spark, path):
    system, place = _system(spark, path)
    return system.exists(place)


def names(spark, folder):
    """Names of what lies directly in a folder; none if there is no folder."""
    system, place = _system(spark, folder)
    if not system.exists(place):
        return []
    return [status.getPath().getName() for status in system.listStatus(place)]


def make_folder(spark, path):
    system, place = _system(spark, path)
    system.mkdirs(place)


def remove(spark, path):
    system, place = _system(spark, path)
    system.delete(place, False)


def read_json(spark, path):
    system, place = _system(spark, path)
    stream = system.open(place)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def write_json(spark, path, value):
    """Write a file that is not there yet; False if another writer was first."""
    system, place = _system(spark, path)
    if system.exists(place):
        return False
    draft = place.suffix(".draft")
    stream = system.create(draft, True)
    stream.write(json.dumps(value).encode("utf-8"))
    stream.close()
    return not system.exists(place) and system.rename(draft, place)


def batch_ids(spark, path, known=()):
    """Ids of the batches, other than ``known``, that a dataset has a complete partition of."""
    found = {n.split("=", 1)[1] for n in names(spark, path) if n.startswith("batch_id=")}
    return sorted(b for b in found.difference(known) if complete(spark, f"{path}/batch_id={b}"))


def complete(spark, folder):
    """Whether a partition was committed: by itself, or as one of several."""
    inside = names(spark, folder)
    return "_SUCCESS" in inside or bool(inside) and "_temporary" not in inside


class Conflict(RuntimeError):
    """Another writer committed the same version."""


def latest_version(spark, root):
    """Number and content of the highest version; 0 and None before the first."""
    numbers = [int(n.split(".")[0]) for n in names(spark, f"{root}/{VERSIONS}") if n.endswith(".json")]
    if not numbers:
        return 0, None
    number = max(numbers)
    return number, read_json(spark, _version_path(root, number))


def commit_version(spark, root, number, content):
    """Make ``content`` version ``number``. Readers see the version before or this one, whole."""
    if not write_json(spark, _version_path(root, number), content):
        raise Conflict(f"version {number} of {root} was written by another run")


def _version_path(root, number):
    return f"{root}/{VERSIONS}/{number:0{_DIGITS}d}.json"
