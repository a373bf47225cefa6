"""Batch recognition: bytes to text with any recognizer, one Arrow batch at a time."""

from pyspark.sql import functions as F

ATTEMPT_SCHEMA = (
    "path string, length bigint, audio_id string, ingestion_timestamp string, "
    "processing_timestamp string, text string, error string, error_type string"
)
ROWS_PER_OUTPUT_BATCH = 64
PIECE_BYTES = 1024 * 1024
# The schemes tasks can open, by the name Arrow knows them under.
ARROW_SCHEMES = {
    "file": "file",
    "s3": "s3",
    "s3a": "s3",
    "s3n": "s3",
    "gs": "gs",
    "abfs": "abfs",
    "abfss": "abfss",
    "hdfs": "hdfs",
    "viewfs": "viewfs",
}


class UnsupportedStorage(ValueError):
    """Files lie in a store that tasks cannot open."""


def can_open(path):
    """Whether tasks can open paths spelled like this one."""
    return path.startswith("/") or path.split(":", 1)[0] in ARROW_SCHEMES


def check_storage(files):
    """Raise before any file is opened if a path has a scheme that tasks cannot open."""
    scheme = F.when(F.col("path").startswith("/"), F.lit("file")).otherwise(
        F.substring_index("path", ":", 1)
    )
    other = files.select(scheme.alias("scheme")).where(~F.col("scheme").isin(*ARROW_SCHEMES))
    found = other.first()
    if found:
        raise UnsupportedStorage(
            f"cannot open {found['scheme']!r}; supported: {', '.join(ARROW_SCHEMES)}"
        )


def attempter(make_recognizer, clock=None, by_stream=False):
    """A function for tasks that gives ``attempt(path, length, content) -> row of ATTEMPT_SCHEMA``.

    With ``content`` None the file is read in pieces of ``PIECE_BYTES``, once for its digest and,
    ``by_stream``, once more by the recognizer, which then takes an open binary stream in place
    of bytes: no file has to fit in memory.
    """
    schemes, piece = dict(ARROW_SCHEMES), PIECE_BYTES

    # Everything the task needs is defined or imported in here, so that it is
    # shipped with the task and the workers need not have this package.
    def start():
        import hashlib
        import io
        from datetime import datetime, timezone
        from urllib.parse import quote

        from pyarrow import fs

        def utc_now():
            return datetime.now(timezone.utc).replace(tzinfo=None).isoformat()

        def opened(path):
            if path.startswith("/"):
                system, name = fs.LocalFileSystem(), path
            elif path.startswith("file:"):
                system, name = fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
            else:
                scheme, rest = path.split(":", 1)
                uri = f"{schemes.get(scheme, scheme)}:{quote(rest, safe=':/@')}"
                system, name = fs.FileSystem.from_uri(uri)
            return system.open_input_stream(name)

        def digest_and_content(path):
            digest, kept = hashlib.sha256(), []
            with opened(path) as stream:
                while part := stream.read(piece):
                    digest.update(part)
                    if not by_stream:
                        kept.append(part)
            return digest.hexdigest(), b"".join(kept)

        def storable(text):
            if not isinstance(text, (str, type(None))):
                raise TypeError(f"recognizer gave {type(text).__name__}, not text")
            (text or "").encode("utf-8")
            return text

        now = clock or utc_now
        recognizer = None

        def attempt(path, length, content):
            nonlocal recognizer
            started, text, error, error_type = now(), None, None, None
            given = content is not None
            if given:
                audio_id = hashlib.sha256(content).hexdigest()
            else:
                audio_id, content = digest_and_content(path)
            stream = None
            if by_stream:
                stream = io.BytesIO(content) if given else opened(path)
            try:
                if recognizer is None:
                    recognizer = make_recognizer()
                text = storable(recognizer(stream or content, path))
            except Exception as problem:
                error = str(problem).encode("utf-8", "replace").decode("utf-8")
                error_type = type(problem).__name__
            finally:
                if stream:
                    stream.close()
            return path, length, audio_id, started, now(), text, error, error_type

        return attempt

    return start


def transcribe(files, make_recognizer, clock=None, by_stream=False):
    """Recognize each file; a file that the recognizer cannot take gives a row with its error.

    A file that cannot be read fails the task instead: a fault of the storage says
    nothing about the file, which then gets no record.

    ``files`` has ``path, length`` and may have ``content``. Without it a task
    opens each path itself, so audio is read where it is recognized and is never
    shuffled. ``make_recognizer()`` runs in the task before its first file and
    returns ``recognizer(content, path) -> text``; ``clock()`` returns an ISO-8601
    string. Both must be picklable.
    """
    columns = [c for c in ("path", "length", "content") if c in files.columns]
    start = attempter(make_recognizer, clock, by_stream)
    names = [field.split()[0] for field in ATTEMPT_SCHEMA.split(", ")]
    rows_at_once = ROWS_PER_OUTPUT_BATCH

    def run(batches):
        import pyarrow as pa

        attempt = start()
        types = [pa.string(), pa.int64()] + [pa.string()] * 6
        schema = pa.schema(list(zip(names, types)))
        for batch in batches:
            for first in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(first, rows_at_once).to_pylist()
                rows = [attempt(r["path"], r["length"], r.get("content")) for r in part]
                arrays = [pa.array(values, t) for values, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return files.select(*columns).mapInArrow(run, ATTEMPT_SCHEMA)
