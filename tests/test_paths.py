import os

from pyspark.sql import functions as F

from verbalance.functions import measures, paths

NAMES = [
    "a.wav",
    "a.b.MP3",
    ".wav",
    "..wav",
    ".hidden.ogg",
    "no_extension",
    "ends.",
    "two words.Flac",
    "line\nbreak.m4a",
    "a.wav.txt",
]


def test_parts_equal_python(spark):
    rows = [(i, f"file:/drop/x.y/{name}") for i, name in enumerate(NAMES)]
    path = F.col("path")
    got = (
        spark.createDataFrame(rows, "id int, path string")
        .orderBy("id")
        .select(paths.file_name(path), paths.base_name(path), paths.file_type(path))
        .collect()
    )
    expected = []
    for name in NAMES:
        base, extension = os.path.splitext(name)
        expected.append((name, base, extension.lower().replace(".", "")))
    assert [tuple(row) for row in got] == expected


def test_audio_extensions_in_any_case(spark):
    frame = spark.createDataFrame([(f"/d/{name}",) for name in NAMES], "path string")
    kept = [os.path.basename(r[0]) for r in frame.where(paths.is_audio(F.col("path"))).collect()]
    assert kept == ["a.wav", "a.b.MP3", ".hidden.ogg", "two words.Flac", "line\nbreak.m4a"]


def test_duration_with_and_without_fraction(spark):
    frame = spark.createDataFrame(
        [
            ("2024-01-01T00:00:00", "2024-01-01T00:00:01.234567"),
            ("2024-01-01T23:59:59.900000", "2024-01-02T00:00:00"),
            (None, "2024-01-02T00:00:00"),
        ],
        "a string, b string",
    )
    got = frame.select(measures.record_duration(F.col("a"), F.col("b"))).collect()
    assert [row[0] for row in got] == [1.23, 0.1, None]
