import pytest
from pyspark.sql import functions as F

from verbalance.functions import text

NBSP = " "
CASES = [
    # text, cleaned, pieces of it, normalized, pieces of it, words
    ("\n a \t b\n", " a b ", 4, "a b", 2, 2),
    (NBSP + "a" + NBSP + "b" + NBSP, NBSP + "a" + NBSP + "b" + NBSP, 1, "ab", 1, 2),
    ("", "", 1, "", 1, 0),
    (None, None, None, None, None, None),
    ("École, 5 - déjà_vu!", "École, 5 - déjà_vu!", 4, "cole 5  dj_vu", 4, 4),
    ("   ", "", 1, "", 1, 0),
    ("a\x0bb", "a b", 2, "a b", 2, 2),
    ("A.b C", "A.b C", 2, "ab c", 2, 2),
]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_edge_table(spark, ansi):
    rows = [(i, case[0]) for i, case in enumerate(CASES)]
    words = F.col("text")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        got = (
            spark.createDataFrame(rows, "id int, text string")
            .withColumn("cleaned", text.clean(words))
            .withColumn("normal", text.normalize(F.col("cleaned")))
            .orderBy("id")
            .select(
                "text",
                "cleaned",
                text.space_word_count(F.col("cleaned")),
                "normal",
                text.space_word_count(F.col("normal")),
                F.when(words.isNotNull(), text.unicode_word_count(words)),
            )
            .collect()
        )
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert [tuple(row) for row in got] == CASES


def test_unicode_rules_equal_python(spark):
    """Every BMP character alone, as a separator, and at the edge of a word."""
    points = [i for i in range(1, 0x10000) if not 0xD800 <= i <= 0xDFFF]
    samples = [f"a{chr(i)}b{chr(i)}" for i in points] + [chr(i) for i in points]
    words = F.col("text")
    got = (
        spark.createDataFrame(list(enumerate(samples)), "id int, text string")
        .orderBy("id")
        .select(text.unicode_word_count(words), text.is_blank(words))
        .collect()
    )
    assert [tuple(r) for r in got] == [(len(s.split()), not s.strip()) for s in samples]


def test_blank_takes_null_and_empty(spark):
    frame = spark.createDataFrame([(None,), ("",), (" \n" + NBSP,), (" a ",)], "text string")
    got = [row[0] for row in frame.select(text.is_blank(F.col("text"))).collect()]
    assert got == [True, True, True, False]
