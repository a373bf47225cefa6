"""Appending to database tables by JDBC."""


def append_table(df, url, table, **options):
    """Append ``df``; ``createTableColumnTypes`` sets types where the table is new."""
    properties = {key: str(value) for key, value in options.items()}
    df.write.format("jdbc").options(url=url, dbtable=table, **properties).mode("append").save()


def _known_runs(spark, url, table, **options):
    """The ``run_id`` column of a table, or None where there is no table yet."""
    source = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    try:
        return source.load().select("run_id")
    except Exception:
        # Databases tell a missing table each in their own way; the append then makes it, or
        # fails for the reason that hid it.
        return None


def table_appender(url, table, **options):
    """A sink for run audit rows; a run whose row is there is not added again."""

    def append(df):
        known = _known_runs(df.sparkSession, url, table, **options)
        if known is not None:
            # One id per run; compared here, since databases differ in how they compare long texts.
            df = df.join(known, "run_id", "left_anti").select(*df.columns)
        append_table(df.coalesce(1), url, table, **options)

    return append
