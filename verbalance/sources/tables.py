"""Database tables by JDBC."""

_HEX = "0123456789abcdef"


def hex_ranges(column, digits=1):
    """Predicates that split a hex-string key into ``16 ** digits`` disjoint ranges.

    Each value is in exactly one range: NULL and anything below the first bound in
    the first, anything above the last bound in the last. The database must order
    digits before letters; quote ``column`` as it wants it.
    """
    bounds = [""]
    for _ in range(digits):
        bounds = [bound + digit for bound in bounds for digit in _HEX]
    bounds = bounds[1:]
    ranges = [f"{column} < '{bounds[0]}' or {column} is null"]
    ranges += [f"{column} >= '{a}' and {column} < '{b}'" for a, b in zip(bounds, bounds[1:])]
    return [*ranges, f"{column} >= '{bounds[-1]}'"]


def split_ranges(ranges, hot, column, bounds):
    """Split the ranges listed in ``hot`` once more by another column.

    For a key range that one key dominates: ``bounds`` are increasing SQL literals
    of ``column``.
    """
    first, last = f"{column} < {bounds[0]} or {column} is null", f"{column} >= {bounds[-1]}"
    between = [f"{column} >= {a} and {column} < {b}" for a, b in zip(bounds, bounds[1:])]
    out = []
    for index, part in enumerate(ranges):
        if index in hot:
            out += [f"({part}) and ({piece})" for piece in (first, *between, last)]
        else:
            out.append(part)
    return out


def quoted(url, name):
    """A column's name as the database at ``url`` spells it in SQL."""
    if url.startswith("jdbc:mysql"):
        return f"`{name}`"
    return f"[{name}]" if url.startswith("jdbc:sqlserver") else f'"{name}"'


def _literal(text):
    return "'" + text.replace("'", "''") + "'"


def _pieces(ask, table, column, most, within):
    """``(prefix, rows, single)`` in key order: prefixes of the key that have at most ``most`` rows.

    The database counts; a prefix with more rows is counted again by one character more, unless
    all of its rows have one key (``single``). One statement per length of prefixes.
    """
    done, heavy, length = [], None, 1
    while heavy is None or heavy:
        wanted = [f"{column} is not null", *within]
        if heavy:
            listed = ", ".join(map(_literal, heavy))
            wanted.append(f"substr({column}, 1, {length - 1}) in ({listed})")
        prefix = f"substr({column}, 1, {length})"
        rows = ask(
            f"select {prefix} as p, count(*) as n, min({column}) as low, max({column}) as high "
            f"from {table} where {' and '.join(wanted)} group by {prefix}"
        )
        heavy = []
        for p, n, low, high in rows:
            if n <= most or low == high:
                done.append((low if low == high else p, n, low == high))
            else:
                heavy.append(p)
        length += 1
    return sorted(done)


def balanced_ranges(spark, url, table, column, parts, second=None, within=(), **options):
    """Predicates that split a string key into about ``parts`` ranges of like numbers of rows.

    The database counts rows by prefixes of the key, so that no range has more than twice the
    mean; the driver sees a few counts per range. A key that alone has more rows is split by
    the column ``second``, if that is given, and else is a range of its own. Every row is in exactly one
    range, null keys in the first. The database must compare strings by their characters' codes.
    """

    def ask(query):
        source = spark.read.format("jdbc").options(url=url, query=query, **options)
        return [tuple(row) for row in source.load().collect()]

    where = f" where {' and '.join(within)}" if within else ""
    total = ask(f"select count(*) as n from {table}{where}")[0][0]
    mean = max(total / max(parts, 1), 1)
    bounds, hot, held = [], [], 0
    for start, rows, single in _pieces(ask, table, column, mean, within):
        if single and rows > mean:
            hot.append((start, rows))
            # Its own key is taken out of the range around it.
            continue
        if held + rows > mean and held:
            bounds.append(start)
            held = 0
        held += rows
    outside = [f"{column} <> {_literal(key)}" for key, _ in hot]
    edges = [None, *map(_literal, bounds), None]
    ranges = []
    for low, high in zip(edges, edges[1:]):
        sides = [f"{column} >= {low}"] if low else []
        sides += [f"{column} < {high}"] if high else []
        part = " and ".join([*sides, *outside, *within]) or "1 = 1"
        null = " and ".join([f"{column} is null", *within])
        ranges.append(part if low else f"({part}) or ({null})")
    for key, rows in hot:
        only = (*within, f"{column} = {_literal(key)}")
        if second:
            pieces = max(2, round(rows / mean))
            ranges += balanced_ranges(spark, url, table, second, pieces, None, only, **options)
        else:
            ranges.append(" and ".join(only))
    return ranges


def read_table(spark, url, table, predicates=None, **options):
    """A table as a frame; with ``predicates`` one task reads each of them.

    ``options`` are connection options such as ``driver``, ``user`` or
    ``fetchsize``.
    """
    properties = {key: str(value) for key, value in options.items()}
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)
    return spark.read.format("jdbc").options(url=url, dbtable=table, **properties).load()
