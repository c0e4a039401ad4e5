"""Row-for-row comparison of a Spark result with DuckDB's answer."""

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

KINDS = {
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "int",
    "INTEGER": "int", "BIGINT": "int", "string": "text", "VARCHAR": "text",
    "double": "float", "DOUBLE": "float", "boolean": "bool", "BOOLEAN": "bool",
}


def oracle(sf_dir, sql):
    """Rows and (column, kind) pairs, columns by name."""
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    names = [row[0] for row in con.execute(f"describe {sql}").fetchall()]
    types = [row[1] for row in con.execute(f"describe {sql}").fetchall()]
    rows = con.execute(sql).fetchall()
    return _by_name(names, [KINDS.get(t, t) for t in types], rows)


def computed(df):
    names, types = zip(*df.dtypes)
    rows = [tuple(r) for r in df.collect()]
    return _by_name(list(names), [KINDS.get(t, t) for t in types], rows)


def _by_name(names, kinds, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    schema = [(names[i], kinds[i]) for i in order]
    return schema, sorted(repr(tuple(row[i] for i in order)) for row in rows)
