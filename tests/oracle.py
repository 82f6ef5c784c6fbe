"""Side-by-side comparison of a registered query with its SQL oracle."""

import datetime
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir):
    db = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def from_spark(df):
    return canonical(df.columns, [tuple(row) for row in df.collect()])


def from_duckdb(db, sql):
    cursor = db.execute(sql)
    return canonical([column[0] for column in cursor.description], cursor.fetchall())


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}


def type_differences(db, df, sql):
    duck = {row[0]: row[1] for row in db.execute(f"DESCRIBE {sql}").fetchall()}
    return {name: (kind, duck.get(name)) for name, kind in df.dtypes if SPARK_TO_DUCK.get(kind, kind) != duck.get(name)}
