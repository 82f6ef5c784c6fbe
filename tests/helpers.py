"""Helpers that several test modules import."""


def rows(df, *order):
    """Rows as plain tuples, sorted."""
    return sorted((tuple(row) for row in (df.select(*order) if order else df).collect()), key=repr)
