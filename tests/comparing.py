"""Rows of a frame in a form that tests can compare."""


def rows_of(df):
    """Rows as comparable tuples, in a fixed order."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
