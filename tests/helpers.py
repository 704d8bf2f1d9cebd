"""What several test modules use."""


def rows(df, *columns):
    """The rows as sorted tuples, NULLs first."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))
