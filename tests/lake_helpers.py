"""What the tests of the lake share."""

SF_SMALL = "/root/testdata/sf0.001"


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
