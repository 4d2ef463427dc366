"""Results of DataFrames as plain values."""


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
