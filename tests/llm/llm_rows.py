"""Helpers of the tests here."""


def rows_of(df):
    return sorted((tuple(x) for x in df.collect()), key=str)
