import math

from tidemark.plans.series import SeriesSpec

# a series longer than 37 rows makes every 37 rows of the table a slice
TINY = SeriesSpec(slice_rows=37)
WHOLE = SeriesSpec()


def cell(v, digits=6):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}") if v == 0 or abs(v) > 1e-12 else 0.0
    return v


def rows(df):
    return sorted((tuple(cell(v) for v in r) for r in df.collect()), key=repr)


def assert_same(a, b):
    assert a.columns == b.columns
    left, right = rows(a), rows(b)
    assert len(left) == len(right)
    for x, y in zip(left, right):
        for name, p, q in zip(a.columns, x, y):
            if isinstance(p, float) and isinstance(q, float):
                assert math.isclose(p, q, rel_tol=1e-7, abs_tol=1e-9), (name, x, y)
            else:
                assert p == q, (name, x, y)


def by_order(df, *cols, order=("instrument", "ts")):
    return [tuple(r[c] for c in cols) for r in df.orderBy(*order).collect()]
