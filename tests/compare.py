"""Row comparison for tests: values as text, floats to nine digits, order-free."""

import datetime as dt
import decimal


def cell(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.9g}"
    if isinstance(v, int):
        return f"{v:.9g}" if abs(v) < 10**9 else str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return repr(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def values(df, *columns):
    """Sorted plain tuples of a frame."""
    names = columns or df.columns
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)
