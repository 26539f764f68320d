"""Comparison of Spark rows with oracle rows: unrounded values, relative tolerance for doubles."""

import math

REL = 1e-9
ABS = 1e-9


def canonical(rows, columns):
    """Rows in column-name order, sorted by their exact cells first and their doubles last."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(v.item() if hasattr(v, "item") else v for v in (row[i] for i in order)) for row in rows]
    exact = lambda row: tuple(repr(v) for v in row if not isinstance(v, float))
    doubles = lambda row: tuple(v for v in row if isinstance(v, float))
    return sorted(plain, key=lambda row: (exact(row), doubles(row)))


def same_cell(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b)) or math.isclose(a, b, rel_tol=REL, abs_tol=ABS)
    return repr(a) == repr(b)


def differences(rows_a, columns_a, rows_b, columns_b, limit=3):
    """Pairs of rows that differ (at most `limit`), or a message on shape."""
    if sorted(columns_a) != sorted(columns_b):
        return [f"columns {sorted(columns_a)} and {sorted(columns_b)}"]
    a, b = canonical(rows_a, columns_a), canonical(rows_b, columns_b)
    if len(a) != len(b):
        return [f"{len(a)} and {len(b)} rows"]
    return [(x, y) for x, y in zip(a, b) if len(x) != len(y) or not all(map(same_cell, x, y))][:limit]
