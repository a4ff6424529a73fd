"""Exact, order-free comparison of two result sets."""


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, _sorted([tuple(r) for r in df.select(*names).collect()])


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    relation = con.sql(sql)
    names = sorted(relation.columns)
    return names, _sorted(relation.select(*[f'"{n}"' for n in names]).fetchall())


def assert_same(left, right) -> None:
    assert left[0] == right[0]
    assert len(left[1]) == len(right[1])
    differing = [(a, b) for a, b in zip(left[1], right[1], strict=True) if a != b]
    assert differing == [], f"{len(differing)} rows differ, first {differing[:2]}"


def assert_close(left, right, tolerance: float = 1e-3) -> None:
    """As ``assert_same``, for running sums of doubles."""
    assert left[0] == right[0]
    assert len(left[1]) == len(right[1])
    for a, b in zip(left[1], right[1], strict=True):
        for x, y in zip(a, b, strict=True):
            assert x == y or abs(x - y) <= tolerance, (a, b)


def _sorted(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda row: tuple((v is not None, str(type(v)), v) for v in row))
