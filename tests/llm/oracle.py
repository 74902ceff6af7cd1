"""Compare a Spark result with DuckDB SQL over the same input frame."""


def same_rows(con, frame, name, sql, result):
    arrow = frame.toArrow()
    con.register(name, arrow)
    got = con.execute(sql)
    cols = [d[0] for d in got.description]
    want = sorted((tuple(str(v) for v in r) for r in got.fetchall()))
    mine = sorted(tuple(str(r[c]) for c in cols) for r in result.collect())
    assert sorted(cols) == sorted(result.columns)
    assert mine == want
    return mine
