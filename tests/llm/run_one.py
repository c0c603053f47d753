"""Run queries of the subpackage on a folder of tables: ``run_one.py FOLDER NAME...``; compares with SQL where given."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import duck, rows_of  # noqa: E402

from tidemark.llm.queries import ORACLES, QUERIES  # noqa: E402
from tidemark.session import local_session, release_scratch  # noqa: E402


def against_sql(spark, folder, name) -> str | None:
    """None where the query's rows are those of its SQL, doubles to nine digits."""
    near = lambda v: float(f"{v:.9g}") if isinstance(v, float) else v
    df = QUERIES[name](spark, folder)
    found = rows_of(df.columns, [tuple(near(v) for v in r) for r in df.collect()])
    result = duck(folder).execute(ORACLES[name])
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    expected = rows_of(names, [tuple(near(v) for v in r) for r in result.fetchall()])
    if found == expected:
        return None
    return f"only here {list(found - expected)[:2]}, only there {list(expected - found)[:2]}"


if __name__ == "__main__":
    spark = local_session("8")
    spark.sparkContext.setLogLevel("OFF")
    for name in sys.argv[2:] or QUERIES:
        begin = time.time()
        if name in ORACLES:
            said = against_sql(spark, sys.argv[1], name) or "same as the SQL"
        else:
            out = QUERIES[name](spark, sys.argv[1])
            rows = out.collect()
            said = f"{len(rows)} rows {out.columns} {rows[:2]}"
        print(f"{name} {time.time() - begin:.1f} s: {said[:1500]}", flush=True)
    release_scratch(spark)
