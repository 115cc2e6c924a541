"""Compare every query that has SQL: ``python tests/check_all.py [sf_dir] [name ...]``."""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

from compare import connect, difference  # noqa: E402
from conftest import make_session  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark, con, bad = make_session(), connect(sf_dir), 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        sql, start = oracle_sql().get(name), time.time()
        try:
            if sql is None:
                note = f"rows only: {run(spark, sf_dir).count()}"
            else:
                problem = difference(run(spark, sf_dir), con, sql)
                bad += bool(problem)
                note = f"DIFFERS {problem}" if problem else f"ok (sql {difference.times[1]:.1f}s)"
        except Exception as error:
            bad += 1
            note = f"ERROR {type(error).__name__} {str(error)[:600]}"
        print(f"{name:28s} {time.time() - start:6.1f}s {note}", flush=True)
    missing = set(oracle_sql()) - set(queries())
    print("SQL without query:", missing, "failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
