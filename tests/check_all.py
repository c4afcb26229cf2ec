"""Compare all queries, or those named, with their oracles: check_all.py SF_DIR [NAME...]"""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from compare import difference, duck  # noqa: E402
from conftest import local_session  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

if __name__ == "__main__":
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, connection, sqls = local_session(), duck(sf_dir), entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        begin = time.time()
        try:
            problem, rows = difference(run(spark, sf_dir), connection, sqls[name])
        except Exception as error:  # report and go on with the next query
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", 0
        bad += problem is not None
        print(f"{name:36} {rows:8} {time.time() - begin:6.2f}s  {problem or 'ok'}", flush=True)
    print("failed:", bad, "without oracle:", sorted(set(entry.queries()) - set(sqls)))
