"""Compare every query with its SQL: python tests/check_queries.py FOLDER [NAME ...]"""

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry  # noqa: E402
from compare import database, differences  # noqa: E402
from tidemart.session import build_session  # noqa: E402

if __name__ == "__main__":
    folder, names = sys.argv[1], sys.argv[2:]
    spark = build_session("local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracles = database(folder), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            found = differences(queries[name](spark, folder), con, oracles[name])
        except Exception as e:
            found = [f"{type(e).__name__}: {str(e)[:600]}"]
            if names:
                traceback.print_exc()
        bad += bool(found)
        print(f"{name}: {'; '.join(found) or 'same'} ({time.time() - start:.1f}s)", flush=True)
    print(f"{bad} differ")
