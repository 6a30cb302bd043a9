"""Run every registered query against its SQL: python tests/check_all.py <sf_dir> [key ...]"""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parent.parent)]

import __spark_entry__ as entry  # noqa: E402
from forecourt.session import build_session  # noqa: E402
from oracle import connect, differences  # noqa: E402

sf_dir, keys = sys.argv[1], sys.argv[2:]
spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="16g")
spark.sparkContext.setLogLevel("ERROR")
database = connect(sf_dir)
queries, oracles = entry.queries(), entry.oracle_sql()
for key in keys or queries:
    start = time.time()
    try:
        rows = queries[key](spark, sf_dir).toArrow()
        took = time.time() - start
        if key in oracles:
            found = differences(rows, database.sql(oracles[key]).to_arrow_table())
            state = "DIFF " + "; ".join(found) if found else "ok"
        else:
            state = "rows only"
        print(f"{key:28} {took:7.2f}s {rows.num_rows:8d} {state}", flush=True)
    except Exception as error:
        print(f"{key:28} ERROR {type(error).__name__} {str(error)[:1500]}", flush=True)
