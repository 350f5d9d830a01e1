"""Compare all (or the named) registered queries with their SQL: python tests/check.py [dir] [keys...]"""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as spine  # noqa: E402
from tests.compare import connect, differences  # noqa: E402
from tidalframe.session import build_session  # noqa: E402


def main(argv: list[str]) -> int:
    root = argv[0] if argv else "/root/testdata/sf0.01"
    queries, sqls = spine.queries(), spine.oracle_sql()
    keys = [k for k in queries if not argv[1:] or any(k == a or (a.endswith("*") and k.startswith(a[:-1])) for a in argv[1:])]
    spark = build_session(**{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(root), []
    for key in keys:
        start = time.time()
        try:
            if key in sqls:
                found = differences(spark, con, root, queries[key], sqls[key])
                note = "ok" if not found else "DIFF"
            else:
                df = queries[key](spark, root)
                rows = df.collect()
                found, note = [], f"rows {len(rows)} {rows[:2]}"
                if not rows:
                    found = ["no rows"]
        except Exception as err:
            found, note = [traceback.format_exc()[-1800:]], "FAIL"
        print(f"{key:24s} {time.time() - start:6.2f}s {note}"[:400], flush=True)
        for line in found:
            print("     ", line[:1800], flush=True)
        if found:
            bad.append(key)
    print(f"{len(keys) - len(bad)} of {len(keys)} fine; bad: {bad}")
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
