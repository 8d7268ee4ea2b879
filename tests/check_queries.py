"""Run registered queries against their SQL: python tests/check_queries.py [sf_dir] [name ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import compare, connect  # noqa: E402

from catalodge.queries import all_queries  # noqa: E402
from catalodge.session import local_session  # noqa: E402


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    queries, oracle = all_queries()
    names = [n for n in queries if not sys.argv[2:] or any(n.startswith(a) for a in sys.argv[2:])]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = queries[name](spark, sf)
            if name in oracle:
                problem = compare(con, df, oracle[name])
            else:
                n = df.count()
                problem = None if n else "no rows"
                name += f" (rows only: {n})"
        except Exception as error:  # noqa: BLE001
            problem = str(error).split("JVM stacktrace")[0][:900]
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad}/{len(names)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
