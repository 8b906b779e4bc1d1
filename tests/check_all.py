"""``python tests/check_all.py [sf] [name-prefix ...]``: check the catalog outside pytest."""
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import compare, duck  # noqa: E402

from tallyforge.catalog import load_all  # noqa: E402
from tallyforge.session import local_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    queries, oracles = load_all()
    bad = 0
    for name, fn in queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracles:
                ok, msg = compare(spark, con, fn, oracles[name], sf_dir)
            else:
                ok, msg = True, f"rows only: {fn(spark, sf_dir).count()}"
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"{type(e).__name__}: {str(e)[:1500]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {msg}", flush=True)
    print("failures:", bad)


main()
