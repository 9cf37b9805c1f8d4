"""Command line: python tests/check.py [name prefix ...] [--sf 0.01]"""

import sys

sys.path.insert(0, __file__.rsplit("/", 2)[0])

import __spark_entry__ as entry  # noqa: E402
from siftwork.session import build_session  # noqa: E402
from tests.compare import compare, connect  # noqa: E402


def main(argv):
    sf = "0.01"
    if "--sf" in argv:
        i = argv.index("--sf")
        sf = argv[i + 1]
        del argv[i:i + 2]
    folder = f"/root/testdata/sf{sf}"
    spark = build_session("check", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracles = entry.oracle_sql()
    failed = []
    for name, fn in entry.queries().items():
        if argv and not any(name.startswith(p) for p in argv):
            continue
        try:
            ok, note = compare(spark, con, folder, name, fn, oracles.get(name))
        except Exception as e:  # noqa: BLE001
            ok, note = False, f"{type(e).__name__}: {str(e)[:900]}"
        print(("ok   " if ok else "FAIL ") + name, "|", note, flush=True)
        if not ok:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
