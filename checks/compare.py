"""Run registered queries and their SQL side by side:  python -m checks.compare SF_DIR [name ...]"""

import contextlib
import io
import sys
import time

import duckdb

from checks.oracles import ORACLES
from checks.queries import REGISTRY
from paperloom.runtime import local_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def canonical(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def plan_text(df, mode: str = "simple") -> str:
    """The physical plan as Spark explains it; `extended` adds the logical ones."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode=mode)
    return out.getvalue()


def compare(spark, con, sf_dir: str, name: str) -> dict:
    start = time.time()
    df = REGISTRY[name](spark, sf_dir)
    ours = canonical(df.columns, [tuple(r) for r in df.collect()])
    spark_s = time.time() - start
    result = {"name": name, "rows": len(ours), "spark_s": round(spark_s, 2), "match": None}
    plan = plan_text(df)
    result["cross_join"] = any(j in plan for j in ("CartesianProduct", "NestedLoopJoin"))
    if name in ORACLES:
        start = time.time()
        done = con.execute(ORACLES[name])
        names = [d[0] for d in done.description]
        theirs = canonical(names, done.fetchall())
        result |= {
            "duckdb_s": round(time.time() - start, 2), "oracle_rows": len(theirs),
            "match": sorted(df.columns) == sorted(names) and ours == theirs,
        }
        if not result["match"]:
            result["columns"] = (sorted(df.columns), sorted(names))
            result["only_ours"] = [r for r in ours if r not in set(theirs)][:2]
            result["only_theirs"] = [r for r in theirs if r not in set(ours)][:2]
    return result


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(REGISTRY)
    spark, con, bad = local_session(), connect(sf_dir), []
    for name in names:
        try:
            result = compare(spark, con, sf_dir, name)
        except Exception as failed:
            result = {"name": name, "match": False, "error": f"{type(failed).__name__}: {str(failed)[:700]}"}
        print(result, flush=True)
        if result["match"] is False:
            bad.append(name)
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
