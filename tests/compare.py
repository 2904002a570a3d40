"""Run registered queries against their oracle SQL: python tests/compare.py [sf] [name ...]."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def oracle(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf[sorted(pdf.columns)].copy()
    for c in pdf.columns:
        col = pdf[c]
        pdf[c] = [
            "~" if x is None or (not hasattr(x, "__len__") and pd.isna(x))
            else repr(round(float(x), 9) + 0.0) if isinstance(x, (int, float)) or hasattr(x, "dtype") and x.ndim == 0
            else str([int(v) for v in x]) if hasattr(x, "tolist") or isinstance(x, list)
            else str(x)
            for x in col.astype(object)
        ]
    return pdf.sort_values(list(pdf.columns)).reset_index(drop=True)


def difference(spark_pdf: pd.DataFrame, sql_pdf: pd.DataFrame) -> str | None:
    if sorted(spark_pdf.columns) != sorted(sql_pdf.columns):
        return f"columns {sorted(spark_pdf.columns)} / {sorted(sql_pdf.columns)}"
    if len(spark_pdf) != len(sql_pdf):
        return f"rows {len(spark_pdf)} / {len(sql_pdf)}"
    a, b = canonical(spark_pdf), canonical(sql_pdf)
    wrong = (a != b).any(axis=1)
    if wrong.any():
        return f"{wrong.sum()} of {len(a)} rows differ\n{a[wrong].head(4)}\n{b[wrong].head(4)}"
    return None


def main() -> int:
    import catalogue
    import catalogue_jobs  # noqa: F401
    from pluvio.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    sf_dir = f"/root/testdata/{sf}"
    names = sys.argv[2:] or list(catalogue.QUERIES)
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            got = catalogue.QUERIES[name](spark, sf_dir).toPandas()
            took = time.time() - start
            if name in catalogue.ORACLES:
                problem = difference(got, con.sql(catalogue.ORACLES[name]).df())
            else:
                problem = None if len(got) else "no rows"
        except Exception as error:  # noqa: BLE001
            problem, took, got = f"{type(error).__name__}: {str(error)[:1500]}", 0.0, ()
        bad += problem is not None
        kind = "sql" if name in catalogue.ORACLES else "rows"
        print(f"{'ok ' if problem is None else 'BAD'} {name} [{kind}] rows={len(got)} {took:.2f}s {problem or ''}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
