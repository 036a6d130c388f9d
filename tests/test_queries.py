"""The engine's queries against their SQL on the smallest tables."""

import duckdb
import numpy as np
import pandas as pd
import pytest

from evidentia.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def rows(df: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if hasattr(v, "__len__") and not isinstance(v, str):
            return str(list(v))
        if v is None or pd.isna(v):
            return "null"
        return repr(round(float(v), 6)) if isinstance(v, float) else str(v)

    return sorted(tuple(map(plain, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    mine, theirs = QUERIES[name](spark, SF).toPandas(), duck.execute(ORACLE_SQL[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert rows(mine) == rows(theirs)


def test_clusters_of_labels_are_complete(spark):
    d = QUERIES["complete_link"](spark, SF).toPandas()
    v = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas().set_index("vec_id").embedding
    assert len(d) == len(v)
    for _, g in d[d.groupby(["label", "cluster"]).key.transform("size") > 1].groupby(["label", "cluster"]):
        keys = [int(k) for k in g.key]
        for i in keys:
            for j in keys:
                a, b = np.asarray(v[i], float), np.asarray(v[j], float)
                assert i == j or a @ b / ((a @ a) * (b @ b)) ** 0.5 > 0.1999


def made(spark, tmp_path, **tables):
    for name, (rows_, schema) in tables.items():
        spark.createDataFrame(rows_, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    c = duckdb.connect()
    for name in tables:
        c.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    return c


def test_passages_of_any_length_are_found(spark, tmp_path):
    docs = [(1, "alpha beta gamma"), (2, "xalpha betax"), (3, "one  alpha\nbeta two three"), (4, None), (5, "")]
    items = [(1, "alpha beta"), (2, "alpha"), (3, "one alpha beta two"), (4, "missing"), (5, "beta two three"), (6, "")]
    c = made(spark, tmp_path, documents=(docs, "doc_id long, text string"), benchmark=(items, "item_id long, text string"))
    got = {r.item_id: r.n_documents for r in QUERIES["excerpt_verified"](spark, str(tmp_path)).collect()}
    assert got == dict(c.execute(ORACLE_SQL["excerpt_verified"]).fetchall()) and (got[1], got[2], got[3], got[4], got[5]) == (3, 3, 1, 0, 1)


def test_conditions_of_all_kinds(spark, tmp_path):
    texts = ["no E14.5 cells for 3 hours and 03.50 h", "10 mg, 10.0 mg and 5 percent; p53 knockout, abc-ko", "the 7 days", "abc-kox 12x"]
    c = made(spark, tmp_path, documents=(list(enumerate(texts)), "doc_id long, text string"))
    got = {r.condition: r.n_documents for r in QUERIES["protected_conditions"](spark, str(tmp_path)).collect()}
    assert got == dict(c.execute(ORACLE_SQL["protected_conditions"]).fetchall())
    assert {"negation:no", "development_stage:e14.5", "time:3 h", "time:3.5 h", "dose:10 mg", "dose:5 %", "perturbation:p53 knockout", "perturbation:abc-ko", "time:7 days"} <= set(got)


def test_boundaries_of_all_lines(spark, tmp_path):
    c = made(spark, tmp_path, documents=([(1, "\n".join(f"line {i} is long enough to be substantial here" for i in range(9)) + "\nshort\n\nshort")], "doc_id long, text string"))
    d = QUERIES["rule_quality_boundaries"](spark, str(tmp_path)).toPandas()
    assert rows(d) == rows(c.execute(ORACLE_SQL["rule_quality_boundaries"]).df()) and d.codes[0] == "boundaries.duplicates,boundaries.shallow,boundaries.blank"


def test_ratios_against_all_windows(spark):
    from difflib import SequenceMatcher
    from random import Random

    from evidentia.functions.similarity import best_ratio

    rng = Random(3)
    for _ in range(60):
        s = "".join(rng.choice("abcd e") for _ in range(rng.randint(0, 300))).strip()
        e = s[:30][: rng.randint(0, 30)].replace("a", "x", 1) if rng.random() < 0.5 else "".join(rng.choice("abx ") for _ in range(rng.randint(0, 20)))
        e, s = " ".join(e.split()), " ".join(s.split())
        full = 0.0 if not e or not s else max(SequenceMatcher(None, e, s[i : i + len(e)], autojunk=False).ratio() for i in range(max(1, len(s) - len(e) + 1)))
        assert best_ratio(e, s) == pytest.approx(full)


def test_entry_and_names(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["paper_id", "chunk_id", "ordinal", "score"]
    assert set(e.oracle_sql()) <= set(e.queries())


def test_import_needs_no_session():
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; e.queries(); e.oracle_sql(); import evidentia.cli, evidentia.plans.export, evidentia.streaming.ingest"], cwd=root, check=True)
