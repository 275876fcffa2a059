import duckdb
import pytest

import __spark_entry__ as entry

from conftest import SF_SMALL

ROWS_ONLY = {"als_grid_search", "best_params", "als_user_recs", "als_movie_recs"}
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["genre", "rank", "mid", "avg"]
    assert df.count() > 0


def test_every_query_has_oracle_or_is_model_based():
    q, o = entry.QUERIES, entry.SQL
    assert set(o) <= set(q)
    assert set(q) - set(o) == ROWS_ONLY
    assert set(q) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def cell(v):
        return round(v, 6) if isinstance(v, float) else v
    return sorted(tuple(repr(cell(r[i])) for i in order) for r in rows)


@pytest.mark.parametrize("name", [
    "genre_top10", "rate_more_recently", "movies_with_tags", "load_movies",
    "item_similarity", "user_topk_recs", "realtime_recs", "route_messages",
    "log_filter", "user_uid", "update_user_genres", "rmse_pairwise", "keyed_dedupe_movies",
    "upsert_stream_recs", "stream_rejects", "stream_recent_ratings", "best_params_rule",
    "sql_month_counts", "pair_similarity", "als_movie_recs_check",
])
def test_matches_duckdb_small(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    rel = duck.sql(entry.oracle_sql()[name])
    want = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert _norm(got, df.columns) == _norm(want, rel.columns)


def test_entry_without_the_training_data_part(tmp_path):
    """The entry imports, and lists the library's queries, where that part is deleted."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for name in os.listdir(root):
        if name not in ("corpus_pipeline.py", "reelrank", ".git"):
            os.symlink(os.path.join(root, name), tmp_path / name)
    os.mkdir(tmp_path / "reelrank")
    for name in os.listdir(os.path.join(root, "reelrank")):
        if name not in ("llm", "__pycache__"):
            os.symlink(os.path.join(root, "reelrank", name), tmp_path / "reelrank" / name)
    os.remove(tmp_path / "__spark_entry__.py")
    with open(os.path.join(root, "__spark_entry__.py")) as f:
        (tmp_path / "__spark_entry__.py").write_text(f.read())
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), e.LLM_QUERIES)"],
                         cwd=tmp_path, capture_output=True, text=True,
                         env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert out.stdout.strip() == f"{len(entry.QUERIES)} {{}}", out.stderr


def test_package_is_shipped_once(spark):
    import zipfile

    from reelrank import session
    session.ship_package(spark)
    session.ship_package(spark)
    assert spark.sparkContext.applicationId in session._SHIPPED
    shipped = [f for f in spark.sparkContext.listFiles if f.endswith("reelrank.zip")]
    assert len(shipped) == 1
    with zipfile.ZipFile(shipped[0].replace("file:", "")) as z:
        names = z.namelist()
    assert "reelrank/operators/similarity.py" in names and "reelrank/__init__.py" in names
