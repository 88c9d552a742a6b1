import duckdb
import pytest

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def documents():
    """``doc_id -> text`` of the whole table."""
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall())


@pytest.fixture
def stored_docs(spark, tmp_path):
    """Rows as a stored table, with columns whose names may clash."""

    def store(rows, schema="doc_id long, text string", extra=True, parts=3):
        df = spark.createDataFrame(rows, schema).repartition(parts)
        if extra:
            for name in ("key", "row", "t", "class", "score", "kind", "block", "words", "x", "pii", "secrets"):
                df = df.selectExpr("*", f"'extra' AS `{name}`")
        path = str(tmp_path / f"docs{store.n}")
        store.n += 1
        df.write.parquet(path)
        return spark.read.parquet(path)

    store.n = 0
    return store
