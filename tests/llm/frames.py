"""Small tables with every awkward case, and rows of the given ones."""

import duckdb

SMALL = "/root/testdata/sf0.001"

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row long, found string, part string, value string"


def documents(spark, rows):
    """Documents of (doc_id, text) or (doc_id, text, lang, source), with columns whose names clash."""
    filled = [(*r, "en", "src0")[:4] if len(r) == 2 else r for r in rows]
    return spark.createDataFrame([(i, t, lang, source, len(t or ""), 1, "x", "y", "z") for i, t, lang, source in filled], DOCS)


def given(table, folder=SMALL):
    """Rows of a given table as dictionaries, read without Spark."""
    answer = duckdb.sql(f"SELECT * FROM '{folder}/{table}.parquet'")
    names = answer.columns
    return [dict(zip(names, row, strict=True)) for row in answer.fetchall()]


def written(tmp_path, **tables):
    """A folder as the queries take it, with the given DataFrames as its tables."""
    for name, frame in tables.items():
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)
