"""Queries with an SQL form against DuckDB, on the test tables and on awkward rows."""

import duckdb
import pytest

from uvlens.llm.queries import ORACLE, QUERIES


def rows_of(df):
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def sql_rows(con, sql):
    rel = con.execute(sql)
    names = [c[0] for c in rel.description]
    order = [names.index(c) for c in sorted(names)]
    return sorted((tuple(r[i] for i in order) for r in rel.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    got = rows_of(df)
    want = sql_rows(duck, ORACLE[name])
    assert got == want
    assert len(got) > 0


NAN, INF = float("nan"), float("inf")
AWKWARD = {
    "op6_topk_search": ("embeddings", "vec_id bigint, embedding array<float>, score string, v int", [
        (0, [1.0, 2.0], "x", 1), (0, [1.0, 2.0], "x", 1), (1, [1.0, 2.0], None, 1), (2, [1.0, 2.0], None, 2),
        (3, [2.0, 1.0], "", 1), (4, None, "", 1), (5, [NAN, 1.0], "", 1), (6, [INF, 1.0], "", 1), (7, [None, 1.0], "", 1),
        (None, [9.0, 9.0], "", 1), (8, [1.0, 2.0, 3.0], "", 1), (50, [-1.0, 0.003], "", 1), (9, [-7.5, -0.001], "", 1)]),
    "op7_source_mix": ("documents", "doc_id bigint, text string, lang string, source string, n_chars bigint", [
        (1, "a", "en", "src0", 1), (2, None, None, None, None), (3, "", "de", "src1", 0), (1, "a", "en", "src0", 1),
        (None, "x", "en", "src9", 1), (None, None, None, "src0", 1)] + [
        (k, "t" * k, "en", "src0" if k % 3 else "src2", k) for k in range(10, 80)]),
    "op8_chat_format": ("conversations", "conv_id bigint, turn bigint, role string, text string", [
        (1, 0, "user", None), (1, 1, "assistant", "a & b &amp; <|end|> &lt;|"), (1, 2, "assistant", ""), (1, 3, "user", "x"),
        (2, 5, None, "[INST]<<SYS>>"), (2, 5, None, "[INST]<<SYS>>"), (2, None, "system", "<|more|><s>"),
        (None, 0, "assistant", "ö🙂\n"), (3, 1, "<|turn|>", "y" * 100_000), (3, 0, "assistant", "&"), (4, 0, "user", "q")]),
    "op10_warc": ("pages", "page_id bigint, url string, html string, payload string", [
        (1, "http://a/\r\nX: y", "z" * 1000, "p"), (2, None, "z" * 1000, "p"), (3, "", "z" * 999, None),
        (4, "u", "z" * 999, None), (5, "u", None, None), (6, "u", "", None), (7, "ü", "ö" * 500, None),
        (8, "u", "ö" * 500, None), (9, "u", "\r\n\r\n" * 400_000, None)]),
}


@pytest.mark.parametrize("name", sorted(AWKWARD))
def test_awkward_rows(spark, table_dir, name):
    table, schema, rows = AWKWARD[name]
    folder = table_dir((table, rows, schema))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    assert rows_of(QUERIES[name](spark, folder)) == sql_rows(con, ORACLE[name])


@pytest.mark.parametrize("name", sorted(AWKWARD))
def test_empty_tables(spark, table_dir, name):
    table, schema, _ = AWKWARD[name]
    got = QUERIES[name](spark, table_dir((table, [], schema))).collect()
    assert len(got) == (1 if name == "op8_chat_format" else 0)
