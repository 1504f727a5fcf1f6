import __spark_entry__ as entry


def test_entry(spark):
    got = entry.entry(spark)
    assert got.columns == ["doc_id", "section_id", "toc", "headings", "text", "pages", "block_ids"] and got.count() > 0


def test_every_query_is_named_once():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 50


def test_small_queries_against_duckdb(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "region", "nation", "blocks", "book_tocs", "extracted_tables"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name in ("reading_order", "overlap_pairs", "toc_pipeline", "toc_json", "assign_order", "table_extract", "book_outline", "book_sections", "p3_found"):
        got = entry.queries()[name](spark, sf)
        columns = sorted(got.columns)
        want = con.execute(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
        assert sorted(map(str, map(tuple, got.select(*columns).collect()))) == sorted(map(str, want)), name
