import duckdb
import pytest

import verify
from sifterra.llm import queries as Q

FOUND = {
    "p1_found": ["page_id", "line_no"], "p2_found": ["page_id"], "p3_found": ["cv_id", "field_name"], "p4_found": ["pair_key", "defect"], "p5_found": ["rec_key", "seg_no", "lang"],
    "p7_found": ["chunk_id", "line_no"], "p8_found": ["item_id", "doc_id"], "p10_found": ["doc_id", "reading_level"],
}


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_queries_run_and_give_distinct_rows(spark, sf, name):
    df = Q.queries()[name](spark, sf)
    if name in FOUND:
        assert df.columns == FOUND[name]
        assert df.count() == df.distinct().count() > 0
    else:
        assert df.count() > 0


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_queries_match_their_sql(spark, sf, name):
    from pathlib import Path

    c = duckdb.connect()
    for p in sorted(Path(sf).glob("*.parquet")):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    assert verify.canon(Q.queries()[name](spark, sf).toPandas()) == verify.canon(c.execute(Q.oracle_sql()[name]).df())
