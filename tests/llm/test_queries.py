import pytest

from recordloom.llm import queries as Q

COLUMNS = {"p1_found": ["group_id", "field_name", "record_id"], "p2_found": ["prop_id", "field_name", "term_id"], "p4_found": ["field_name", "name_1", "name_2"], "p8_found": ["doc_id", "item_id"], "p9_found": ["doc_id", "start_pos", "end_pos"]}


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_runs_without_duplicates(spark, small, name):
    df = Q.queries()[name](spark, small)
    assert df.columns == COLUMNS.get(name, df.columns)
    rows = [tuple(r) for r in df.collect()]
    assert rows and len(rows) == len(set(rows))
