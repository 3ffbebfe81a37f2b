"""Filtering rows by a set of ids, as bitmaps and by a shuffle."""

from __future__ import annotations

import pytest

from streamwatch.llm import common

ROWS = [None, -(2**63), -(10**12), -32769, -32768, -5, 0, 1, 7, 8, 9, 32767, 32768, 32769, 65536, 65537, 65537, 10**15, 2**63 - 1]
SETS = [[], [None], [65537, 65537, None, -5, 8, 32768], [0, -32768, -(2**63), 2**63 - 1, 10**15], ROWS]


@pytest.mark.parametrize("bitmaps", [common.BITMAPS, 0])
@pytest.mark.parametrize("ids", SETS, ids=range(len(SETS)))
def test_ids_decide_as_a_plain_set_does(spark, monkeypatch, ids, bitmaps):
    monkeypatch.setattr(common, "BITMAPS", bitmaps)
    rows = spark.createDataFrame([(x, str(x), "", "") for x in ROWS], "doc_id long, bucket string, bits string, number string")
    wanted = spark.createDataFrame([(x,) for x in ids], "text_id long")
    known = set(ids) - {None}
    for among in (True, False):
        found = common.rows_by_id(rows, "doc_id", wanted, among=among)
        assert found.columns == rows.columns
        assert sorted(row.bucket for row in found.collect()) == sorted(str(x) for x in ROWS if (x in known) == among)


@pytest.mark.parametrize("bitmaps", [common.BITMAPS, 0])
def test_marks_are_those_of_a_plain_set(spark, monkeypatch, bitmaps):
    monkeypatch.setattr(common, "BITMAPS", bitmaps)
    rows = spark.createDataFrame([(x, str(x)) for x in ROWS], "doc_id long, bits string")
    wanted = spark.createDataFrame([(x,) for x in SETS[2]], "doc_id long")
    found = common.marked_by_id(rows, "doc_id", wanted, "mark").collect()
    assert sorted((row.bits, row.mark) for row in found) == sorted((str(x), x in set(SETS[2]) - {None}) for x in ROWS)
    named = common.marked_by_id(rows, "bits", wanted.selectExpr("string(doc_id) as doc_id"), "mark").collect()
    assert sorted(map(str, (row.mark for row in named))) == sorted(map(str, (row.mark for row in found)))
