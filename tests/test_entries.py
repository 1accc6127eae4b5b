"""The entry profile from hand-made XML."""

import pytest
from pyspark.sql import functions as F

from assayer.operators.entries import covered_positions, entry_report
from assayer.sources import readers, schemas, writers

XML = """<?xml version="1.0"?>
<entries>
<entry><accession>A1</accession><accession>A2</accession>
  <comment type="function"><text evidence="1">Binds.</text></comment>
  <comment type="pathway"><text>Way.</text></comment><comment type="pathway"/>
  <feature type="chain"><location><begin position="1"/><end position="30"/></location></feature>
  <feature type="site"><location><position position="25"/></location></feature>
  <feature type="site"><location><position position="40"/></location></feature>
  <feature type="odd"><location><begin status="unknown"/><end position="9"/></location></feature>
  <sequence length="100">MK</sequence></entry>
<entry><accession>B1</accession><comment type="function"/></entry>
<entry></entry>
</entries>"""


def test_report_from_xml(spark, tmp_path):
    (tmp_path / "a.xml").write_text(XML)
    entries = readers.read_xml(spark, str(tmp_path), "entry", schemas.ENTRY)
    found = {(r.section, r.label): (r.n, r.pct_entries, r.pct_filled) for r in entry_report(entries).collect()}
    assert found == {
        ("entries", "all"): (3, 100.0, 100),
        ("accessions", "2"): (1, 33.33, 100),
        ("accessions", "1"): (1, 33.33, 100),
        ("accessions", "0"): (1, 33.33, 100),
        ("comment_type", "function"): (2, 66.67, 100),
        ("comment_type", "pathway"): (1, 33.33, 100),
        ("comment_text", "function"): (2, 66.67, 50),
        ("comment_text", "pathway"): (2, 66.67, 50),
        ("comment_types", "function,pathway"): (1, 33.33, 100),
        ("comment_types", "function"): (1, 33.33, 100),
        ("comment_types", ""): (1, 33.33, 100),
        ("feature_type", "chain"): (1, 33.33, 100),
        ("feature_type", "site"): (2, 66.67, 100),
        ("feature_type", "odd"): (1, 33.33, 100),
        ("coverage", "40"): (1, 33.33, 100),
    }


@pytest.mark.parametrize(
    "spans, n", [([], 0), ([(3, 1)], 0), ([(1, 5), (4, 9), (20, 20)], 10), ([(-5, -1), (-3, 2), (None, 4)], 8)]
)
def test_positions_covered_within_a_record(spark, spans, n):
    df = spark.createDataFrame([(spans,)], "s array<struct<begin:bigint,end:bigint>>")
    assert df.select(covered_positions(F.col("s")).alias("n")).first().n == n


def test_xml_files_are_bounded(spark, tmp_path):
    rows = spark.range(50).coalesce(1).select(F.array(F.col("id").cast("string")).alias("accession"))
    writers.save_xml(rows, str(tmp_path / "xml"), "entry", "entries", rows_per_file=10)
    found = readers.read_xml(spark, str(tmp_path / "xml"), "entry", schemas.ENTRY)
    assert len(found.inputFiles()) == 5
    assert sorted(int(r.accession[0]) for r in found.collect()) == list(range(50))
