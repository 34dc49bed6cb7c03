"""SRC3-SRC6: views over whatever outputs exist; KPI views whose inputs are
missing are skipped instead of failing; empty folders register nothing."""

import os

from ballotlens.plans.job import extract_all
from ballotlens.sources.catalog import register_kpi_views, register_outputs, register_source_tables


def test_partial_outputs_register_what_exists(spark, tables, tmp_path):
    out = str(tmp_path / "out")
    extract_all(spark, tables, out, only=["epoch_summary"])
    os.makedirs(f"{out}/empty_dataset")                       # empty folder: no view
    for v in ("epoch_summary", "gov_action_lifecycle", "empty_dataset"):
        spark.catalog.dropTempView(v)
    assert register_outputs(spark, out) == ["epoch_summary"]
    views = register_kpi_views(spark)
    assert "kpi_1_3_delegation_rate" in views                 # needs epoch_summary only
    assert "kpi_1_1_voting_turnout" not in views              # lifecycle missing: skipped
    assert spark.table("kpi_1_3_delegation_rate").count() == 25


def test_source_registration_skips_empty_folders(spark, tables, tmp_path):
    src = str(tmp_path / "src")
    tables.committee.write.parquet(f"{src}/committee")        # flat
    tables.pool.write.partitionBy("epoch").parquet(f"{src}/pool")   # hive-partitioned
    os.makedirs(f"{src}/adapot")                               # exported but empty
    names = register_source_tables(spark, src, prefix="t_")
    assert names == ["t_committee", "t_pool"]
    assert spark.table("t_pool").count() == tables.pool.count()
