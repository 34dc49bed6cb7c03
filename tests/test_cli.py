"""The command line over real export folders (hive-partitioned by epoch)."""

from ballotlens.__main__ import main
from ballotlens.sources.fixtures import DERIVATIONS


def test_extract_kpis_views_from_exports(spark, tables, tmp_path, capsys):
    src, out, dest = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "kpi")
    for name in DERIVATIONS:
        df = tables[name]
        if name in ("drep_registration", "stake_registration"):
            df.write.parquet(f"{src}/{name}")                      # flat folders
        else:
            df.write.partitionBy("epoch").parquet(f"{src}/{name}")
    assert main(["extract", "--source", src, "--out", out]) == 0
    assert main(["kpis", "--out", out, "--dest", dest, "--source", src]) == 0
    assert main(["views", "--out", out]) == 0
    text = capsys.readouterr().out
    assert "drep_epoch_stats: 25 epoch(s) written" in text
    assert "p4_9_min_attack_vector: written" in text and "skipped" not in text
    assert "kpi_1_1_voting_turnout:" in text
    assert spark.read.parquet(f"{dest}/k1_1_voting_turnout").count() > 0
