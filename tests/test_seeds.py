"""Malformed seed lines are kept apart with what is wrong with them."""

import pytest

from tillbook.session import run_folder
from tillbook.sources.seeds import load_seed
from tillbook.sources.tables import read_landed

HEADER = "campaign_id,campaign_name,channel,campaign_type,budget_usd,started_at,ended_at\n"
GOOD = ["CMP_0001,Retention Podcast Q3,podcast,retention,10000,2025-08-06T00:00:00,2025-09-30T00:00:00", 'CMP_0002,"Brand, Email",email,brand,,2025-01-01T00:00:00,']
BAD = {
    "CMP_0003,Bad,email,brand,many,2025-01-01T00:00:00,": "budget_usd",
    "CMP_0004,Short,email": "3 fields instead of 7",
    "CMP_0005,Dates,email,brand,5,yesterday,tomorrow": "started_at",
    "CMP_0006,Long,email,brand,5,2025-01-01T00:00:00,,more,and more": "9 fields instead of 7",
}


def write(tmp_path, lines):
    path = tmp_path / "raw_marketing_campaigns.csv"
    path.write_text(HEADER + "\n".join(lines) + "\n")
    return str(path)


def test_bad_rows_are_kept_apart(spark, tmp_path):
    lines = [GOOD[0], *BAD, GOOD[1]]
    folder = run_folder(spark, "test-quarantine")
    load_seed(spark, write(tmp_path, lines), "raw_marketing_campaigns", f"{folder}/raw", f"{folder}/bad")
    rows = read_landed(spark, f"{folder}/raw", "raw_marketing_campaigns").orderBy("campaign_id").collect()
    assert [(r.campaign_id, r.campaign_name, r.budget_usd, r.ended_at is None) for r in rows] == [("CMP_0001", "Retention Podcast Q3", 10000, False), ("CMP_0002", "Brand, Email", None, True)]
    kept = {r.bad_line: r for r in spark.read.parquet(f"{folder}/bad/raw_marketing_campaigns").collect()}
    assert set(kept) == set(BAD)
    for line, reason in BAD.items():
        assert reason in kept[line].reason and kept[line].file.endswith("raw_marketing_campaigns.csv")
    assert "ended_at" in kept["CMP_0005,Dates,email,brand,5,yesterday,tomorrow"].reason

    # mended, it loads, and nothing is left in quarantine
    load_seed(spark, write(tmp_path, GOOD), "raw_marketing_campaigns", f"{folder}/raw", f"{folder}/bad")
    assert spark.read.parquet(f"{folder}/bad/raw_marketing_campaigns").count() == 0


def test_without_a_quarantine_the_load_fails(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)malformed|many"):
        load_seed(spark, write(tmp_path, [*GOOD, *BAD]), "raw_marketing_campaigns", run_folder(spark, "test-quarantine"))


def test_empty_files(spark, tmp_path):
    folder = run_folder(spark, "test-quarantine")
    load_seed(spark, write(tmp_path, []), "raw_marketing_campaigns", f"{folder}/raw", f"{folder}/bad")
    assert spark.read.parquet(f"{folder}/bad/raw_marketing_campaigns").count() == 0
