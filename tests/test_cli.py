"""The command-line driver: seed, daily (append + build) twice, check."""

import json
import os
import subprocess
import sys

import pyspark
import pytest

from tests.conftest import ROOT, SF_SMALL
from tillbook.__main__ import main
from tillbook.session import run_folder, storage_root


def _json_lines(text):
    return [json.loads(line) for line in text.splitlines() if line.startswith(("{", "["))]


def test_seed_append_and_check(spark, capsys):
    raw_dir = run_folder(spark, "test-cli") + "/raw"
    main(["seed", "--source-dir", SF_SMALL, "--raw-dir", raw_dir])
    day = ["--as-of", "2001-08-01 06:00:00"]
    main(["append", "--source-dir", SF_SMALL, "--raw-dir", raw_dir, *day])
    main(["append", "--source-dir", SF_SMALL, "--raw-dir", raw_dir, *day])
    main(["append", "--source-dir", SF_SMALL, "--raw-dir", raw_dir])  # the wall clock: another day
    out = _json_lines(capsys.readouterr().out)
    first, second, third = out[1:4]
    assert [r["appended"] for r in first] == [100, 75, 150]
    assert all(r["skipped_existing"] for r in second)
    assert [r["appended"] for r in third] == [100, 75, 150]

    main(["check", "--source-dir", SF_SMALL])
    failures = _json_lines(capsys.readouterr().out)
    # the driver data repeats (order, line number) pairs, so this check fails by design
    assert [(f["table_name"], f["column_name"], f["test_name"]) for f in failures] == [
        ("stg_order_items", "order_item_id", "unique")
    ]


def test_submitted_settings_stay(tmp_path):
    """spark-submit's own values win, and the number of shuffle partitions is never touched."""
    script = tmp_path / "show.py"
    script.write_text(
        "from tillbook.session import get_session\n"
        "s = get_session()\n"
        "print('SET', s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.sql.files.maxPartitionBytes'), s.conf.get('spark.sql.ansi.enabled'))\n"
    )
    submit = os.path.join(os.path.dirname(pyspark.__file__), "bin", "spark-submit")
    confs = ["spark.sql.shuffle.partitions=20000", "spark.sql.files.maxPartitionBytes=64m", "spark.ui.enabled=false"]
    env = {k: v for k, v in os.environ.items() if not k.startswith("PYSPARK_GATEWAY")} | {"PYTHONPATH": ROOT, "PYSPARK_PYTHON": sys.executable, "PYSPARK_DRIVER_PYTHON": sys.executable}
    said = subprocess.run([submit, "--master", "local[1]", *(x for c in confs for x in ("--conf", c)), str(script)], capture_output=True, text=True, env=env, timeout=120)
    assert "SET 20000 64m true" in said.stdout, said.stderr[-2000:]


def test_no_machine_local_folder_on_a_cluster():
    class Context:
        master = "spark://head:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage_root(Session())
