from __future__ import annotations

import pytest
from conftest import MAIL_A

from lettermill.__main__ import main
from lettermill.plans.ingest import RunStats


def test_run_and_rerun(spark, bucket, capsys):
    bucket.put(MAIL_A, "x.eml")
    args = ["run", "--bucket", str(bucket), "--state", bucket.state]
    assert main([*args, "--mode", "backfill"]) == 0
    assert capsys.readouterr().out.strip().splitlines()[-1] == (
        "mode=backfill scanned=1 new=1 changed=0 unchanged=0 metadata_only=0 failed=0 "
        "emails_staged=1 relinked=0 skipped=0"
    )
    assert main(args) == 0
    out = capsys.readouterr().out
    assert "mode=incremental" in out and "unchanged=1" in out and "emails_staged=0" in out
    assert main(["compact", "--state", bucket.state]) == 0


def test_missing_bucket(tmp_path):
    assert main(["run", "--bucket", str(tmp_path / "no"), "--state", str(tmp_path / "s")]) == 2


def test_command_is_required():
    with pytest.raises(SystemExit) as stop:
        main([])
    assert stop.value.code == 2


def test_stats_frame(spark):
    row = RunStats(files_scanned=3, skipped=1).frame(spark).first()
    assert (row.files_scanned, row.skipped, row.emails_staged) == (3, 1, 0)
