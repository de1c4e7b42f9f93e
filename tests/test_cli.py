"""The command line drives the daily job and the routing report."""

import json
import os
import tempfile

from snapreel.__main__ import main
from snapreel.sources import versions as VT


def _write(path, *docs):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.json"), "w") as f:
        for d in docs:
            f.write(json.dumps(d) + "\n")


def test_cli_daily_then_route(spark):
    base = tempfile.mkdtemp(prefix="snapreel-cli-")
    _write(f"{base}/land/trending", {"media_type": "all", "time_window": "day", "snapshot_date": "2024-03-02",
                                     "load_ts": "2024-03-02T05:00:00+00:00",
                                     "results": [{"id": 1, "media_type": "movie", "title": "One"}]})
    _write(f"{base}/land/details", {"media_type": "movie", "tmdb_id": 1, "load_ts": "2024-03-02T06:00:00+00:00",
                                    "data": {"title": "One!", "genres": [{"id": 1, "name": "Drama"}]}})
    _write(f"{base}/land/credits", {"media_type": "movie", "tmdb_id": 1, "load_ts": "2024-03-02T06:00:00+00:00",
                                    "data": {"cast": [{"id": 1, "name": "A", "order": 0}],
                                             "crew": [{"id": 2, "name": "B", "job": "Director"}]}})
    common = ["--store", f"{base}/store", "--raw", f"{base}/raw", "--marts", f"{base}/marts"]
    rc = main(["daily", *common, "--date", "2024-03-02", "--today", "2024-03-02",
               "--trending-landing", f"{base}/land/trending", "--details-landing", f"{base}/land/details",
               "--credits-landing", f"{base}/land/credits", "--media-type-from", "item"])
    assert rc == 0
    dim = VT.read(spark, f"{base}/marts/dim_content").collect()
    assert [(r.title, r.director_name, r.top_cast, r.genres) for r in dim] == [("One!", "B", "A", "Drama")]
    assert main(["route", "--store", f"{base}/store", "--from", "2024-03-02", "--to", "2024-03-02",
                 "--today", "2024-03-05"]) == 0
    assert main(["route", "--store", f"{base}/store", "--from", "2024-03-01", "--to", "2024-03-02",
                 "--today", "2024-03-05"]) == 1
    assert main(["build", "--raw", f"{base}/raw", "--marts", f"{base}/marts2"]) == 0


def test_cli_test_and_sql(spark, capsys):
    base = tempfile.mkdtemp(prefix="snapreel-cli2-")
    _write(f"{base}/land/trending", {"media_type": "all", "time_window": "day", "snapshot_date": "2024-03-02",
                                     "load_ts": "2024-03-02T05:00:00+00:00",
                                     "results": [{"id": 1, "media_type": "movie", "title": "One"}]})
    common = ["--raw", f"{base}/raw", "--marts", f"{base}/marts"]
    assert main(["daily", "--store", f"{base}/store", *common, "--date", "2024-03-02",
                 "--today", "2024-03-02", "--trending-landing", f"{base}/land/trending"]) == 1    # no details yet
    assert main(["daily", "--store", f"{base}/store", *common, "--date", "2024-03-02",
                 "--today", "2024-03-02", "--allow-incomplete"]) == 0
    assert main(["test", *common]) == 0
    assert main(["sql", *common, "SELECT count(*) AS n FROM dim_content JOIN fct_trending_daily USING (tmdb_id)"]) == 0
    assert main(["sql", *common, "SELECT count(*) AS n FROM raw.tmdb_trending_raw WHERE (SELECT count(*) FROM marts.dim_content) = 1"]) == 0
    assert "|1  |" in capsys.readouterr().out


def test_cli_checks_report_old_faults_unless_scoped(spark, capsys):
    base = tempfile.mkdtemp(prefix="snapreel-cli3-")
    common = ["--store", f"{base}/store", "--raw", f"{base}/raw", "--marts", f"{base}/marts", "--allow-incomplete"]
    for day, item in (("2024-03-01", {"id": None, "title": "no id"}), ("2024-03-02", {"id": 2, "title": "ok"})):
        _write(f"{base}/land/{day}", {"media_type": "all", "time_window": "day", "snapshot_date": day,
                                      "load_ts": f"{day}T05:00:00+00:00", "results": [item]})
    assert main(["daily", *common, "--date", "2024-03-01", "--today", "2024-03-01",
                 "--trending-landing", f"{base}/land/2024-03-01"]) == 1      # the fault is new
    assert main(["daily", *common, "--date", "2024-03-02", "--today", "2024-03-02",
                 "--trending-landing", f"{base}/land/2024-03-02"]) == 1      # still stored, still reported
    assert main(["daily", *common, "--date", "2024-03-02", "--today", "2024-03-02",
                 "--scoped-checks"]) == 0                                    # asked for: only the new day
