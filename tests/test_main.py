from __future__ import annotations

from uuid import uuid4

import pytest

from tests.rows import VALID, raw_rows
from tests.test_silver import trip
from tripline.__main__ import main
from tripline.contract import PUBLISHED_FILE, TRIP_COLUMNS
from tripline.operators import QualityError


def test_commands(spark, tmp_path, capsys):
    published, landing = str(tmp_path / "published"), str(tmp_path / "landing")
    tables = ["--database", f"test_{uuid4().hex}", "--location", str(tmp_path / "lake")]

    def publish(month, *trips):
        raw_rows(spark, *trips).select(*TRIP_COLUMNS).write.mode("overwrite").parquet(
            PUBLISHED_FILE % (published, 2023, month))

    may = trip("2023-05-05 07:00:00", "2023-05-05 08:00:00") | {"passenger_count": 3.0}
    publish(3, VALID, VALID | {"total_amount": 20.0})
    publish(5, may)
    fetch = ["ingest", "--published", published, "--landing", landing, "--manifest", str(tmp_path / "manifest")]
    main([*fetch, "--months", "3", "5"])
    main(["build", "--landing", landing, "--months", "3", "5", "--trips-as", "view", *tables])
    out = capsys.readouterr().out
    assert "|       2023|           3|            15.0|         2|" in out
    assert "|          7|                3.0|         1|" in out

    publish(5, may, may | {"passenger_count": 4.0})
    main([*fetch, "--months", "5", "--overwrite"])
    main(["replace", "--landing", landing, "--months", "5", "--trips-as", "view", *tables])
    main(["answer", *tables])
    assert capsys.readouterr().out.count("|          7|                3.5|         2|") == 2
    main(["replace", "--landing", landing, "--months", "5", "--hourly", "2023", "3", "--trips-as", "view", *tables])
    assert "|         10|                1.0|         2|" in capsys.readouterr().out
    assert spark.read.parquet(str(tmp_path / "manifest")).count() == 3
    with pytest.raises(QualityError, match="files not landed.*'month': 6"):
        main([*fetch, "--months", "3", "6"])
