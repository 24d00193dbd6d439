"""Folders for tables between jobs."""

from pathlib import Path

import gridstats as gs
from gridstats.shared import kept, new_folder, scratch

from conftest import tuples


def local(folder):
    return Path(folder.removeprefix("file:"))


def test_tables_of_a_block_go_with_it(spark, random_readings, tmp_path):
    expected = tuples(gs.zone_year_stats(random_readings))
    with scratch(spark) as folder:
        once = kept(random_readings)
        assert new_folder(spark).startswith(f"{folder}/")
        gs.zone_year_stats_joined(once).write.parquet(str(tmp_path / "out"))
        with scratch(spark) as inner:
            kept(random_readings.limit(3)).count()
            assert inner.startswith(f"{folder}/")
        assert not local(inner).exists()
        assert len(list(local(folder).iterdir())) == 2
    assert not local(folder).exists() and not new_folder(spark).startswith(folder)
    assert len(tuples(spark.read.parquet(str(tmp_path / "out")))) == len(expected)


def test_a_failed_block_leaves_nothing(spark):
    try:
        with scratch(spark) as folder:
            kept(spark.range(3))
            raise KeyError
    except KeyError:
        pass
    assert not local(folder).exists()
