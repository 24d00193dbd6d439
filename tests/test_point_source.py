"""Points through the data source: commits, aborted jobs, retried tasks."""

import json

import pytest

import gridstats as gs
from gridstats.sinks import source

from conftest import tuples


@pytest.fixture
def points(random_readings):
    return gs.zone_year_points(gs.zone_year_stats(random_readings, sort=False), "app").repartition(4)


def test_files_and_counts(spark, points, tmp_path):
    path = str(tmp_path / "p")
    gs.save_points(points, path, batch_size=3)
    assert sorted(tuples(gs.read_lines(spark, path))) == sorted(tuples(gs.points_to_lines(points)))
    commits = gs.read_commits(spark, path).collect()
    assert sum(c.n_points for c in commits) == points.count() == 18
    assert all(c.n_batches == -(-c.n_points // 3) for c in commits) and len({c.job for c in commits}) == 1
    assert not list((tmp_path / "p" / "pending").iterdir())
    gs.save_points(points.limit(2), path)
    assert gs.read_lines(spark, path).count() == 20
    gs.save_points(points.limit(2), path, mode="overwrite")
    assert gs.read_lines(spark, path).count() == 2
    assert sum(c.n_points for c in gs.read_commits(spark, path).collect()) == 2


def test_plain_writer_of_a_data_frame(spark, points, tmp_path):
    spark.dataSource.register(source.PointSink)
    lines = gs.points_to_lines(points)
    lines.write.format(gs.POINT_FORMAT).mode("append").option("path", str(tmp_path / "p")).save()
    assert gs.read_lines(spark, str(tmp_path / "p")).count() == 18
    with pytest.raises(Exception, match="path is missing"):
        lines.write.format(gs.POINT_FORMAT).mode("append").save()
    with pytest.raises(Exception, match="batch_size"):
        gs.save_points(points, str(tmp_path / "p"), batch_size=0)


def test_a_failed_task_aborts_the_job(spark, points, tmp_path):
    path = str(tmp_path / "p")
    gs.save_points(points, path)

    def boom(batches):
        for batch in batches:
            yield batch
        from pyspark import TaskContext

        if TaskContext.get().partitionId() == 2:
            raise RuntimeError("a task is lost")

    broken = points.mapInArrow(boom, points.schema)
    with pytest.raises(Exception, match="a task is lost"):
        gs.save_points(broken, path)
    assert gs.read_lines(spark, path).count() == 18 and gs.read_commits(spark, path).select("job").distinct().count() == 1
    assert not list((tmp_path / "p" / "pending").iterdir())


def test_a_retried_task_counts_once(spark, points, tmp_path):
    path, mark = str(tmp_path / "p"), str(tmp_path / "mark")

    def once(batches):
        import os

        from pyspark import TaskContext

        yield from batches
        if TaskContext.get().partitionId() == 1 and not os.path.exists(mark):
            open(mark, "w").close()
            raise RuntimeError("first attempt")

    gs.save_points(points.mapInArrow(once, points.schema), path)
    assert gs.read_lines(spark, path).count() == 18
    assert sum(c.n_points for c in gs.read_commits(spark, path).collect()) == 18


def test_a_client_gets_batches(spark, points, tmp_path):
    folder = tmp_path / "sent"
    folder.mkdir()
    out = str(folder)

    def open_writer():
        import uuid

        class Client:
            def write(self, batch):
                with open(f"{out}/{uuid.uuid4().hex}", "w") as f:
                    json.dump([[p["measurement"], p["tags"], p["fields"], p["time_ms"]] for p in batch], f)

            def close(self):
                pass

        return Client()

    gs.save_points(points, str(tmp_path / "p"), open_writer, batch_size=4)
    batches = [json.loads(p.read_text()) for p in folder.iterdir()]
    assert all(1 <= len(b) <= 4 for b in batches)
    sent = sorted((m, sorted(t.items()), sorted(f.items()), at) for b in batches for m, t, f, at in b)
    assert sent == sorted(
        (r.measurement, sorted(r.tags.items()), sorted(r.fields.items()), r.time_ms) for r in points.collect()
    )
    commits = gs.read_commits(spark, str(tmp_path / "p")).collect()
    assert sum(c.n_points for c in commits) == 18 and sum(c.n_batches for c in commits) == len(batches)


def test_no_points(spark, points, tmp_path):
    path = str(tmp_path / "p")
    gs.save_points(points.limit(0), path)
    assert gs.read_commits(spark, path).where("n_points > 0").count() == 0
