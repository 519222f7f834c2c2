from pyspark.sql import functions as F

from riskframe.operators import smote as sm
from riskframe.sources import registry as reg


def _points(spark):
    rows = [(i, 0 if i % 4 else 1, [float((i * 37) % 17), float((i * 11) % 13), float(i % 5)]) for i in range(120)]
    return spark.createDataFrame(rows, "id long, y int, v array<double>")


def test_knn_exact_against_brute_force(spark):
    df = _points(spark)
    got = {(r.id, r.nn_rank): r.nn_id for r in sm.knn_within_class(df, "id", "y", "v", k=3, cell_rows=4).collect()}
    pts = [(r.id, r.y, r.v) for r in df.collect()]
    for i, y, v in pts:
        cands = sorted(((sum((a - b) ** 2 for a, b in zip(v, w)) ** 0.5, j) for j, yy, w in pts if yy == y and j != i))
        for rank, (_, j) in enumerate(cands[:3], 1):
            assert got[(i, rank)] == j


def test_oversample_balances_and_interpolates(spark):
    df = _points(spark)
    out = sm.oversample(df, "id", "y", "v", k=3)
    counts = {r.y: r["count"] for r in out.groupBy("y").count().collect()}
    assert counts[0] == counts[1] == 90
    orig = {str(r.id): r.v for r in df.collect()}
    for r in out.where("synthetic").collect():
        a, b, g = orig[r.base_id], orig[r.nn_id], r.gap
        assert 0 <= g < 1
        assert all(abs(x - (p + g * (q - p))) < 1e-9 for x, p, q in zip(r.v, a, b))


def test_next_version_skips_non_numeric(spark):
    names = spark.createDataFrame([("model_v1",), ("model_v10",), ("model_vx",)], "name string")
    assert reg.next_version(names, "name", "model_v").first()[0] == 11
    empty = spark.createDataFrame([("other",)], "name string")
    assert reg.next_version(empty, "name", "model_v").first()[0] == 1


def test_stream_append_equals_batch(spark, tmp_path):
    from riskframe.operators import validate as val
    from riskframe.plans.queries import EVENT_RULES
    from riskframe.streaming.jobs import stream_append

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src = str(tmp_path / "src")
    ev.write.parquet(src)
    out, quar, _ = stream_append(spark, src, ev.schema, EVENT_RULES, str(tmp_path / "out"), str(tmp_path / "q"))
    ok, bad = val.quarantine_split(ev, EVENT_RULES)
    from riskframe.streaming.jobs import read_landed

    assert sorted(read_landed(spark, out).collect()) == sorted(ok.collect())
    assert read_landed(spark, quar).count() == bad.count()


def test_second_stream_run_lands_what_came_since(spark, tmp_path):
    from riskframe.plans.queries import EVENT_RULES
    from riskframe.streaming.jobs import read_landed, stream_append

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").where("event_type = 'view'").limit(20).persist()
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    rows = sorted(ev.collect())
    spark.createDataFrame(rows[:10], ev.schema).write.parquet(src)
    stream_append(spark, src, ev.schema, (), out)
    spark.createDataFrame(rows[10:], ev.schema).write.mode("append").parquet(src)
    _, _, query = stream_append(spark, src, ev.schema, (), out)
    assert sorted(read_landed(spark, out).collect()) == rows and not query.isActive


def test_batch_run_again_after_a_death_lands_once(spark, tmp_path, monkeypatch):
    """A death between the write and the listing shows no rows; the batch run again lands them once."""
    import pytest

    from riskframe.streaming import jobs as sj

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(20).persist()
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    ev.write.parquet(src)

    def dies(*_):
        raise OSError("died")

    with monkeypatch.context() as m:
        m.setattr(sj, "_enlist", dies)
        with pytest.raises(Exception):
            sj.stream_append(spark, src, ev.schema, (), out)
    with pytest.raises(FileNotFoundError):
        sj.read_landed(spark, out)
    sj.stream_append(spark, src, ev.schema, (), out)
    assert sorted(sj.read_landed(spark, out).collect()) == sorted(ev.collect())
    assert len(list((tmp_path / "out" / "batch_id=0").iterdir())) == 2  # one run's folder isn't listed


def test_unreadable_registry_is_not_taken_for_an_empty_one(spark, tmp_path):
    import pytest

    class Model:
        saved = 0

        def save(self, path):
            Model.saved += 1
            spark.range(1).write.parquet(path)

    root = str(tmp_path / "models")
    assert [reg.save_model(spark, root, Model(), "m", 1, {}) for _ in range(2)] == [1, 2]
    for f in (tmp_path / "models" / "_registry").glob("*.json"):
        f.write_bytes(b"no commit")
    with pytest.raises(Exception):
        reg.registry(spark, root).collect()
    with pytest.raises(FileExistsError):
        reg.save_model(spark, root, Model(), "m", 1, {}, version=1)
    assert Model.saved == 2 and reg.save_model(spark, root, Model(), "m", 1, {}) == 3


class _Saved:
    def save(self, path):
        from pyspark.sql import SparkSession

        SparkSession.getActiveSession().range(1).write.parquet(path)


def test_two_writers_get_two_versions(spark, tmp_path, monkeypatch):
    """The second writer commits between the first one's look at the numbers and its claim."""
    root, real, rivals = str(tmp_path / "models"), reg._claim, []

    def beaten(spark_, root_, version, line):
        if not rivals:
            rivals.append(version)
            assert real(spark_, root_, version, line.replace('"first"', '"rival"'))
        return real(spark_, root_, version, line)

    monkeypatch.setattr(reg, "_claim", beaten)
    assert reg.save_model(spark, root, _Saved(), "first", 1, {}) == 2
    assert [(r.version, r.model_type) for r in reg.list_versions(spark, root).collect()] == [(1, "rival"), (2, "first")]


def test_a_save_that_dies_blocks_nothing(spark, tmp_path, monkeypatch):
    """Death while the model, the state or the claim is written: no version, and the next save works."""
    import pytest

    root = str(tmp_path / "models")

    class Dies:
        def save(self, path):
            _Saved().save(path)
            raise OSError("died")

    def dies(*_):
        raise OSError("died")

    with pytest.raises(OSError):
        reg.save_model(spark, root, Dies(), "m", 1, {})
    with pytest.raises(OSError):
        reg.save_model(spark, root, _Saved(), "m", 1, {}, save_state=dies)
    with monkeypatch.context() as m:
        m.setattr(reg.os, "link", dies)
        with pytest.raises(OSError):
            reg.save_model(spark, root, _Saved(), "m", 1, {})
    assert reg.latest_version(spark, root) is None and reg.registry(spark, root).count() == 0
    with pytest.raises(FileNotFoundError):
        reg.version_path(spark, root)
    assert [reg.save_model(spark, root, _Saved(), "m", n, {"best_x": n}) for n in (1, 2)] == [1, 2]
    assert [r.n_rows for r in reg.list_versions(spark, root).collect()] == [1, 2]
    assert reg.metrics_json(spark, root) == {"best_x": 2} and reg.metrics_json(spark, root, 1) == {"best_x": 1}


def test_class_of_one_row(spark):
    import pytest

    df = spark.createDataFrame([(i, 0, [float(i), 1.0]) for i in range(6)] + [(9, 1, [5.0, 5.0])], "id long, y int, v array<double>")
    with pytest.raises(ValueError, match="one row"):
        sm.oversample(df, "id", "y", "v", k=2)
    out = sm.oversample(df, "id", "y", "v", k=2, copy_single=True)
    assert {tuple(r.v) for r in out.where("y = 1").collect()} == {(5.0, 5.0)} and out.where("y = 1").count() == 6


def test_neighbours_of_an_empty_table(spark):
    df = spark.createDataFrame([], "id long, label int, v array<double>")
    assert sm.knn_within_class(df, "id", "label", "v").collect() == []


def test_knn_of_wide_vectors_ties_and_repeated_ids(spark):
    """Blocks of any size give what brute force over all rows gives, whatever repeats or is missing."""
    import random

    rng = random.Random(3)
    rows = [(i, i % 2, [rng.gauss(0, 1) for _ in range(9)]) for i in range(150)]
    rows += [(200 + i, 0, [5.0] * 9) for i in range(12)] + rows[:10] + [(None, 0, [5.0] * 9), (300, None, [5.0] * 9), (301, 0, None), (302, 1, [None] + [5.0] * 8)]
    df = spark.createDataFrame(rows, "id long, y int, v array<double>").repartition(5)
    good = [r for r in rows if r[0] is not None and r[1] is not None and r[2] is not None and None not in r[2]]
    want = {}
    for i, y, v in good:
        want.setdefault(i, []).extend((sum((a - b) ** 2 for a, b in zip(v, w)) ** 0.5, j) for j, yy, w in good if yy == y and j != i)
    want = sorted((i, rank, j, round(d, 9)) for i, near in want.items() for rank, (d, j) in enumerate(sorted(near)[:4], 1))
    for cell_rows in (7, 40, 4096):
        got = sm.knn_within_class(df, "id", "y", "v", k=4, cell_rows=cell_rows).collect()
        assert sorted((r.id, r.nn_rank, r.nn_id, round(r.distance, 9)) for r in got) == want
