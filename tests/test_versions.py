"""Layers under failure: at every step a table is the old or the new one, and a layer is of one run."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.errors import PySparkException

from starsmelt.sources import Layer, Layout, RowCountMismatch, TableMissing, folders, tables

NAMES = [f"t{k}" for k in range(3)]


class Killed(BaseException):
    """A writer that goes away: nothing may rely on its handlers."""


def frames(spark, run, rows=20):
    return {name: spark.range(rows).selectExpr("id", f"{run} AS run") for name in NAMES}


LAYOUTS = {"t0": Layout("id", (), 2), "t1": Layout("id", ("run",), 3)}


@pytest.fixture
def layer(spark, tmp_path):
    schema = f"v_{tmp_path.name.replace('-', '_')}"[:60]
    layer = Layer(spark, schema, str(tmp_path))
    layer.write(frames(spark, 1), LAYOUTS)
    yield layer
    spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")


def runs(layer, through=None):
    """The run that every table is of."""
    if through == "catalog":
        read = lambda name: layer.spark.table(f"{layer.schema}.{name}")
    else:
        now = (through or layer).current()
        read = lambda name: (through or layer).read(name, now)
    found = {}
    for name in NAMES:
        rows = [tuple(r) for r in read(name).collect()]
        assert sorted(r[0] for r in rows) == list(range(20))
        (found[name],) = {r[1] for r in rows}
    return found


def data_folders(layer, tmp_path):
    return {str(p.relative_to(tmp_path / layer.schema)) for p in (tmp_path / layer.schema).glob("t*/*")}


def other_application(layer, tmp_path):
    """A reader that shares the folder only."""
    layer.spark.sql(f"DROP SCHEMA {layer.schema} CASCADE")
    return Layer(layer.spark, layer.schema, str(tmp_path))


STEPS = ["_stage", "put_new", "_register", "_swap_view", "_discard", "remove"]


@pytest.mark.parametrize("call", [0, 1, 2])
@pytest.mark.parametrize("step", STEPS)
def test_a_writer_killed_at_any_step_leaves_one_run(spark, layer, tmp_path, monkeypatch, step, call):
    layer.write(frames(spark, 2), LAYOUTS)  # so that the next one also retires versions
    owner = folders if step in ("put_new", "remove") else Layer
    done, plain = [0], getattr(owner, step)

    def killed(*args, **options):
        done[0] += 1
        if done[0] > call:
            raise Killed(step)
        return plain(*args, **options)

    writer = Layer(spark, layer.schema, str(tmp_path))
    monkeypatch.setattr(owner, step, killed)
    try:
        writer.write(frames(spark, 3), LAYOUTS, at_once=1)
    except Killed:
        pass
    monkeypatch.undo()
    assert set(runs(layer).values()) in ({2}, {3})
    assert set(runs(layer, "catalog").values()) <= {2, 3}
    if done[0] <= call:
        assert set(runs(layer).values()) == {3}
    now = runs(layer)
    layer.sync()
    assert runs(layer, "catalog") == now
    reader = other_application(layer, tmp_path)
    assert runs(layer, reader) == now
    reader.write(frames(spark, 4), LAYOUTS)
    assert set(runs(reader).values()) == set(runs(reader, "catalog").values()) == {4}


def test_only_two_runs_are_kept(spark, layer, tmp_path):
    for run in range(2, 6):
        layer.write(frames(spark, run), LAYOUTS)
    assert len(data_folders(layer, tmp_path)) == 2 * len(NAMES)
    assert len(layer.entries()) == 2
    views = {t.name for t in spark.catalog.listTables(layer.schema) if t.tableType == "VIEW"}
    assert views == set(NAMES)
    assert len(spark.catalog.listTables(layer.schema)) == 3 * len(NAMES)


def test_a_reader_keeps_the_run_it_began_with(spark, layer):
    before = layer.current()
    held = layer.read("t0", before)
    layer.write(frames(spark, 2), LAYOUTS)
    assert {r["run"] for r in held.collect()} == {1}
    assert {r["run"] for r in layer.read("t0", before).collect()} == {1}
    assert {r["run"] for r in layer.read("t0").collect()} == {2}


def test_rejected_and_failed_writes_leave_nothing(spark, layer, tmp_path):
    before = data_folders(layer, tmp_path)

    def refuse(written):
        raise RowCountMismatch("no")

    bad = {"t0": spark.range(3).selectExpr("raise_error('no') AS id"), "late": spark.range(1)}
    for error, given, verify in ((PySparkException, bad, None), (RowCountMismatch, frames(spark, 2), refuse)):
        with pytest.raises(error):
            layer.write(given, verify=verify, at_once=1)
        assert data_folders(layer, tmp_path) == before
        assert set(runs(layer).values()) == {1} and "late" not in layer.current()
    assert len(spark.catalog.listTables(layer.schema)) == 2 * len(NAMES)


def test_two_writers_both_arrive(spark, layer, tmp_path, monkeypatch):
    """The second takes the number that the first was about to use."""
    other, plain, raced = Layer(spark, layer.schema, str(tmp_path)), folders.put_new, []

    def race(*args):
        if not raced:
            raced.append(True)
            other.write({"t1": frames(spark, 9)["t1"]}, LAYOUTS)
        return plain(*args)

    monkeypatch.setattr(folders, "put_new", race)
    layer.write({"t0": frames(spark, 8)["t0"]}, LAYOUTS)
    assert runs(layer) == {"t0": 8, "t1": 9, "t2": 1} == runs(layer, "catalog")


def test_no_writer_gets_a_number_twice(spark, tmp_path):
    path = str(tmp_path / "log" / "1.json")
    assert folders.put_new(spark, path, "one") and not folders.put_new(spark, path, "two")
    assert folders.read_text(spark, path) == "one"
    assert set(folders.names(spark, str(tmp_path / "log"))) == {"1.json"}
    assert folders.names(spark, str(tmp_path / "none")) == {}


def test_layout_comes_back_with_the_folder(spark, layer, tmp_path):
    reader = other_application(layer, tmp_path)
    now = reader.current()
    assert now["t1"].layout == LAYOUTS["t1"] and now["t2"].layout == Layout()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = reader.read("t1").join(reader.read("t1").selectExpr("id", "run AS other"), "id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_missing_tables_and_other_objects(spark, layer, tmp_path):
    with pytest.raises(TableMissing, match="nothing"):
        layer.read("nothing")
    with pytest.raises(TableMissing):
        Layer(spark, layer.schema, str(tmp_path / "elsewhere")).read("t0")
    spark.range(3).write.saveAsTable(f"{layer.schema}.plain")
    layer.write({"plain": spark.range(4)})
    assert spark.table(f"{layer.schema}.plain").count() == 4
    (kept,) = [t.name for t in spark.catalog.listTables(layer.schema) if "__before_" in t.name]
    assert spark.table(f"{layer.schema}.{kept}").count() == 3


def test_vacuum_takes_what_killed_writers_left(spark, layer, tmp_path):
    stray = tmp_path / layer.schema / "t0" / "0123456789ab"
    stray.mkdir()
    (stray / "part-0.parquet").write_bytes(b"x")
    assert layer.vacuum() == []
    old = time.time() - 30 * 86400
    os.utime(stray, (old, old))
    assert layer.vacuum() == ["t0/0123456789ab"]
    assert not stray.exists() and set(runs(layer).values()) == {1}


def test_nothing_in_sources_moves_a_folder():
    for module in (folders, tables):
        source = open(module.__file__).read()
        assert "system.rename" not in source and "SET LOCATION" not in source
