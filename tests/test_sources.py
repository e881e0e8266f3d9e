from __future__ import annotations

import json
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Observation

from starsmelt.plans.medallion import MedallionTables, Target, load_bronze
from starsmelt.schemas import BRONZE_FIELDS, BRONZE_SCHEMA
from starsmelt.sources import (
    REJECTED,
    Layer,
    Layout,
    NoRecords,
    PagesMissing,
    RowCountMismatch,
    SchemaMismatch,
    Stage,
    TooManyRejects,
    land_pages,
    load_table,
    read_marked_pages,
    read_pages,
    read_parquet,
    read_table,
    require_pages,
    require_rows,
    row_count_check,
    shared_folder,
    write_parquet,
)

FIELDS = {"id": "bigint", "name": "string", "genres": "string"}


def write(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.json").write_text(text)
    return str(folder)


def test_pages_become_records_with_raw_nested_text(spark, tmp_path):
    path = write(
        tmp_path / "pages",
        a='{"count":2,"results":[{"id":1,"name":"x","genres":[{"id": 4, "name":"g"}]},{"id":2}]}',
        b='{"results":[]}', c='{"detail":"gone"}',
    )
    seen = Observation()
    rows = sorted(map(tuple, read_pages(spark, path, FIELDS, seen).collect()))
    require_pages(seen, 3, path)
    require_pages(seen, None, path)
    with pytest.raises(PagesMissing, match="expected 4 pages .* found 3"):
        require_pages(seen, 4, path)
    assert rows == [(1, "x", '[{"id": 4, "name":"g"}]'), (2, None, None)]


def test_pretty_printed_pages(spark, tmp_path):
    page = json.dumps({"results": [{"id": 1, "genres": [{"id": 4}]}]}, indent=2)
    path = write(tmp_path / "pages", a=page)
    (row,) = read_pages(spark, path, FIELDS, multi_line=True).collect()
    assert row["id"] == 1 and json.loads(row["genres"]) == [{"id": 4}]
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_pages(spark, path, FIELDS).collect()


def test_broken_pages_raise(spark, tmp_path):
    path = write(tmp_path / "broken", a='{"results":[')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_pages(spark, path, FIELDS).collect()


def test_bad_pages_are_skipped_up_to_a_limit(spark, tmp_path):
    good = '{"results":[{"id":1,"name":"x"},{"id":2,"name":null}]}'
    path = write(tmp_path / "mixed", a=good, b='{"results":[', c='{"results":[{"id":"text"},{"id":3}]}',
                 d='{"results":[]}', e='{"detail":"gone"}', f='{"results":null}')
    seen = Observation()
    rows = read_marked_pages(spark, path, FIELDS, seen).collect()
    assert sorted(r["id"] for r in rows if r[REJECTED] is None) == [1, 2]
    assert sorted(r[REJECTED] for r in rows if r[REJECTED]) == ['{"results":[', '{"results":[{"id":"text"},{"id":3}]}']
    assert all(r["id"] is None for r in rows if r[REJECTED])
    assert seen.get == {"pages": 6, "bad_pages": 2}

    target = Target("t_rej_b", "t_rej_s", "t_rej_g", location=str(tmp_path / "layers"))
    target.create(spark)
    assert load_bronze(spark, path, target, max_bad_pages=2) == 2
    tables = MedallionTables(spark, target)
    assert tables["bronze.items"].columns == list(BRONZE_FIELDS) and tables["bronze.items"].count() == 2
    assert tables["bronze.rejected_pages"].count() == 2
    worse = write(tmp_path / "worse", a=good, b="{", c="[", d="x")
    with pytest.raises(TooManyRejects, match="3 bad pages"):
        load_bronze(spark, worse, target, max_bad_pages=2)
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        load_bronze(spark, worse, target)
    with pytest.raises(PagesMissing):
        load_bronze(spark, path, target, expected_pages=7, max_bad_pages=2)
    none = write(tmp_path / "none", a="{")
    with pytest.raises(NoRecords):
        load_bronze(spark, none, target, max_bad_pages=2)
    assert MedallionTables(spark, target)["bronze.rejected_pages"].count() == 2
    clean = write(tmp_path / "clean", a=good)
    assert load_bronze(spark, clean, target, max_bad_pages=2) == 2
    assert MedallionTables(spark, target)["bronze.rejected_pages"].count() == 0


def test_landed_pages_are_bounded_and_lose_nothing(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "'same' AS name", "array(named_struct('id', id)) AS genres")
    path = str(tmp_path / "pages")
    land_pages(df.repartition(3), path, page_size=40)
    pages = [json.loads(row[0]) for row in spark.read.text(path).collect()]
    assert max(len(page["results"]) for page in pages) == 40
    back = read_pages(spark, path, FIELDS)
    assert sorted(row["id"] for row in back.collect()) == list(range(1000))


def test_parquet_gates(spark, tmp_path):
    path = str(tmp_path / "data")
    write_parquet(spark.range(3), path)
    assert read_parquet(spark, path, "id bigint").columns == ["id"]
    for schema in ("id bigint, more string", "id int"):
        with pytest.raises(SchemaMismatch):
            read_parquet(spark, path, schema)
    spark.range(3).selectExpr("id", "'x' AS more").write.mode("append").parquet(path)
    assert read_parquet(spark, path, "id bigint, more string").count() == 6
    spark.range(3).selectExpr("string(id) AS id").write.mode("append").parquet(path)
    with pytest.raises(SchemaMismatch, match="differ"):
        read_parquet(spark, path, "id bigint")
    path = str(tmp_path / "three")
    write_parquet(spark.range(3), path)
    assert require_rows(read_parquet(spark, path), "data").count() == 3
    with pytest.raises(NoRecords):
        require_rows(spark.range(0), "nothing")
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_parquet(spark, str(tmp_path / "missing"))


def test_table_is_replaced_and_verified(spark, tmp_path):
    layer = Layer(spark, "t_tables", str(tmp_path))
    source = str(tmp_path / "records")
    columns = [f"CAST(NULL AS {kind}) AS `{name}`" for name, kind in BRONZE_FIELDS.items()]
    write_parquet(spark.range(5).selectExpr(*columns), source)
    for _ in range(2):
        assert load_table(layer, source, "items", BRONZE_SCHEMA) == 5
    assert read_table(spark, "t_tables.items").columns == list(BRONZE_FIELDS)
    with pytest.raises(RowCountMismatch):
        row_count_check(layer.read("items"), 6)
    with pytest.raises(AnalysisException):
        load_table(layer, str(tmp_path / "missing"), "items", BRONZE_SCHEMA)
    lacking, bare = str(tmp_path / "lacking"), str(tmp_path / "bare")
    write_parquet(spark.read.parquet(source).drop("genres"), lacking)
    write_parquet(spark.read.parquet(source).limit(0), bare)
    with pytest.raises(SchemaMismatch, match="genres"):
        load_table(layer, lacking, "items", BRONZE_SCHEMA)
    with pytest.raises(NoRecords):
        load_table(layer, bare, "items", BRONZE_SCHEMA)
    assert spark.table("t_tables.items").count() == layer.read("items").count() == 5


def test_buckets_are_one_file_each(spark, tmp_path):
    layer = Layer(spark, "t_buckets", str(tmp_path))
    df = spark.range(1000).selectExpr("id", "id % 3 AS g").repartition(7)
    layer.write({"a": df}, {"a": Layout("id", ("g",), 4)})
    files = list((tmp_path / "t_buckets" / "a").glob("*/*.parquet"))
    assert len(files) == 4
    assert spark.table("t_buckets.a").count() == 1000


def test_a_stage_is_removed_after_its_run(spark):
    with Stage(spark) as stage:
        assert stage.put(spark.range(3), "kept").count() == 3
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{stage.folder}/*")


def test_stage_survives_without_its_source(spark, tmp_path):
    write_parquet(spark.range(9), str(tmp_path / "source"))
    stage = Stage(spark)
    staged = stage.put(spark.read.parquet(str(tmp_path / "source")).filter("id > 3"), "kept")
    assert stage.folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert str(tmp_path) not in staged._jdf.queryExecution().toString()
    assert staged.count() == 5


def test_a_cluster_needs_a_shared_folder():
    def session(master, folder=None):
        conf = SimpleNamespace(get=lambda key, default=None: folder or default)
        context = SimpleNamespace(master=master, applicationId="app-1")
        return SimpleNamespace(conf=conf, sparkContext=context)

    assert shared_folder(session("yarn", "hdfs://ns/ck/")) == "hdfs://ns/ck"
    assert shared_folder(session("local[2]")) == shared_folder(session("local[2]"))
    with pytest.raises(RuntimeError):
        shared_folder(session("yarn"))


def test_pages_land_without_a_shuffle_in_bounded_files(spark, tmp_path):
    """A page holds neighbours of one task; a compressed file, which one task reads, holds few pages."""
    df = spark.range(0, 1000, 1, 2).selectExpr("id", "IF(id % 5 = 0, NULL, 'x') AS name", "array(named_struct('id', id)) AS genres")
    path = tmp_path / "pages"
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("landing", "landing")
    try:
        land_pages(df, str(path), page_size=40, pages_per_file=4)
        stages = [s for j in jobs.getJobIdsForGroup("landing") for s in jobs.getJobInfo(j).stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(stages) == 1
    files = sorted(path.glob("part-*"))
    assert {f.name.rsplit(".", 1)[-1] for f in files} == {"gz"} and len(files) == 8  # 13 pages of each task
    assert spark.read.text(str(path)).count() == 26
    back = sorted((r["id"], r["name"], r["genres"]) for r in read_pages(spark, str(path), FIELDS).collect() if r["name"])
    assert [(i, n) for i, n, _ in back] == [(i, "x") for i in range(1000) if i % 5]
    assert read_pages(spark, str(path), FIELDS).count() == 1000


def test_datasets_and_tables_are_written_in_the_denser_codec(spark, tmp_path):
    rows = spark.range(10).selectExpr("id", "repeat('{}', 50) AS text")
    write_parquet(rows, str(tmp_path / "dataset"))
    layer = Layer(spark, "dense", str(tmp_path))
    layer.write({"plain": rows, "bucketed": rows}, {"bucketed": Layout("id", (), 2)})
    written = list(tmp_path.rglob("*.parquet"))
    files = [path for path in written if path.is_file()]
    assert len(files) >= 4 and all(path.name.endswith(".zstd.parquet") for path in files)
