from types import SimpleNamespace

import pytest

from assayer.sources import files, objects
from assayer.sources import CatalogSettings, ObjectStore, list_objects, previous_snapshot, read_as_of, read_csv
from assayer.sources import read_csv_text, remove_folder, scratch_folder, snapshot_log, write_csv, write_snapshot

def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "visits")
    for snapshot, rows in enumerate([[(1, "in"), (2, "out")], [(3, "in")], [(None, None)]], 1):
        write_snapshot(spark.createDataFrame(rows, "visit int, gate string"), path, snapshot)
    assert read_as_of(spark, path).count() == 4
    assert read_as_of(spark, path, 2).columns == ["visit", "gate"]
    assert sorted(r.visit for r in read_as_of(spark, path, 2).collect()) == [1, 2, 3]
    assert previous_snapshot(spark, path) == 2
    assert sorted((r.snapshot_id, r.added) for r in snapshot_log(spark, path).collect()) == [(1, 2), (2, 1), (3, 1)]
    assert read_as_of(spark, path, 0).count() == 0
    with pytest.raises(Exception, match="already exists"):
        write_snapshot(spark.createDataFrame([(9, "x")], "visit int, gate string"), path, 3)


TEXTS = ['plain', 'two\nlines', 'a "quoted" word', ' spaced ', "comma, and \\ slash", None, "ünïcode"]


def test_csv_roundtrip(spark, tmp_path):
    path = str(tmp_path / "texts")
    write_csv(spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string"), path)
    inferred = read_csv(spark, path, multi_line=True)
    assert dict(inferred.dtypes) == {"i": "int", "t": "string"}
    assert {r.i: r.t for r in inferred.collect()} == dict(enumerate(TEXTS))
    text = read_csv_text(spark, path)
    assert dict(text.dtypes) == {"i": "string", "t": "string"}
    assert {int(r.i): r.t for r in text.collect()} == dict(enumerate(TEXTS))
    write_csv(spark.createDataFrame([(1, "again")], "i int, t string"), path)
    assert read_csv(spark, path, "i int, t string").collect() == [(1, "again")]


def test_list_objects(spark, tmp_path):
    for name in ("in/a b.csv", "in/b+c.csv", "in/note.txt", "in/k=1/c.csv", "in/k=2/_e.csv", "in/.f", "other/d.csv"):
        file = tmp_path / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text("x")

    def keys(**kwargs):
        return sorted(r.key for r in list_objects(spark, str(tmp_path), **kwargs).collect())

    assert keys(prefix="in/") == ["in/.f", "in/a b.csv", "in/b+c.csv", "in/note.txt"]
    assert keys(prefix="in/", pattern=r"\.csv$", recursive=True) == [
        "in/a b.csv",
        "in/b+c.csv",
        "in/k=1/c.csv",
        "in/k=2/_e.csv",
    ]
    assert keys(prefix="in/b") == ["in/b+c.csv"]
    assert keys(pattern="d", recursive=True) == ["other/d.csv"]
    assert keys() == [] and keys(prefix="nowhere/") == [] and keys(prefix="in/zzz") == []
    assert list_objects(spark, str(tmp_path), prefix="in/").first().length == 1


def test_many_objects_are_listed_by_tasks(spark, tmp_path, monkeypatch):
    """No key passes the driver, and the tasks agree with Hadoop's listing."""
    for i in range(120):
        folder = tmp_path / f"k={i % 12}" / f"v {i % 40}"
        folder.mkdir(parents=True, exist_ok=True)
        for j in range(20):
            (folder / f"f{i}-{j}").write_text("x" * (j % 3))
    made = []
    create = type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, rows, *a: made.append(len(rows)) or create(self, rows, *a))
    found = list_objects(spark, str(tmp_path), recursive=True)
    assert found.count() == 2400 and sum(made) == 1
    same = objects._listed_by_driver(spark, str(tmp_path), "", "", ".*", True)
    assert sorted(found.select("key", "length").collect()) == sorted(same.select("key", "length").collect())
    one = list_objects(spark, f"file://{tmp_path}", prefix="k=1", pattern="f13-[01]$", recursive=True)
    assert sorted(r.key for r in one.collect()) == ["k=1/v 13/f13-0", "k=1/v 13/f13-1"]


def test_settings():
    store = ObjectStore("http://store:9000", "k", "s").settings()
    assert store["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert store["spark.hadoop.fs.s3a.path.style.access"] == "true"
    catalog = CatalogSettings("lake", "some.Catalog", "some.Extensions", {"type": "hive"}).settings()
    assert catalog == {
        "spark.sql.catalog.lake": "some.Catalog",
        "spark.sql.catalog.lake.type": "hive",
        "spark.sql.extensions": "some.Extensions",
    }


def test_scratch_lies_in_the_shared_folder(spark):
    def session(**given):
        settings = {k.replace("_", "."): v for k, v in given.items()}
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, other=None: settings.get(key, other)))

    assert scratch_folder(session(spark_checkpoint_dir="hdfs:///shared/"), "x").startswith("hdfs:///shared/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(session(spark_master="yarn"), "x")
    path = scratch_folder(spark, "x")
    assert path != scratch_folder(spark, "x")
    spark.range(1).write.parquet(path)
    remove_folder(spark, path)
    assert list_objects(spark, path, recursive=True).count() == 0


@pytest.mark.parametrize("rows,size", [(300, 100_000_000), (300, 3000), (12, 40)])
def test_multi_line_files_are_read_in_blocks(spark, tmp_path, rows, size):
    """One file, cut anywhere: inside values, between quotes, in a header; read as Spark reads it in one task."""
    path = str(tmp_path / "one.csv")
    made = [(i, TEXTS[i % len(TEXTS)] and TEXTS[i % len(TEXTS)] * (1 + i % 3), f'x{i}\r\n"{i}"') for i in range(rows)]
    made += [(rows, "line\n" * rows, "a"), (rows + 1, '"' * 20, "\n\n"), (rows + 2, "end", "no break")]
    write_csv(spark.createDataFrame(made, "i int, t string, `u\nv` string").coalesce(1), str(tmp_path / "made"))
    (part,) = (tmp_path / "made").glob("part-*.csv")
    (tmp_path / "one.csv").write_bytes(part.read_bytes())
    settings = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0"}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = read_csv_text(spark, path)
        assert found.columns == ["i", "t", "u\nv"]
        assert sorted(((int(i), t, u) for i, t, u in found.collect())) == made
        if size < 100_000:
            assert files.records(spark, path).rdd.getNumPartitions() > 6
        else:
            typed = read_csv(spark, path, multi_line=True)
            assert typed.dtypes[0] == ("i", "int") and typed.count() == len(made)
            plain = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
            assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
            assert files.records(spark, path, most_blocks=0) is None
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_multi_line_odd_files(spark, tmp_path):
    for name, text in {"a": "i,t\n", "b": "", "c": 'i,t\n1,"x\n', "d": "i,t\n\n2,y\n\n3,\"\"\n4,z"}.items():
        folder = tmp_path / name
        folder.mkdir()
        (folder / "f.csv").write_text(text)
    assert read_csv(spark, str(tmp_path / "a"), "i int, t string", multi_line=True).collect() == []
    rows = read_csv(spark, str(tmp_path / "d"), "i int, t string", multi_line=True).collect()
    assert sorted(map(tuple, rows)) == [(2, "y"), (3, None), (4, "z")]
    assert [r.i for r in read_csv(spark, str(tmp_path / "c"), "i int, t string", multi_line=True).collect()] == [1]
    assert read_csv(spark, str(tmp_path / "b"), "i int, t string", multi_line=True).count() == 0
