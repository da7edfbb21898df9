import json
import os

from tidemark.sources.event_stream import EventFileStream, list_files, register_event_files


def land(root, name, *lines):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    part = root.parent / "part"
    part.write_text("\n".join(lines) + "\n")
    os.replace(part, path)


def event(n):
    return json.dumps({"id": f"b{n}", "serial": f"AP{n}"})


def taken(spark, out):
    return sorted((r.file, r.line, r.id) for r in spark.read.parquet(out).collect())


def test_restarts_take_each_file_once(spark, tmp_path):
    root, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    name = register_event_files(spark)

    def run():
        rows = spark.readStream.format(name).option("path", str(root)).option("parts", 3).load()
        query = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        query.trigger(availableNow=True).start().awaitTermination()

    wanted = []
    for day, first in (("day=1", 0), ("day=1", 4), ("day=2", 8)):
        for n in range(first, first + 4):
            land(root, f"{day}/{n:03}.json", event(n), "", event(n))
            wanted += [(f"{day}/{n:03}.json", 0, f"b{n}"), (f"{day}/{n:03}.json", 2, f"b{n}")]
        run()
        assert taken(spark, out) == wanted
    run()
    assert taken(spark, out) == wanted


def test_batch_reads_all_and_lists_what_is_no_event(spark, tmp_path):
    root = tmp_path / "in"
    name = register_event_files(spark)
    assert spark.read.format(name).option("path", str(root)).load().collect() == []
    land(root, "a.json", event(1), "{", '["x"]', '{"id": 7, "serial": null, "more": 1}', "[" * 100_000)
    land(root, "_b.json", event(2))
    rows = spark.read.format(name).option("path", str(root)).load().orderBy("line").collect()
    assert [(r.id, r.serial, r.bad_text) for r in rows] == [
        ("b1", "AP1", None), (None, None, "{"), (None, None, '["x"]'), ("7", None, None), (None, None, "[" * 100_000),
    ]


def test_committed_folders_are_not_listed_again(tmp_path, monkeypatch):
    root = tmp_path / "in"
    for n in range(3):
        land(root, f"day={n}/x.json", event(n))
    stream = EventFileStream({"path": str(root)})
    assert stream.latestOffset() == {"file": "day=2/x.json"}
    stream.commit({"file": "day=1/x.json"})
    opened, scandir = [], os.scandir
    monkeypatch.setattr(os, "scandir", lambda path: opened.append(os.path.basename(path)) or scandir(path))
    assert stream.latestOffset() == {"file": "day=2/x.json"}
    assert sorted(opened) == ["day=1", "day=2", "in"]
    assert stream.partitions({"file": "day=2/x.json"}, {"file": "day=2/x.json"}) == []
    assert sorted(list_files(str(root), "day=0/x.json", "day=1/x.json")) == ["day=1/x.json"]
