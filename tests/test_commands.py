"""The command log source: ranges, growing files, replay from an offset."""

import json

import pytest

from plyframe.sources import commands as S


def lines_of(folder):
    out = []
    for f in sorted(p for p in folder.iterdir() if p.name[0] not in "._"):
        at, data = 0, f.read_bytes()
        for line in data.split(b"\n")[:-1]:
            out.append((f.name, at, line.removesuffix(b"\r").decode("utf-8", "replace")))
            at += len(line) + 1
    return out


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_every_line_is_in_one_range(tmp_path, monkeypatch, size):
    monkeypatch.setattr(S, "RANGE", size)
    monkeypatch.setattr(S, "READ", 16)
    (tmp_path / "a.log").write_bytes(b"go depth 5\n\nposition startpos\r\n" + "é".encode() * 40 + b"\n\xff\nunfinished")
    (tmp_path / "b.log").write_bytes(b"x\n" * 20)
    (tmp_path / "c.log").write_bytes(b"no end")
    (tmp_path / "_hidden").write_bytes(b"go\n")
    folder = S._Folder(str(tmp_path))
    parts = folder.ranges({}, folder.ends())
    assert sorted(x for p in parts for x in folder.read(p)) == lines_of(tmp_path)
    # from the third line on
    start = {"a.log": 12, "b.log": 40}
    got = [x for p in folder.ranges(start, folder.ends()) for x in folder.read(p)]
    assert got == [x for x in lines_of(tmp_path) if x[0] == "a.log" and x[1] >= 12]


def run(spark, log, out, checkpoint, **options):
    stream = spark.readStream.format("command_log").options(path=log, **options).load()
    query = stream.writeStream.option("checkpointLocation", checkpoint).format("parquet").option("path", out).start()
    query.processAllAvailable()
    query.stop()
    return sorted(map(tuple, spark.read.parquet(out).select("file", "at", "text").collect()))


def test_stream_follows_files_and_replays(spark, tmp_path):
    S.register(spark)
    log = tmp_path / "log"
    log.mkdir()
    (log / "a.log").write_text("position startpos\ngo dep")
    places = (f"file://{log}", str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert run(spark, *places) == [("a.log", 0, "position startpos")]
    with open(log / "a.log", "a") as f:
        f.write("th 5\nstop\n")
    (log / "b.log").write_text("go\n")
    got = run(spark, *places)  # goes on where it was
    assert got == lines_of(log) and len(got) == 4
    again = run(spark, places[0], str(tmp_path / "again"), str(tmp_path / "other"), startingOffset=json.dumps({"a.log": 18}))
    assert again == got[1:]
    assert sorted(map(tuple, spark.read.format("command_log").option("path", places[0]).load().collect())) == got
