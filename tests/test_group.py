import json

import pytest
from pyspark.errors import StreamingQueryException

from tidewatch.config import PipelineConfig
from tidewatch.sources import group
from tidewatch.sources.group import GroupReader, lines_until, read_group

CONFIG = PipelineConfig(batch_count=25, block_ms=100)


def append(folder, name, numbers, end="\n"):
    folder.mkdir(exist_ok=True)
    with open(folder / name, "a") as f:
        f.write("\n".join(json.dumps({"stream_id": f"{n}-0", "payload": f"é{n}"}) for n in numbers) + end)


def start(spark, tmp_path, name, got, ckpt, fail=()):
    left = set(fail)

    def batch(df, number):
        rows = sorted(int(r.stream_id.split("-")[0]) for r in df.collect())
        got.append((number, rows))
        if number in left:
            left.discard(number)
            raise RuntimeError("lost")

    return read_group(spark, str(tmp_path / "s"), name, CONFIG).writeStream.foreachBatch(batch).option("checkpointLocation", str(tmp_path / ckpt)).trigger(processingTime="0 seconds").start()


def test_batches_are_bounded_and_lost_ones_come_again(spark, tmp_path):
    append(tmp_path / "s", "a.jsonl", range(40))
    append(tmp_path / "s", "b.jsonl", range(40, 60))
    got = []
    q = start(spark, tmp_path, "g", got, "c", fail={1})
    with pytest.raises(StreamingQueryException):
        q.processAllAvailable()
    assert got == [(0, list(range(25))), (1, list(range(25, 50)))]
    q = start(spark, tmp_path, "g", got, "c")
    q.processAllAvailable()
    assert got[2:] == [(1, list(range(25, 50))), (2, list(range(50, 60)))]  # the lost batch as it was, once
    append(tmp_path / "s", "b.jsonl", [60, 61])
    q.processAllAvailable()
    assert got[-1] == (3, [60, 61])
    q.stop()
    # the group goes on where it committed, whoever reads for it; another group has all
    later, other = [], []
    q = start(spark, tmp_path, "g", later, "c2")
    q.processAllAvailable()
    q.stop()
    mark = GroupReader({"path": str(tmp_path / "s"), "group": "g"}).initialOffset()
    assert mark["segment"] == "b.jsonl" and set(x for _, r in later for x in r) <= {60, 61}
    q = start(spark, tmp_path, "h", other, "c3")
    q.processAllAvailable()
    q.stop()
    assert [x for _, r in other for x in r] == list(range(62)) and max(len(r) for _, r in other) == 25


def test_offsets_and_spans(tmp_path, monkeypatch):
    monkeypatch.setattr(group, "PART_BYTES", 50)
    append(tmp_path / "s", "a.jsonl", range(30))
    append(tmp_path / "s", "c.jsonl", range(30, 33))
    append(tmp_path / "s", "d.jsonl", [33], end="")  # not yet a whole line
    (tmp_path / "s" / "b.jsonl").write_text("")
    reader = GroupReader({"path": str(tmp_path / "s"), "count": "100", "block_ms": "1"})
    begin = reader.initialOffset()
    end = reader.latestOffset()
    assert end["segment"] == "c.jsonl"
    rows = [r for p in reader.partitions(begin, end) for b in reader.read(p) for r in b.to_pylist()]
    assert [r["stream_id"] for r in rows] == [f"{n}-0" for n in range(33)] and rows[5]["payload"] == "é5"
    assert reader.latestOffset() == end
    append(tmp_path / "s", "d.jsonl", [34], end="\n")
    assert reader.latestOffset()["segment"] == "d.jsonl"
    with open(tmp_path / "s" / "a.jsonl", "rb") as f:
        assert lines_until(f, 0, 3)[0] == 3
    empty = GroupReader({"path": str(tmp_path / "none"), "block_ms": "1"})
    assert empty.latestOffset() == {"segment": "", "byte": 0} and empty.partitions(empty.initialOffset(), empty.initialOffset()) == []
