"""First samples of a file against a whole read; named files by commit, with failed and repeated tasks."""

import io
import json
import os
import subprocess
import sys

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mixprep import cli
from mixprep.session import scratch_path
from mixprep.sinks import published
from mixprep.sinks.published import NamedWriter, file_name, publish_jsonl
from mixprep.sources import heads, jsonl as src

SCHEMA = "id long, system string, prompt string, response string"


def plain_read(path):
    """All samples of a file as the reference reads them."""
    out = []
    with open(path, encoding="utf-8") as f:
        for line in f:
            if line.strip():
                value = json.loads(line.strip())
                out += [s for s in (value if isinstance(value, list) else [value]) if isinstance(s, dict)]
    return out


@pytest.fixture()
def folder(tmp_path):
    one = lambda i: {"id": i, "system": None, "prompt": f"日本   {i}", "response": "x" * (i * 37 % 900)}
    (tmp_path / "rec_a.jsonl").write_text("".join(json.dumps(one(i), ensure_ascii=False) + "\n" for i in range(3000)), encoding="utf-8")
    lines = ["", "  \t", json.dumps([one(1), 3, one(2), "x", None]), "7", json.dumps([]), json.dumps([one(3), one(4), one(5)]), "  " + json.dumps(one(6)) + "  "]
    (tmp_path / "item_b.jsonl").write_text("\n".join(lines), encoding="utf-8")          # no newline at the end
    (tmp_path / "user_c.jsonl").write_text("")
    (tmp_path / "other.txt").write_text("not read")
    return tmp_path


@pytest.mark.parametrize("n", [0, 1, 4, 5, 1000, 10 ** 6])
def test_heads_equal_the_first_of_a_whole_read(spark, folder, n):
    got = {}
    for r in src.read_dir(spark, str(folder), schema=SCHEMA, with_category=["rec", "item", "user"], first=n).collect():
        got.setdefault(r.file_name, []).append((r.sample_no, r.id, r.system, r.prompt, r.response, r.category))
    for name in ("rec_a.jsonl", "item_b.jsonl", "user_c.jsonl"):
        want = [(k, s["id"], s["system"], s["prompt"], s["response"], name.split("_")[0]) for k, s in enumerate(plain_read(folder / name)[:n])]
        assert sorted(got.get(name, [])) == want


def test_offsets_lead_back_to_the_line(spark, folder):
    for r in src.read_dir(spark, str(folder), schema=SCHEMA, first=50).collect():
        with open(folder / r.file_name, "rb") as f:
            f.seek(r.line_offset)
            value = json.loads(f.readline())
        assert r.id in [s["id"] for s in (value if isinstance(value, list) else [value]) if isinstance(s, dict)]


def test_only_the_head_is_read():
    class Counted(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            data = super().read(n)
            self.taken += len(data)
            return data
    file = Counted(b'{"id": 1}\n' * 10 ** 6 + b"not JSON\n")
    assert len(list(heads.head(file, 5))) == 5 and file.taken <= heads.CHUNK
    file = Counted(b'{"id": 1}\nnot JSON\n')
    with pytest.raises(ValueError, match="at byte 10"):
        list(heads.head(file, 2))
    long = b'{"id": 1, "t": "' + b"y" * (3 * heads.CHUNK) + b'"}\n{"id": 2}'
    assert [json.loads(t)["id"] for _, _, t in heads.head(io.BytesIO(long), 9)] == [1, 2]


def test_command_line_takes_the_first_samples(spark, folder):
    out = scratch_path(spark, "t-first").replace("file:", "")
    cli.main(["prepare", "--data_dir", str(folder), "--max_samples", "3", "--max_seq_length", "2048", "--out", out])
    assert spark.read.parquet(f"{out}/train").count() == 6
    cli.main(["prepare", "--data_dir", str(folder), "--max_samples", "3", "--sample_rows", "hash", "--out", f"{out}-hash"])
    assert spark.read.parquet(f"{out}-hash/train").count() == 6


def rows(n=1000):
    return [(i, "train" if i % 10 else "eval", None if i % 7 == 0 else f"p{i} 日本\n", "r") for i in range(n)]


@pytest.fixture()
def frame(spark):
    return spark.createDataFrame(rows(), "id long, split string, prompt string, response string").repartition(7)


def content(path):
    """Samples of a published file or folder."""
    if os.path.isdir(path):
        return [s for f in sorted(os.listdir(path)) for s in content(os.path.join(path, f))]
    with open(path, encoding="utf-8") as f:
        return [json.loads(line) for line in f]


def expected(split):
    return sorted(i for i, s, _, _ in rows() if s == split)


@pytest.mark.parametrize("layout", ["folders", "plain", "flat"])
def test_layouts(spark, frame, tmp_path, layout):
    root = str(tmp_path / "out")
    for _ in range(2):                                          # the second run replaces the first
        paths = publish_jsonl(spark, frame, root, "split", ("id", "prompt", "response"), layout=layout, order=("id",))
        assert sorted(os.listdir(root)) == [os.path.basename(p) for p in paths] and os.listdir(tmp_path) == ["out"]
        for split in ("train", "eval"):
            got = [s for p in paths if os.path.basename(p).startswith(split) for s in content(p.replace("file:", ""))]
            assert sorted(s["id"] for s in got) == expected(split)
            assert all(s["prompt"] == rows()[s["id"]][2] for s in got)
            if layout == "plain":
                assert [s["id"] for s in got] == expected(split) and os.path.isfile(f"{root}/{split}.jsonl")
    with pytest.raises(FileExistsError):
        publish_jsonl(spark, frame, root, "split", ("id",), mode="errorifexists")
    assert spark.read.json(root, recursiveFileLookup=True).count() == 1000


def test_a_plain_file_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """One name has nearly all rows, and a third of them share one key: the parts stay small, and the file is whole and in order."""
    sizes = []

    def seen(system, parts, found=published.places):
        sizes.extend(size for own in found(system, parts).values() for _, _, size in own)
        return found(system, parts)
    monkeypatch.setattr(published, "PART_BYTES", 1 << 16)
    monkeypatch.setattr(published, "COPY_BYTES", 1000)
    monkeypatch.setattr(published, "places", seen)
    key = F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(12_000 - F.col("id"))
    df = spark.range(0, 12_000, 1, 5).select("id", key.alias("key"), F.when(F.col("id") < 5, "few").otherwise("most").alias("name"), F.lit("日本 " * 10).alias("text"))
    paths = publish_jsonl(spark, df, str(tmp_path / "o"), "name", ("id", "key", "text"), layout="plain", order=("key",))
    assert [os.path.basename(p) for p in paths] == ["few.jsonl", "most.jsonl"] and os.listdir(tmp_path) == ["o"]
    got = {n: content(tmp_path / "o" / f"{n}.jsonl") for n in ("few", "most")}
    assert sorted(s["id"] for s in got["few"]) == list(range(5)) and sorted(s["id"] for s in got["most"]) == list(range(5, 12_000))
    for own in got.values():
        keys = [-1 if s["key"] is None else s["key"] for s in own]
        assert keys == sorted(keys) and all(s["text"] == "日本 " * 10 for s in own)
    assert len(sizes) > 10 and max(sizes) <= 3 << 16


def test_parts_have_places_in_the_order_of_their_tasks(tmp_path):
    from pyarrow import fs
    (tmp_path / "p" / "a.jsonl").mkdir(parents=True)
    for n, text in ((99_999, "two\n"), (100_000, "three\n"), (7, "one\n")):
        (tmp_path / "p" / "a.jsonl" / f"part-{n:05d}.jsonl").write_text(text)
    own = published.places(fs.LocalFileSystem(), str(tmp_path / "p"))["a.jsonl"]
    assert [(begin, size) for _, begin, size in own] == [(0, 4), (4, 4), (8, 6)]
    for path, begin, _ in [own[2], own[0], own[1], own[0]]:               # in any order, one of them twice
        published.put(path, str(tmp_path / "a.jsonl"), begin)
    published.join([path for path, _, _ in own], str(tmp_path / "b.jsonl"), str(tmp_path))
    assert (tmp_path / "a.jsonl").read_text() == (tmp_path / "b.jsonl").read_text() == "one\ntwo\nthree\n"


def test_arrays_odd_names_and_no_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, "a/b"), (2, None), (3, "_x"), (4, "."), (5, ""), (6, "懂 世界")], "id long, name string")
    paths = publish_jsonl(spark, df, str(tmp_path / "o"), "name", ("id",), layout="flat", array_per_line=True)
    assert len(paths) == 6 and spark.read.json(str(tmp_path / "o")).count() == 6
    assert [file_name(n) for n in ("a/b", "_x", ".", "")] == ["a%2Fb", "%5Fx", "%2E", "%"]
    assert publish_jsonl(spark, df.filter("id < 0"), str(tmp_path / "none"), "name", ("id",)) == [] and (tmp_path / "none").is_dir()


def batch(names, lines):
    return pa.RecordBatch.from_arrays([pa.array(names), pa.array(lines)], names=["name", "line"])


def test_a_failed_attempt_leaves_nothing(tmp_path):
    w = NamedWriter(str(tmp_path / "o"), "folders", True)

    def broken():
        yield batch(["train"] * 3, ["1", "2", "3"])
        raise OSError("lost")
    with pytest.raises(OSError):
        w.write_part(broken(), 0, "a")
    messages = [w.write_part(iter([batch(["train"] * 3, ["1", "2", "3"])]), 0, "b"), w.write_part(iter([batch(["train", "eval"], ["4", "5"])]), 1, "c"),
                w.write_part(iter([batch(["train", "eval"], ["4", "5"])]), 1, "d")]       # a task that ran twice
    assert not (tmp_path / "o").exists()
    w.commit(messages)
    assert content(tmp_path / "o" / "train.jsonl") == [1, 2, 3, 4] and content(tmp_path / "o" / "eval.jsonl") == [5]
    assert os.listdir(tmp_path) == ["o"] and sorted(os.listdir(tmp_path / "o")) == ["eval.jsonl", "train.jsonl"]


def test_an_aborted_job_keeps_the_old_files(tmp_path):
    (tmp_path / "o").mkdir()
    (tmp_path / "o" / "train.jsonl").write_text("9\n")
    w = NamedWriter(str(tmp_path / "o"), "plain", True)
    w.abort([w.write_part(iter([batch(["train"], ["1"])]), 0, "a")])
    assert content(tmp_path / "o" / "train.jsonl") == [9] and os.listdir(tmp_path) == ["o"]
    with pytest.raises(ValueError, match="several tasks"):
        w.commit([w.write_part(iter([batch(["train"], ["1"])]), 0, "a"), w.write_part(iter([batch(["train"], ["2"])]), 1, "b")])
    assert content(tmp_path / "o" / "train.jsonl") == [9] and os.listdir(tmp_path) == ["o"]


RETRIED = """
import os, sys
sys.path.insert(0, {root!r})
from pyspark.sql import functions as F
from mixprep.session import get_spark
from mixprep.sinks.published import publish_jsonl
spark = get_spark(master="local[2,3]", extra={{"spark.checkpoint.dir": {out!r} + "/shared"}})
def once(batches):
    from pyspark import TaskContext
    for b in batches:
        yield b
    if TaskContext.get().partitionId() == 1 and TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("first attempt fails behind its last row")
df = spark.range(0, 900, 1, 3).mapInArrow(once, "id long")
publish_jsonl(spark, df, {out!r} + "/o", F.when(F.col("id") % 10 == 0, "eval").otherwise("train"), ("id",))
"""


def test_a_task_that_runs_again_leaves_each_row_once(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", RETRIED.format(root=root, out=str(tmp_path))], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    got = [s["id"] for n in ("train", "eval") for s in content(tmp_path / "o" / f"{n}.jsonl")]
    assert sorted(got) == list(range(900)) and sorted(os.listdir(tmp_path / "o")) == ["eval.jsonl", "train.jsonl"]
