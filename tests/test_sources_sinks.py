"""JSONL sources and sinks on hand-made edge lines."""

import os

import pytest

from mixprep.schemas import SFT
from mixprep.session import scratch_path
from mixprep.sinks import jsonl as sinks
from mixprep.sources import jsonl as src
from mixprep.sources.keyed import dedupe_last_wins


def _write(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


GOOD = ['{"system": "s", "prompt": "p1", "response": "r1"}',
        '',
        '   ',
        '[{"prompt": "p2", "response": "r2"}, {"system": "", "prompt": "p3", "response": "r3"}]',
        '42',
        '"just a string"',
        '{"prompt": "😀", "response": "　"}']


def _local(spark, name):
    return scratch_path(spark, name).replace("file:", "")


def test_jsonl_lines_flatten_and_scalars_drop(spark):
    d = _local(spark, "t-jsonl")
    _write(d, "a.jsonl", GOOD)
    got = sorted((r.prompt, r.system) for r in src.read_jsonl(spark, d, SFT).collect())
    assert got == [("p1", "s"), ("p2", None), ("p3", ""), ("😀", None)]


def test_jsonl_malformed_line_fails_or_quarantines(spark):
    d = _local(spark, "t-bad")
    _write(d, "a.jsonl", GOOD + ['{"prompt": "oops"'])
    with pytest.raises(Exception):
        src.read_jsonl(spark, d, SFT).collect()
    good, bad = src.read_jsonl(spark, d, SFT, on_bad="quarantine")
    assert good.count() == 4 and bad.count() == 1


def test_mixed_array_line_keeps_its_objects(spark):
    d = _local(spark, "t-mixed")
    _write(d, "a.jsonl", ['{"prompt": "ok", "response": "r"}', '[{"prompt": "p"}, 3, "x", null, {"prompt": "q", "response": "{"}]', "[1, 2]"])
    assert sorted(r.prompt for r in src.read_jsonl(spark, d, SFT).collect()) == ["ok", "p", "q"]
    good, bad = src.read_jsonl(spark, d, SFT, on_bad="quarantine")
    assert good.count() == 3 and bad.count() == 0


def test_dir_scan_prunes_by_prefix_and_errors_when_empty(spark):
    d = _local(spark, "t-dir")
    _write(d, "rec1.jsonl", ['{"prompt": "a", "response": "b"}'])
    _write(d, "user.jsonl", ['{"prompt": "c", "response": "d"}'])
    _write(d, "notes.txt", ['{"prompt": "x", "response": "y"}'])
    df = src.read_dir(spark, d, categories=["user"], with_category=["rec", "user"])
    assert [(r.category, r.prompt) for r in df.collect()] == [("user", "c")]
    all_ = src.read_dir(spark, d, with_category=["rec", "user"])
    assert sorted(r.category for r in all_.collect()) == ["rec", "user"]
    with pytest.raises(FileNotFoundError):
        src.read_dir(spark, _local(spark, "t-empty"))


def test_sinks_roundtrip_keep_nulls_and_arrays(spark):
    df = spark.createDataFrame([("s", None, "r"), ("", "p", "😀")], "system string, prompt string, response string")
    d = _local(spark, "t-sink")
    sinks.write_jsonl(df, d + "/obj")
    sinks.write_jsonl(df, d + "/arr", array_per_line=True)
    lines = [l for f in os.listdir(d + "/obj") if f.endswith(".json") for l in open(os.path.join(d, "obj", f))]
    assert any('"prompt":null' in l for l in lines)
    back = src.read_jsonl(spark, [d + "/obj", d + "/arr"], SFT)
    assert sorted(map(tuple, back.select("system", "prompt", "response").collect()), key=str) == \
        sorted([("s", None, "r"), ("", "p", "😀")] * 2, key=str)


def test_dedupe_last_wins(spark):
    df = spark.createDataFrame([(1, "goods", [1, 1, 1], "a", 0), (1, "goods", [2, 2, 2], "b", 5),
                                (1, "live", [3, 3, 3], "a", 9), (2, "goods", [4, 4, 4], "b", 0)],
                               "pid long, domain string, sid array<int>, f string, r long")
    got = {(r.pid, r.domain): r.sid for r in dedupe_last_wins(df, ["pid", "domain"], ["sid"], ["f", "r"]).collect()}
    assert got == {(1, "goods"): [2, 2, 2], (1, "live"): [3, 3, 3], (2, "goods"): [4, 4, 4]}


def test_read_keyed_last_uses_file_and_row_order(spark):
    from mixprep.sources.keyed import read_keyed_last
    d = _local(spark, "t-keyed")
    a = spark.createDataFrame([(1, "goods", [1, 1, 1]), (1, "goods", [9, 9, 9])], "pid long, domain string, sid array<int>")
    b = spark.createDataFrame([(1, "goods", [5, 5, 5])], "pid long, domain string, sid array<int>")
    a.coalesce(1).write.parquet(d + "/a")
    b.coalesce(1).write.parquet(d + "/b")
    os.makedirs(d + "/t")
    for sub, name in (("a", "part-0.parquet"), ("b", "part-1.parquet")):
        f = [x for x in os.listdir(f"{d}/{sub}") if x.endswith(".parquet")][0]
        os.rename(f"{d}/{sub}/{f}", f"{d}/t/{name}")
    got = read_keyed_last(spark, d + "/t", ["pid", "domain"], ["sid"]).collect()
    assert [r.sid for r in got] == [[5, 5, 5]]
    first = read_keyed_last(spark, d + "/t", ["pid", "domain"], ["sid"], max_files=1).collect()
    assert [r.sid for r in first] == [[9, 9, 9]]
