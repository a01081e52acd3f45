"""The command line on the reference's file layout, built from the driver's smallest tables."""

import json
import os

from pyspark.sql import functions as F

from mixprep import cli
from mixprep.plans import fixtures as fx
from mixprep.session import scratch_path

SF = "/root/testdata/sf0.001"


def _land(df, path, cols):
    """One JSONL file at ``path`` (tests only: a handful of rows)."""
    tmp = path + ".parts"
    df.select(*cols).coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(tmp)
    part = [f for f in os.listdir(tmp) if f.endswith(".json")][0]
    os.rename(os.path.join(tmp, part), path)


def test_cli_mix_analyze_prepare_generate(spark, capsys):
    root = scratch_path(spark, "t-cli").replace("file:", "")
    base, ext = f"{root}/dataset", f"{root}/dataset_expend"
    os.makedirs(base), os.makedirs(ext)
    s = fx.samples(spark, SF)
    names = {"rec": "懂推荐1.jsonl", "item": "懂物料part1.jsonl", "user": "懂用户.jsonl"}
    for cat, name in names.items():
        _land(s.filter(F.col("category") == cat), f"{base}/{name}", ["system", "prompt", "response"])
    _land(fx.alpaca(spark, SF), f"{ext}/懂世界.jsonl", ["instruction", "input", "output", "history"])

    cli.main(["mix", "--preset", "v2", "--base_dir", base, "--ext_dir", ext, "--out", f"{root}/v2"])
    printed = capsys.readouterr().out
    assert "TOTAL: train" in printed and "[懂推荐] raw 127 -> kept after filters and sampling:" in printed
    stats = json.loads(open([os.path.join(f"{root}/v2/_stats", f) for f in os.listdir(f"{root}/v2/_stats")
                             if f.endswith(".json")][0]).readline())
    n = {k: v["train"] + v["eval"] for k, v in json.loads(stats["categories"]).items()}
    assert set(n) == {"懂推荐", "懂物料", "懂用户", "懂世界"} and all(v["eval"] >= 1 for v in json.loads(stats["categories"]).values())
    back = spark.read.json(f"{root}/v2")
    assert back.count() == stats["total_train"] + stats["total_eval"]

    cli.main(["mix", "--preset", "v3", "--base_dir", base, "--ext_dir", ext, "--out", f"{root}/v3"])
    assert spark.read.json(f"{root}/v3").filter("split = 'eval'").count() >= 4

    cli.main(["analyze", "--data_dir", base])
    rows = [json.loads(l) for l in capsys.readouterr().out.splitlines() if l.startswith("{")]
    assert sorted(r["category"] for r in rows) == ["懂推荐", "懂物料", "懂用户"]
    cli.main(["land", "--data_dir", base, "--out", f"{root}/landed"])
    cli.main(["analyze", "--landed", f"{root}/landed"])
    assert [json.loads(l) for l in capsys.readouterr().out.splitlines() if l.startswith("{")] == rows
    printed = capsys.readouterr().out
    cli.main(["analyze", "--data_dir", base])
    assert sum(l.startswith("  [懂推荐] [") for l in capsys.readouterr().out.splitlines()) == 5

    cli.main(["prepare", "--data_dir", base, "--sample_weights", '{"懂推荐": 1.0, "懂用户": 3.0, "懂物料": 1.0}',
              "--max_seq_length", "256", "--batch_size", "4", "--out", f"{root}/prep"])
    prep = spark.read.parquet(f"{root}/prep/train")
    assert prep.count() > 0 and prep.filter(F.size("input_ids") != F.col("width")).count() == 0
    cli.main(["prepare", "--landed", f"{root}/landed", "--sample_weights", '{"懂推荐": 1.0, "懂用户": 3.0, "懂物料": 1.0}',
              "--max_seq_length", "256", "--batch_size", "4", "--out", f"{root}/prep_landed"])
    a = spark.read.parquet(f"{root}/prep/train").select("draw_id", "batch_id", "input_ids")
    b = spark.read.parquet(f"{root}/prep_landed/train").select("draw_id", "batch_id", "input_ids")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

    for name, df in (("sid", fx.item_sid(spark, SF)), ("cap", fx.item_caption(spark, SF)), ("prof", fx.profile(spark, SF).drop("user_id"))):
        df.write.mode("overwrite").parquet(f"{root}/{name}")
    cli.main(["generate", "--sid_dir", f"{root}/sid", "--caption_dir", f"{root}/cap", "--profile_dir", f"{root}/prof",
              "--out", f"{root}/gen", "--max-materials", "50", "--max-users", "5"])
    assert "懂物料_ext.jsonl: 100 samples" in capsys.readouterr().out
    items = spark.read.schema("system STRING, prompt STRING, response STRING").json(f"{root}/gen/懂物料_ext.jsonl")
    assert items.count() == 100
    assert spark.read.text(f"{root}/gen/懂用户_ext.jsonl").count() == 5


def test_cli_generate_short(spark):
    root = scratch_path(spark, "t-cli-short").replace("file:", "")
    for name, df in (("sid", fx.item_sid(spark, SF)), ("cap", fx.item_caption(spark, SF)),
                     ("prof", fx.profile(spark, SF).drop("user_id"))):
        df.write.mode("overwrite").parquet(f"{root}/{name}")
    cli.main(["generate", "--template", "short", "--sid_dir", f"{root}/sid", "--caption_dir", f"{root}/cap",
              "--profile_dir", f"{root}/prof", "--out", f"{root}/gen", "--max-materials", "50", "--max-users", "5"])
    items = spark.read.text(f"{root}/gen/懂物料_ext.jsonl").count()
    assert 0 < items <= 100 and spark.read.text(f"{root}/gen/懂推荐_ext.jsonl").count() == 5


def _lines(path, rows):
    with open(path, "w", encoding="utf-8") as f:
        f.write("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows))


def test_every_file_is_prepared_landed_and_analyzed(spark, capsys):
    """Four categories, one weight: rows in are rows out, and files without a weight keep their share."""
    root = scratch_path(spark, "t-cli-files").replace("file:", "")
    os.makedirs(f"{root}/in")
    for name in ("懂用户", "懂推荐1", "懂物料part1", "懂世界"):
        _lines(f"{root}/in/{name}.jsonl", [{"system": name, "prompt": f"p{i} " * 20, "response": "r"} for i in range(50)])
    cli.main(["prepare", "--data_dir", f"{root}/in", "--sample_weights", '{"懂用户": 3.0}', "--out", f"{root}/prep"])
    assert "raw rows: 200  processed rows (after resampling and filters): 200" in capsys.readouterr().out
    cli.main(["prepare", "--data_dir", f"{root}/in", "--out", f"{root}/plain"])
    assert spark.read.parquet(f"{root}/plain/train").count() == 200
    cli.main(["land", "--data_dir", f"{root}/in", "--out", f"{root}/landed"])
    landed = {r.category: r["count"] for r in spark.read.parquet(f"{root}/landed").groupBy("category").count().collect()}
    assert landed == {"懂用户": 50, "懂推荐": 50, "懂物料": 50, "懂世界": 50}
    cli.main(["land", "--data_dir", f"{root}/in", "--categories", "懂用户", "--out", f"{root}/some"])
    some = {r.category: r["count"] for r in spark.read.parquet(f"{root}/some").groupBy("category").count().collect()}
    assert some == {"懂用户": 50, "other": 150}
    capsys.readouterr()
    cli.main(["analyze", "--data_dir", f"{root}/in"])
    assert sum(json.loads(l)["n"] for l in capsys.readouterr().out.splitlines() if l.startswith("{")) == 200


def test_mix_of_equal_lines_and_alpaca_files(spark):
    """200 equal lines split exactly; a file in Alpaca form is not one key, and so not one side of the split."""
    root = scratch_path(spark, "t-cli-equal").replace("file:", "")
    os.makedirs(f"{root}/base"), os.makedirs(f"{root}/ext")
    _lines(f"{root}/base/懂用户.jsonl", [{"system": "s", "prompt": "the same", "response": "r"}] * 200)
    _lines(f"{root}/ext/懂物料_ext.jsonl", [{"instruction": "i", "input": f"q{i}", "output": "a"} for i in range(200)])
    mixed, _, _ = cli.build_mix(spark, f"{root}/base", f"{root}/ext", "v3")
    got = {(r.source, r.split): r["count"] for r in mixed.groupBy("source", "split").count().collect()}
    assert got == {("懂用户", "eval"): 10, ("懂用户", "train"): 190, ("懂物料_ext", "eval"): 10, ("懂物料_ext", "train"): 190}


def test_prepare_of_equal_lines_draws_each_copy(spark):
    root = scratch_path(spark, "t-cli-draws").replace("file:", "")
    os.makedirs(f"{root}/in")
    rows = [{"system": "s", "prompt": "one line " * 10, "response": "r"}] * 500
    rows += [{"system": "s", "prompt": f"line {i} " * 10, "response": "r"} for i in range(500)]
    _lines(f"{root}/in/a.jsonl", rows)
    cli.main(["prepare", "--data_dir", f"{root}/in", "--sample_weights", '{"a": 2.0}', "--out", f"{root}/out"])
    got = spark.read.parquet(f"{root}/out/train")
    assert got.count() == 1000 and got.select("draw_id").distinct().count() == 1000
    same = got.groupBy(F.md5(F.array_join("input_ids", ",")).alias("k")).count().orderBy(F.desc("count")).collect()
    assert 420 <= same[0]["count"] <= 580 and len(same) > 250       # half of the draws fall on the repeated line
