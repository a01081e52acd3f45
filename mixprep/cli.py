"""Command line for the reference's workflows: mix (v2/v3), generate, prepare, analyze.

Every command builds one lazy Spark plan and writes its result; flags mirror the
reference's (``--categories``, ``--max_samples``, ``--sample_weights``,
``--filter_long_samples``, ``--max_seq_length``, ``--batch_size``, ``--max-users``,
``--max-materials``, ``--max-sid-files``, ``--max-cap-files``).
"""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import functions as F

# The reference's file layout for its two mixtures.
BASE_FILES = {
    "懂推荐": [f"懂推荐{i}.jsonl" for i in range(1, 5)],
    "懂物料": [f"懂物料part{i}.jsonl" for i in range(1, 8)],
    "懂用户": ["懂用户.jsonl"],
}
EXT_FILES = {"懂推荐_ext": "懂推荐_ext.jsonl", "懂物料_ext": "懂物料_ext.jsonl", "懂用户_ext": "懂用户_ext.jsonl"}
WORLD_FILE, WORLD_CATEGORY = "懂世界.jsonl", "懂世界"
PRESETS = {
    "v2": {"max_char": 12288, "world_min": 50, "world_sample": 30000, "split_by": "category", "ext": False},
    "v3": {"max_char": 36000, "world_min": 50, "world_sample": 60000, "split_by": "source", "ext": True},
}
GENERATED = {"items": "懂物料_ext.jsonl", "users": "懂用户_ext.jsonl", "rec": "懂推荐_ext.jsonl"}
OTHER = "other"   # category of files that no listed name matches

_ANY = ("system STRING, prompt STRING, response STRING, instruction STRING, input STRING, output STRING, "
        "history ARRAY<ARRAY<STRING>>")


def _schema(ddl: str):
    from mixprep.sources.jsonl import as_schema
    return as_schema(ddl)


def _spark(args):
    from mixprep.session import get_spark
    return get_spark("mixprep-cli", master=args.master)


def build_mix(spark, base_dir: str, ext_dir: str, preset: str, eval_ratio: float = 0.05, seed=42,
              observation=None):
    """W1 / W2 over the reference's file layout; returns the mixed DataFrame, the preset and the recipe."""
    from mixprep.plans.mix import Recipe, Source, run_recipe
    from mixprep.sources.jsonl import read_sources, staged_with_ids
    p = PRESETS[preset]
    files = {cat: [f"{base_dir}/{n}" for n in names] for cat, names in BASE_FILES.items()}
    if p["ext"]:
        files |= {name: [f"{ext_dir}/{fname}"] for name, fname in EXT_FILES.items()}
    world_name = WORLD_CATEGORY + ("_ext" if p["ext"] else "")
    files[world_name] = [f"{ext_dir}/{WORLD_FILE}"]
    # All lines are parsed once into a table laid out by source, with a unique id per row; a source reads its folder.
    raw = read_sources(spark, files, _schema(_ANY)).withColumnRenamed("category", "src").drop("file_name")
    raw = staged_with_ids(raw, "mix-raw", partition_by="src")
    plain = tuple(n for n in files if n != world_name)
    sources = [Source("plain", raw.filter(F.col("src").isin(*plain)), "sample_key", fmt="auto", max_char=p["max_char"],
                      name_col="src", names=plain),
               Source(world_name, raw.filter(F.col("src") == world_name), "sample_key", fmt="alpaca", category=WORLD_CATEGORY,
                      min_char=p["world_min"], max_char=p["max_char"], sample=p["world_sample"])]
    recipe = Recipe(sources, split_by=p["split_by"], eval_ratio=eval_ratio, seed=seed)
    return run_recipe(recipe, observation=observation), p, recipe


def cmd_mix(args):
    from mixprep.sinks.jsonl import SFT_COLS, stats_row, write_jsonl, write_stats
    from mixprep.sinks.published import publish_jsonl
    from mixprep.operators.sampling import shuffle_order
    from mixprep.operators.stats import split_counts
    from mixprep.plans.mix import funnel
    spark = _spark(args)
    mixed, p, recipe = build_mix(spark, args.base_dir, args.ext_dir, args.preset, args.eval_ratio, args.seed)
    for r in funnel(recipe, mixed).orderBy("source").collect():                # A7 (a row per source)
        print(f"[{r.source}] raw {r.n_raw} -> kept after filters and sampling: {r.n_kept} -> train {r.n_train} / eval {r.n_eval}")
    for r in split_counts(mixed, "category").collect():                        # A1 (a few rows)
        print(f"{r.category}: train {r.n_train} eval {r.n_eval}")
    out = shuffle_order(mixed, "sample_key", seed=f"{args.seed}:order")       # R1 before writing
    if args.layout == "split":
        write_jsonl(out, args.out, partition_by="split")                        # K1 + K4
    else:                                                                       # as train.jsonl and eval.jsonl
        order = F.md5(F.concat(F.lit(f"{args.seed}:order:"), F.col("sample_key")))
        publish_jsonl(spark, mixed if args.layout == "plain" else out, args.out, "split", SFT_COLS, layout=args.layout, order=(order, "sample_key"))
    if args.preset == "v2":
        write_stats(stats_row(mixed, p["max_char"], p["world_sample"], args.eval_ratio),
                    os.path.join(args.out, "_stats"))                            # K3


def cmd_generate(args):
    from mixprep.plans.generate import SAMPLE_COLS, item_samples, user_samples
    from mixprep.operators.lookup import profile_to_long
    from mixprep.plans.fixtures import PROFILE_LISTS, PROFILE_TIMES
    from mixprep.sinks.jsonl import write_jsonl
    from mixprep.sources.keyed import read_keyed_last
    from mixprep.sources.files import first_files
    spark = _spark(args)
    sids = read_keyed_last(spark, args.sid_dir, ["pid", "domain"], ["sid_three"], args.max_sid_files,
                           key_casts={"pid": "bigint"})
    caps = read_keyed_last(spark, args.caption_dir, ["pid", "domain"], ["caption"], args.max_cap_files,
                           key_casts={"pid": "bigint"})
    prof = spark.read.parquet(*first_files(spark, args.profile_dir, None, "*.parquet"))
    cols = [c for c in list(PROFILE_LISTS) + list(PROFILE_TIMES) if c in prof.columns]
    prof = prof.select(F.concat_ws(":", F.col("_metadata.file_name"), F.col("_metadata.row_index").cast("string"))
                       .alias("user_id"), *cols)
    lists = {c: d for c, d in PROFILE_LISTS.items() if c in cols}
    times = {c: d for c, d in PROFILE_TIMES.items() if c in cols}
    if args.template == "short":
        from mixprep.plans.generate import generate_short
        long_df = profile_to_long(prof, lists, times, cap=10)
        allg = generate_short(caps, sids, long_df, max_candidates=args.max_materials, max_users=args.max_users)
        parts = {"items": allg.filter(F.col("task").isin("desc2tok", "tok2desc")),
                 "users": allg.filter(F.col("task") == "next_item"), "rec": allg.filter(F.col("task") == "interest")}
    else:
        long_df = profile_to_long(prof, lists, times, cap=20)
        nxt, rec = user_samples(long_df, sids, max_users=args.max_users, order=args.event_order)
        parts = {"items": item_samples(caps, sids, args.max_materials), "users": nxt, "rec": rec}
    from mixprep.operators.generate import unknown_domain_rows
    unknown = unknown_domain_rows(caps).count()
    if unknown:                                                                            # N8 quarantine
        path = os.path.join(args.out, "_unknown_domains")
        unknown_domain_rows(caps).write.mode("overwrite").parquet(path)
        print(f"  {unknown} captions of unknown domains set aside in {path}")
    from pyspark.sql import Observation
    from mixprep.sources.files import size_bytes
    for key, df in parts.items():
        path, obs = os.path.join(args.out, GENERATED[key]), Observation(key)
        write_jsonl(df.observe(obs, F.count(F.lit(1)).alias("rows")), path, array_per_line=True,
                    cols=SAMPLE_COLS)                                                      # K2
        print(f"  {GENERATED[key]}: {obs.get['rows']} samples ({size_bytes(spark, path) / 1024 ** 2:.1f} MB)")


def _tokenizer(args):
    from mixprep.functions.subword import Subword
    return Subword(args.tokenizer) if args.tokenizer else None


def cmd_prepare(args):
    from mixprep.plans.prepare import prepare_eval, prepare_train
    from mixprep.operators.encode import pad_batches
    from mixprep.sources.jsonl import cap_per_file, read_dir, read_jsonl, staged_with_ids, with_content_key
    spark = _spark(args)
    schema = _schema("system STRING, prompt STRING, response STRING")
    weights = list(json.loads(args.sample_weights).items()) if args.sample_weights else None
    if args.landed:
        from mixprep.sources.jsonl import read_landed
        train = read_landed(spark, args.landed, args.categories)
    elif args.train_file:
        train = read_jsonl(spark, args.train_file, schema)
    else:
        cats = args.categories
        named = cats or ([k for k, _ in weights] if weights else None)
        # Files that no weight names keep all their rows, at weight 1.0.
        train = read_dir(spark, args.data_dir, categories=cats, schema=schema, other=OTHER,
                         with_category=named if args.weight_mode == "by_column" else None,
                         first=args.max_samples if args.sample_rows == "first" else None)
    train = staged_with_ids(train, "train-raw")
    raw = train.count()                                                          # A7 (from file footers)
    if args.sample_rows == "hash" or args.train_file or args.landed:
        train = cap_per_file(train, args.max_samples)
    if weights and "category" not in train.columns:
        args.weight_mode = "by_content"
    policy = "drop" if args.filter_long_samples else "truncate"
    from pyspark.sql import Observation
    kept = Observation("processed")
    tokenizer = _tokenizer(args)
    out = prepare_train(train, "sample_key", weights, args.weight_mode, args.max_seq_length, policy, args.seed, tokenizer=tokenizer)
    out = out.observe(kept, F.count(F.lit(1)).alias("rows"))
    if args.batch_size:
        out = pad_batches(out.select("draw_id", "input_ids", "attention_mask", "labels"), args.batch_size,
                          "draw_id", max_len=args.max_seq_length, seed=args.seed, **({"pad_id": tokenizer.pad_id()} if tokenizer else {}))
    out.write.mode("overwrite").parquet(os.path.join(args.out, "train"))
    print(f"raw rows: {raw}  processed rows (after resampling and filters): {kept.get['rows']}")
    if args.eval_file:
        ev = with_content_key(read_jsonl(spark, args.eval_file, schema))
        prepare_eval(ev, "sample_key", args.max_seq_length, policy, tokenizer=tokenizer).write.mode("overwrite").parquet(
            os.path.join(args.out, "eval"))


def cmd_land(args):
    from mixprep.sinks.jsonl import land_parquet
    from mixprep.sources.jsonl import read_dir
    spark = _spark(args)
    df = read_dir(spark, args.data_dir, schema=_schema("system STRING, prompt STRING, response STRING"),
                  with_category=args.categories or True, other=OTHER)
    land_parquet(df, args.out)


def cmd_analyze(args):
    from mixprep.plans.report import length_report, subtypes
    from mixprep.session import stage
    from mixprep.sources.jsonl import read_dir
    spark = _spark(args)
    if args.landed:
        from mixprep.sources.jsonl import read_landed
        df = read_landed(spark, args.landed, args.categories)
    else:
        df = read_dir(spark, args.data_dir, schema=_schema("system STRING, prompt STRING, response STRING"),
                      with_category=args.categories or True, other=OTHER)
        df = stage(df, "analyze")                                                # lines are parsed once for both tables
    rep = length_report(df, tokenizer=_tokenizer(args))
    if args.out:
        rep.coalesce(1).write.mode("overwrite").json(args.out)
    for r in rep.orderBy("category").collect():   # one row per category
        print(json.dumps(r.asDict(), ensure_ascii=False))
    for r in subtypes(df).orderBy("category", "rank").collect():   # five per category
        print(f"  [{r.category}] [{r.n}x] {r.subtype}...")


def main(argv=None):
    ap = argparse.ArgumentParser(prog="mixprep")
    ap.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    sub = ap.add_subparsers(dest="cmd", required=True)

    m = sub.add_parser("mix", help="W1/W2: mix, filter, sample and split the training set")
    m.add_argument("--preset", choices=sorted(PRESETS), default="v3")
    m.add_argument("--base_dir", required=True)
    m.add_argument("--ext_dir", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--layout", choices=["split", "folders", "plain"], default="split",
                   help="split: folders split=train, split=eval; folders: train.jsonl, eval.jsonl as folders of part files; plain: as one file each")
    m.add_argument("--eval_ratio", type=float, default=0.05)
    m.add_argument("--seed", type=int, default=42)
    m.set_defaults(fn=cmd_mix)

    g = sub.add_parser("generate", help="W3: item and user samples from item maps and user profiles")
    g.add_argument("--sid_dir", required=True)
    g.add_argument("--caption_dir", required=True)
    g.add_argument("--profile_dir", required=True)
    g.add_argument("--out", required=True)
    g.add_argument("--max-users", dest="max_users", type=int, default=20000)
    g.add_argument("--max-materials", dest="max_materials", type=int, default=10000)
    g.add_argument("--max-sid-files", dest="max_sid_files", type=int, default=None)
    g.add_argument("--max-cap-files", dest="max_cap_files", type=int, default=None)
    g.add_argument("--template", choices=["full", "short"], default="full",
                   help="full: 4 domains x 20 items, event history; short: 3 domains x 10 items (older templates)")
    g.add_argument("--event-order", dest="event_order", choices=["shuffled", "by_domain"], default="shuffled",
                   help="order of a user's events in next-item samples (full template)")
    g.set_defaults(fn=cmd_generate)

    p = sub.add_parser("prepare", help="W4: re-weight, render, tokenize, mask (and pad) the training set")
    p.add_argument("--data_dir", default="dataset")
    p.add_argument("--train_file", default=None)
    p.add_argument("--landed", default=None, help="parquet written by `land` (instead of --data_dir)")
    p.add_argument("--eval_file", default=None)
    p.add_argument("--categories", nargs="*", default=None)
    p.add_argument("--max_samples", type=int, default=None)
    p.add_argument("--sample_rows", choices=["first", "hash"], default="first",
                   help="which --max_samples rows of a file of --data_dir: the first ones (only they are read), or any, by a hash")
    p.add_argument("--sample_weights", default=None, help='e.g. \'{"懂推荐": 1.0, "懂用户": 3.0}\'')
    p.add_argument("--weight_mode", choices=["by_column", "by_content"], default="by_column")
    p.add_argument("--filter_long_samples", action="store_true")
    p.add_argument("--max_seq_length", type=int, default=8192)
    p.add_argument("--batch_size", type=int, default=None)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--tokenizer", default=None, help="tokenizer JSON file at the same path on every executor (default: the native tokenizer)")
    p.add_argument("--out", required=True)
    p.set_defaults(fn=cmd_prepare)

    land = sub.add_parser("land", help="parse a JSONL directory once into parquet partitioned by category")
    land.add_argument("--data_dir", default="dataset")
    land.add_argument("--categories", nargs="*", default=None)
    land.add_argument("--out", required=True)
    land.set_defaults(fn=cmd_land)

    a = sub.add_parser("analyze", help="W5: length and category report")
    a.add_argument("--data_dir", default="dataset")
    a.add_argument("--landed", default=None, help="parquet written by `land` (instead of --data_dir)")
    a.add_argument("--categories", nargs="*", default=None)
    a.add_argument("--tokenizer", default=None, help="tokenizer JSON file at the same path on every executor (default: the native tokenizer)")
    a.add_argument("--out", default=None)
    a.set_defaults(fn=cmd_analyze)

    args = ap.parse_args(argv)
    from mixprep import session
    before = len(session._SCRATCH)
    args.fn(args)
    session.remove_scratch(_spark(args), keep=before)   # the output is written: intermediate copies go
