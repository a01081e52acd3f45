import os

from mixprep.session import scratch_path
from mixprep.streaming import start_ingest


def test_stream_ingest_normalises_and_filters(spark):
    root = scratch_path(spark, "t-stream").replace("file:", "")
    src = f"{root}/in"
    os.makedirs(src)
    with open(f"{src}/a.jsonl", "w", encoding="utf-8") as f:
        f.write('{"system": "s", "prompt": "p", "response": "r"}\n')
        f.write('[{"instruction": " i ", "input": "q", "output": "a", "history": [["u", "v"]]}]\n')
        f.write('{"prompt": "' + "x" * 100 + '", "response": "y"}\n')
        f.write('{"prompt": "oops"\n')
        f.write('[{"prompt": "in a mixed array", "response": "z"}, 3]\n42\n')
    q = start_ingest(spark, src, f"{root}/out", f"{root}/ckpt", max_char=50, available_now=True)
    q.awaitTermination(120)
    rows = sorted(tuple(r) for r in spark.read.parquet(f"{root}/out").select("system", "prompt", "response").collect())
    assert rows == [("", "in a mixed array", "z"), ("i", "Previous User: u\nPrevious Assistant: v\n\nq", "a"), ("s", "p", "r")]
    assert [r.line for r in spark.read.parquet(f"{root}/out_quarantine").collect()] == ['{"prompt": "oops"']
