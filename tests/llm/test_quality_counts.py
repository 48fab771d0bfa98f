"""What the rules ask of a line is counted once, in characters."""

import re

from pyspark.sql import functions as F

from tidewright.llm import quality


def test_counts_once(spark):
    lines = ["one two  three.", "漢字 🙂🙂 \x0b x", "é é\r \t", "#*$%&|<>", "\x1c\x85  ", "click here to use cookies, all rights reserved"]
    frame = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "k int, x string")
    got = {r["k"]: (r["words"], r["visible"], r["marked"]) for r in frame.select("k", *[c.alias(n) for n, c in quality._counts(F.col("x")).items()]).collect()}
    assert got == {k: (len(re.findall(r"[^\x20\x09-\x0D]+", x)), len(re.findall(r"[^\x20\x09-\x0D]", x)), bool(re.search(quality.MARKS, x))) for k, x in enumerate(lines)}
    plan = quality.judge(frame, "x")._jdf.queryExecution().analyzed().toString()
    assert plan.count(quality.VISIBLE + "+") == 1
