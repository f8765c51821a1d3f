"""Small document tables with every awkward case, and brute-force versions of the operators."""

from __future__ import annotations

import random

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

DOC_SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("label", T.IntegerType()), T.StructField("fp", T.StringType())]
)


def awkward_rows() -> list[tuple]:
    rng = random.Random(7)
    words = [f"w{i}" for i in range(300)]
    long = " ".join(rng.choice(words) for _ in range(6000))
    base = " ".join(rng.choice(words) for _ in range(400))
    texts = [None, "", " ", "\n\t ", "one", "two words", "a b c", "A b  C", "a\tb c", "a b c ", long, long, long.upper(), base, base, base + " tail", base.replace("w1 ", "w2 ", 1), "naïve café İ ß ² ª", "日本語 テキスト", "x" * 5000, "It's  don't 12ab _x_ <|endoftext|> y", "\x1f odd \x85 space\xa0here", "é combining"]
    rows = [(i, t, None if i % 3 else "en", None if i % 4 else "s", None if t is None else len(t), i, "clash") for i, t in enumerate(texts)]
    return [*rows, (None, "one", None, None, None, None, None), (3, "\n\t ", None, None, None, None, None), (50, base, "en", "s", 1, 0, "clash")]


def docs_of(spark, rows):
    return spark.createDataFrame(rows, DOC_SCHEMA)


def components_by_force(fps: list[int], radius: int) -> list[int]:
    up = list(range(len(fps)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]
