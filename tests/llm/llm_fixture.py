"""Rows of the small documents table of these tests."""

import random

from pyspark.sql import types as T

WORDS = [a + b for a in ("ba", "co", "di", "fu", "ge", "ha", "ki", "lo", "mu", "ne") for b in ("ra", "so", "ti", "vu", "wen", "xol", "ze")]
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    # extra columns with names that operators use inside
    T.StructField("size", T.StringType()), T.StructField("row", T.LongType()), T.StructField("n", T.StringType()),
    T.StructField("root", T.StringType()), T.StructField("shard", T.StringType()), T.StructField("rate", T.StringType()),
    T.StructField("place_file", T.StringType()), T.StructField("words", T.StringType()),
])


def sentence(r, n):
    return " ".join(r.choice(WORDS) for _ in range(n))


def make_rows():
    r = random.Random(5)
    long = "\n".join(sentence(r, 25) for _ in range(40))
    out = []
    for i in range(30):
        out.append((i, "\n".join(sentence(r, 30) for _ in range(r.randint(1, 8)))))
    base = sentence(r, 120)
    for i in range(30, 42):  # near copies: one word changed each
        w = base.split()
        w[r.randrange(len(w))] = f"new{i}"
        out.append((i, " ".join(w)))
    out += [(50, base), (51, base), (52, base.upper()), (53, long), (54, long + "\n" + sentence(r, 60)),
            (55, long.replace("\n", "\r\n")), (60, None), (61, ""), (62, "   \n\t"), (63, "…"), (64, "one"), (65, "ONE"),
            (66, "two words"), (67, "a" * 30_000), (68, "x " * 4000), (69, "é" * 250 + " naïve 𝄞 " + base[:300])]
    out += [(70, out[0][1]), (70, out[0][1]), (None, out[1][1]), (None, None), (71, base[:250] + " " + sentence(r, 40)), (72, sentence(r, 40) + " " + base[:250])]
    return out


ROWS = make_rows()
