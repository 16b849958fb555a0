"""Awkward documents: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

import random

rng = random.Random(5)
WORDS = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa", "Straße", "été", "日本"]


def prose(n: int, seed: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(400)) for _ in range(n))


BASE = prose(60, 1)
DOCS = [
    (0, None, "s1"),
    (1, "", None),
    (2, " \n\t ", "s1"),
    (3, "one", "s2"),
    (4, "one two three", None),
    (5, "ONE Two three", "s2"),
    (6, BASE, "s1"),
    (7, BASE, "s3"),
    (8, BASE.replace(" ", "\n", 5), "s3"),
    (9, BASE + " tail", "s1"),
    (10, prose(25, 3) + " " + " ".join(BASE.split()[10:45]) + " " + prose(25, 4), "s2"),
    (11, "word " * 3000, "s2"),
    (12, "x" * 20000, "s2"),
    (13, prose(4000, 9), "s1"),
    (14, "nul \x00 in   text   <|im_end|> <s> \U0001f600 é̃", "s4"),
    (15, BASE, "s1"),
    (15, BASE, "s1"),
    (None, prose(30, 12), None),
    (None, BASE, "s2"),
    (17, prose(200, 13), "s1"),
    (18, " ".join(prose(200, 13).split()[:-8]) + " " + prose(8, 14), "s1"),
]


def documents(spark, rows=DOCS):
    """With extra columns whose names clash with those the operators use."""
    return spark.createDataFrame([(i, t, s, 1, "a", 2.0, 7) for i, t, s in rows], "doc_id long, text string, source string, shard int, node string, score double, copies int")


def empty(spark):
    return documents(spark, []).repartition(1)
