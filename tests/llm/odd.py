"""A small table with everything that may come: nulls, empty and long texts, ties, repeated rows, clashing names."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "key string, row int, node double, score string, words string, measure int, matches int, spans string"
)


def prose(seed, n, words=("alpha", "beta", "gamma", "delta", "mu", "pi", "rho", "tau", "phi", "chi", "psi", "omega")):
    pick = random.Random(seed)
    return " ".join(pick.choice(words) + str(pick.randrange(40)) for _ in range(n))


def rows():
    base = prose(1, 120)
    changed = base.split()
    changed[30] = "other"
    extra = ("k", 1, 0.5, "s", "w", 7, 1, "x")
    texts = [
        (0, base), (1, " ".join(changed)), (2, base), (2, base), (3, None), (4, ""), (4, ""), (None, "no id here at all, none"),
        (None, None), (5, "1234 5678"), (6, "Ünïcödé 日本語 text <|endoftext|> ends"), (7, prose(2, 30_000)), (8, "a" * 20_000),
        (9, "one two"), (10, prose(3, 60) + " " + " ".join(base.split()[40:100])),
    ]
    return [(i, t, "en" if i != 6 else None, None if i == 3 else "s", len(t) if t else None, *extra) for i, t in texts]


def table(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
