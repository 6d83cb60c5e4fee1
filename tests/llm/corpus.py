"""Small corpora for the tests: nulls, empty and long texts, ties, repeated rows, clashing column names."""

import random

WORDS = "alpha beta gamma delta épsilon zeta eta theta iota kappa lambda mu".split()


def prose(rng, words):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(60)) for _ in range(words))


def texts(seed=1):
    rng = random.Random(seed)
    base = [prose(rng, 60) for _ in range(6)]
    shared = prose(rng, 25)
    out = [None, "", "  \n", "one", "a b c d", base[0], base[0], base[0].upper(), "De " * 80, "De " * 40 + "end", prose(rng, 3000)]
    out += [f"{b} {shared} {prose(rng, 10)}" for b in base]
    for b in base[:3]:
        w = b.split()
        w[30] = "changed"
        out.append(" ".join(w))
    out += [f"line\n{shared}\nline\nline", "x   y  \t z", "tab\tand\r\nbreak  "]
    return out


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, rest int, units int, marks string"


def table(spark, seed=1, repeat=True):
    """Documents with extra columns whose names the operators use inside."""
    rows = [(i, t, "en", "s", 0 if t is None else len(t), "r", i, 1, None) for i, t in enumerate(texts(seed))]
    if repeat:
        rows += [rows[5], rows[5], (None, "without an id", None, None, None, None, None, None, None)]
        rows += [(None, None, None, None, None, None, None, None, None)] * 2
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
