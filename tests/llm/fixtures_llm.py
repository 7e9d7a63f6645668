"""Small tables with every awkward case: null columns, empty and very long texts, ties,
repeated rows, ids used twice, extra columns whose names the operators use inside."""

import random

CLASH = "size long, key long, fp long, rank long, copies long, pid int, pos int, n long, line int, root long, h1 long, score long, shard int"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}"
WORDS = [a + b for a in ("ka", "lo", "mi", "tere", "suno", "va") for b in ("ra", "ne", "stil", "po", "quin", "da", "zu")]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def rows(seed=3, n=60):
    rng = random.Random(seed)
    base = [sentence(rng, rng.randrange(5, 60)) + "\n" + sentence(rng, rng.randrange(3, 40)) for _ in range(n)]
    out = [(i, base[i], rng.choice(["en", "de", None]), rng.choice(["a", "a", "b", "ç", None])) for i in range(n)]
    at = n
    for i in range(0, 12):  # exact and near copies
        out.append((at, base[i], "en", "a"))
        out.append((at + 1, base[i].replace(base[i].split()[3], "changed", 1), "en", "b"))
        at += 2
    out += [(at, None, None, None), (at + 1, "", "en", "a"), (at + 2, "   \n\t \n", "en", "b"), (at + 3, "x", "en", "a"),
            (at + 4, sentence(rng, 20000), "en", "a"), (at + 5, "one\r\ntwo three \U0001f600 <|endoftext|> é", "en", "ç"),
            (at + 6, "!!! ???\n!!! ???\n\n", "en", "b"), (None, base[0], "en", "a"), (None, None, None, None), (None, base[5] + " tail", "en", None)]
    out += [(7, base[7], out[7][2], out[7][3])] * 2 + [(8, base[9], "en", "b")]  # a row three times; an id with two texts
    return [(d, t, la, s, None if t is None else len(t), *([1] * 13)) for d, t, la, s in out]


def docs(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
