"""Shared frames and brute-force pieces of the text tests."""

import random

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANKS = " \t\n\r\x0b\x0c"


def words_of(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c in BLANKS:
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out


def prose(seed, n, vocabulary=40):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def frame(spark, rows):
    """Documents with columns whose names clash with those of results."""
    return spark.createDataFrame([(i, t, "x", 1, True) for i, t in rows], "doc_id long, text string, score string, start int, kept boolean")
