"""Rows and words for the tests of this folder."""

import random
import re

#: Columns that clash with names the operators use inside.
EXTRA = "i long, t string, k long, row long, key string, size long, learn boolean, spans string, copies long, x string"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + EXTRA
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, (text or "").translate(LOWER))


def prose(seed, n):
    """``n`` words of a small invented language."""
    rng = random.Random(seed)
    parts = ["th", "er", "on", "an", "re", "ti", "es", "nd", "ha", "ou"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n))


def as_docs(spark, rows):
    """Rows (doc_id, text[, lang, source]) as a documents table with extra columns."""
    full = [(*r, *("en", "src1")[len(r) - 2:], len(r[1]) if r[1] else 0, 1, "x", 2, 3, "y", 4, True, "z", 5, "w") for r in rows]
    return spark.createDataFrame(full, SCHEMA)
