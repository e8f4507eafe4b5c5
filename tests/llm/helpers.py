"""Small tables with everything that may go wrong, and what brute force says about them."""

from __future__ import annotations

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho".split()

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(draw: random.Random, n: int) -> str:
    return " ".join(draw.choice(WORDS) + str(draw.randint(0, 40)) for _ in range(n))


def documents(spark, texts, lang=None, extra=False):
    """``documents`` rows from texts; ids are positions unless pairs are given."""
    pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    rows = [(i, t, lang, "s", len(t) if t else None) for i, t in pairs]
    df = spark.createDataFrame(rows, SCHEMA)
    return with_clashes(df) if extra else df


def with_clashes(df):
    """Columns named like those that operators use inside."""
    names = ["v", "label", "key", "band", "part", "side", "sig", "_bad_id", "_gone", "text_hash", "pos", "size"]
    return df.selectExpr("*", *[f"'x' AS `{n}`" for n in names])


def odd_texts(draw: random.Random) -> list:
    """NULL, empty, blank, one word, only marks, very long, and two equal ones."""
    long = sentence(draw, 30_000)
    return [None, "", " \n\t ", "word", "!!! ??? ...", long, long, "é ü ß 漢字 <|endoftext|>", "\x00\x1f\x85"]
