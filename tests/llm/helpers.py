"""Small tables for the tests of this folder."""

from __future__ import annotations

import random

import corpus_pipeline  # noqa: F401  the pipeline goes with these tests

SYLLABLES = "ba ko ri mu te sa lo ne vi du ga po shi ran tel mor".split()


def prose(seed, words=120):
    """Invented words in lines of a dozen."""
    rng = random.Random(seed)
    out = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(words)]
    return "\n".join(" ".join(out[i : i + 12]).capitalize() + "." for i in range(0, words, 12))


def documents(spark, rows, extra=False):
    """``doc_id, text, lang, source, n_chars`` from (id, text[, source[, lang]]) rows, over several partitions."""
    data = []
    for row in rows:
        doc, text, source, lang = (*row, *("src", "xx")[len(row) - 2 :])
        data.append((doc, text, lang, source, len(text) if text is not None else None))
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        # Names that operators use inside, and one that differs from a given one in case only.
        for name in ("_key", "_q", "_kept", "_gone", "word", "block", "src", "place", "kept", "leaf", "TEXT"):
            df = df.toDF(*[f"_{i}" for i in range(len(df.columns))]).selectExpr("*", "'x' AS extra").toDF(*df.columns, name)
    return df.repartition(3) if rows else df


EDGES = [(900, None), (901, ""), (902, " \n\t "), (None, "no id at all here"), (903, "word")]
