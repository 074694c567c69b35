"""Language identification with error-correcting output codes.

Every language gets a codeword. One binary classifier per bit, a naive Bayes model over hashed byte trigrams, tells the
languages with a 1 from those with a 0. A text's margins are compared with all codewords by a logistic loss, each bit
weighted by how often it is right for that language on the training texts; the codeword with the least loss wins, and
texts whose two best codewords are close are flagged.

What reaches the driver is one count per language and trigram slot and one accuracy per language and bit. Languages
are taken to be few (a model has ``SLOTS`` numbers per bit); texts are read whole, twice.
"""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmscout.llm.common import picked, staged

SLOTS = 1 << 16
ALPHA = 0.5
CHUNK = 1 << 20
#: Margins are means over trigrams; this many trigrams' worth of evidence enters the loss.
EVIDENCE = 5.0
#: Two best languages closer than this in probability make a text ambiguous.
AMBIGUOUS = 0.2
UNKNOWN = "und"

_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32


def trigram_slots(data: bytes) -> np.ndarray:
    """The slot of every byte trigram, A-Z lower-cased; the text has a space at either end."""
    b = _LOWER[np.frombuffer(b" " + data + b" ", dtype=np.uint8)]
    packed = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return ((packed * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int32)


def codewords(n: int, seed: int = 1) -> np.ndarray:
    """``n`` codewords of -1 and 1. Up to six languages get all dichotomies, more a seeded random code."""
    if n <= 1:
        return np.ones((n, 1), dtype=np.int8)
    if n <= 6:
        columns = [(1, *rest) for rest in itertools.product((1, -1), repeat=n - 1) if -1 in rest]
        return np.array(columns, dtype=np.int8).T
    rng, bits, best = random.Random(seed), math.ceil(10 * math.log2(n)), None
    for _ in range(200):
        code = np.array([[rng.choice((-1, 1)) for _ in range(bits)] for _ in range(n)], dtype=np.int8)
        if (abs(code.sum(axis=0)) == n).any():
            continue
        apart = min(int((a != b).sum()) for a, b in itertools.combinations(code, 2))
        if best is None or apart > best[0]:
            best = apart, code
    return best[1]


def slot_counts(rows: DataFrame) -> DataFrame:
    """``lang, slot, n`` over all rows of ``rows`` (``lang, text``), summed within tasks before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = text.as_buffer().to_pybytes()
                found = sums.setdefault(lang, np.zeros(SLOTS, dtype=np.int64))
                for at in range(0, max(1, len(data)), CHUNK):  # trigrams over a cut are few
                    found += np.bincount(trigram_slots(data[at : at + CHUNK]), minlength=SLOTS)
        for lang, found in sums.items():
            slots = np.flatnonzero(found)
            yield pa.RecordBatch.from_pydict(
                {"lang": [lang] * len(slots), "slot": slots.astype(np.int32), "n": found[slots]},
                schema=pa.schema([("lang", pa.string()), ("slot", pa.int32()), ("n", pa.int64())]),
            )

    return rows.mapInArrow(run, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))


def fit(rows: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages by code point, their codewords and the weight of every trigram slot in every bit."""
    counts = slot_counts(rows).toPandas()  # languages times slots at most
    langs = sorted(counts["lang"].unique())
    code = codewords(len(langs))
    share = np.zeros((len(langs), SLOTS))
    for i, lang in enumerate(langs):
        own = counts[counts["lang"] == lang]
        share[i, own["slot"]] = own["n"]
        share[i] = (share[i] + ALPHA) / (share[i].sum() + ALPHA * SLOTS)
    bits = code.shape[1] if langs else 0
    weights = np.zeros((bits, SLOTS), dtype=np.float32)
    for bit in range(bits):
        one, zero = share[code[:, bit] > 0], share[code[:, bit] < 0]
        if len(one) and len(zero):
            weights[bit] = np.log(one.mean(axis=0)) - np.log(zero.mean(axis=0))
    return langs, code, weights


def margins(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``docs`` (last column ``text``) with the texts replaced by their mean margin for every bit."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    kept = docs.columns[:-1]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            texts = [x.as_buffer().to_pybytes() if x.is_valid else b"" for x in batch.column(len(kept))]
            out = np.zeros((len(texts), len(table)))
            at = 0
            while at < len(texts):  # texts of about a chunk together, a longer one alone
                end, total = at + 1, len(texts[at])
                while end < len(texts) and total + len(texts[end]) <= CHUNK:
                    total += len(texts[end])
                    end += 1
                slots = [trigram_slots(t) for t in texts[at:end]]
                sizes = np.array([len(s) for s in slots])
                starts, slots = np.cumsum(sizes) - sizes, np.concatenate(slots)
                full = sizes > 0
                for bit, weight in enumerate(table):
                    if full.any():
                        sums = np.add.reduceat(weight[slots], starts[full], dtype=np.float64)
                        out[at:end, bit][full] = sums / sizes[full]
                at = end
            arrays = [*batch.columns[: len(kept)], pa.array(list(out), type=pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "margins"])

    return docs.mapInArrow(run, f"{kinds}, margins array<double>")


def decode(scored: DataFrame, langs: list[str], code: np.ndarray) -> DataFrame:
    """Loss-weighted decoding in column expressions; ``scored`` has ``lang, learn, known, margins``."""
    bits = range(code.shape[1] if langs else 0)
    known = F.element_at(
        F.create_map(*[F.lit(x) for i, lang in enumerate(langs) for x in (lang, i)]), F.col("lang")
    ) if langs else F.lit(None)
    trained = scored.where("learn").withColumn("_i", known)
    right = [
        F.sum((F.col("margins")[b] * F.element_at(F.array(*[F.lit(int(c)) for c in code[:, b]]), F.col("_i") + 1) > 0).cast("long"))
        for b in bits
    ]
    rates = {r["_i"]: r for r in trained.groupBy("_i").agg(F.count("*").alias("n"), *[x.alias(f"r{b}") for b, x in zip(bits, right)]).collect()} if langs else {}
    losses = []
    for i in range(len(langs)):
        row = rates.get(i)
        own = [((row[f"r{b}"] if row else 0) + 1) / ((row["n"] if row else 0) + 2) for b in bits]
        terms = [
            F.lit(own[b] / sum(own)) * F.log1p(F.exp(F.greatest(F.lit(-50.0), F.least(F.lit(50.0), F.col("margins")[b] * F.lit(-EVIDENCE * int(code[i, b]))))))
            for b in bits
        ]
        losses.append(F.struct(sum(terms, F.lit(0.0)).alias("loss"), F.lit(langs[i]).alias("lang")))
    if not losses:
        return scored.select("*", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("ambiguous"))
    # exp(-bits * loss) is a language's likelihood; the score is its share.
    share = lambda x: F.exp(F.lit(-float(len(bits))) * (x["loss"] - F.col("_ranked")[0]["loss"]))
    total = F.aggregate("_ranked", F.lit(0.0), lambda acc, x: acc + share(x))
    out = scored.withColumn("_ranked", F.array_sort(F.array(*losses)))
    out = out.withColumn("_best", 1 / total).withColumn(
        "_next", (share(F.col("_ranked")[1]) / total) if len(langs) > 1 else F.lit(0.0)
    )
    out = out.withColumn("lang_pred", F.when(F.col("known"), F.col("_ranked")[0]["lang"]).otherwise(UNKNOWN))
    out = out.withColumn("ambiguous", ~F.col("known") | (F.col("_best") - F.col("_next") < AMBIGUOUS))
    return out.withColumn("score", F.when(F.col("known"), F.col("_best")).otherwise(0.0)).drop("_ranked", "_best", "_next")


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, ambiguous`` for every row of ``docs`` (``doc_id, text, lang``).

    Learns from rows with a language and text whose crc32 of the id is not 2 modulo 4; a null id is not held out.
    Null texts and texts without a letter are ``und`` with score 0; if nothing can be learned, all are. Repeated rows
    are judged each, extra columns are ignored, no rows give no rows.
    """
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    rows = picked(docs, "doc_id", "lang", "text").select("doc_id", "lang", held.alias("held_out"), "text").withColumn(
        "learn", ~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    langs, code, weights = fit(rows.where("learn").select("lang", "text"))
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    scored = staged(margins(rows.select("doc_id", "lang", "held_out", "learn", letter.alias("known"), "text"), weights))
    return decode(scored, langs, code).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")
