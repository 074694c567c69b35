"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Every rule votes good (1), bad (-1) or abstains (0) on every document. Which votes go together tells how far each rule
can be trusted: a two-class model with two error rates per rule is fitted by expectation-maximisation, and a document
is kept if its posterior probability of being good is at least one half. One vote against a document that all other
rules like does not remove it, several that tend to come together do; where all abstain, the share of good documents
decides.

Everything is column expressions. The model is fitted on the counts of the vote patterns, of which there are at most
3 to the number of rules, however many documents there are; the fit is one expression over that one row.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmscout.llm.common import WORD, numbered, picked, staged

WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PCT = 20
SYMBOLS = "#*$%&|<>"
PLAIN = r"^\p{L}+[.,;:!?]?\z"
ROUNDS = 25
#: What a rule is taken to do before any data: its share of bad votes among its votes on bad and on good documents.
PRIOR_BAD, PRIOR_GOOD = 0.6, 0.02
#: Share of good documents before any data, and the weight of all these guesses as a share of the documents.
GOOD_SHARE, GUESS_SHARE = 0.85, 0.05
KEEP_FROM = 0.5

#: (name, bad if, good if) over the counts of :func:`features`; both are false for an abstention.
RULES: tuple[tuple[str, str, str], ...] = (
    ("length", "n_words < 3", "n_words >= 50"),
    ("repeated_words", "10 * n_repeat_words > n_words", "n_words >= 50 AND n_repeat_words = 0"),
    ("repeated_lines", "5 * n_dup_lines > n_lines", "n_lines >= 3 AND n_dup_lines = 0"),
    ("symbols", "5 * n_symbols > n_words", "n_words >= 20 AND 50 * n_symbols <= n_words"),
    ("symbol_runs", "5 * n_symbol_runs > n_words", "n_words >= 20 AND 50 * n_symbol_runs <= n_words"),
    ("plain_words", "10 * n_plain_words < 6 * n_words", "n_words >= 20 AND 10 * n_plain_words >= 8 * n_words"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words",
     "n_words >= 20 AND word_chars BETWEEN 3 * n_words AND 9 * n_words"),
    ("capitals", "2 * n_capitals > word_chars", "n_words >= 20 AND 10 * n_capitals < word_chars"),
    ("exclamations", "4 * n_exclaims > n_words", "n_words >= 20 AND 50 * n_exclaims <= n_words"),
    ("word_lists", "n_lines >= 5 AND n_words < 2 * n_lines", "n_words >= 20 AND n_words >= 4 * n_lines"),
)
FEATURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_capitals", "n_exclaims", "n_symbol_runs", "n_plain_words",
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def count_of(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def repeated_words(words: Column) -> Column:
    """Words in windows of five that occur at least twice in the text, the first time included."""
    hashed = lambda w: F.transform(w, lambda x: F.xxhash64(x))
    at = lambda w, i: F.get(w, i)

    def windows(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(h) - WINDOW)
        return F.transform(starts, lambda i: F.xxhash64(*[at(h, i + k) for k in range(WINDOW)]))

    def covered(w: Column) -> Column:
        ordered = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            same = lambda x, i: (at(s, i - 1)["h"] == x["h"]) | (at(s, i + 1)["h"] == x["h"])
            return F.sort_array(F.transform(F.filter(s, lambda x, i: F.coalesce(same(x, i), F.lit(False))), lambda x: x["i"]))

        def length(p: Column) -> Column:
            step = lambda acc, i: acc + F.least(F.lit(WINDOW), at(p, i) - at(p, i - 1))
            return F.aggregate(F.sequence(F.lit(1), F.size(p) - 1), F.lit(WINDOW), step)

        many = lambda p: F.when(F.size(p) > 1, length(p)).otherwise(0)
        return let(let(ordered, positions), many)

    # Texts without a repeat, nearly all, need neither positions nor their order.
    repeats = lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), covered(w)).otherwise(0)
    long_enough = lambda w: F.when(F.size(w) > WINDOW, let(let(hashed(w), windows), repeats)).otherwise(0)
    return long_enough(words)


def features(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts in ``FEATURES`` in one struct column ``_q``; a null text counts as empty."""
    text = F.coalesce("text", F.lit(""))
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def lines(ls: Column) -> tuple[Column, Column]:
        return F.size(ls), F.size(ls) - F.size(F.array_distinct(ls))

    def counted(t: Column, words: Column, ls: Column) -> Column:
        n_lines, dup = lines(ls)
        bare = F.length(F.translate(t, " \t\n\x0b\x0c\r", ""))
        values = {
            "n_words": F.size(words),
            "word_chars": bare,
            "n_symbols": count_of(t, SYMBOLS),
            "n_dup_lines": dup,
            "n_repeat_words": repeated_words(words),
            "n_lines": n_lines,
            "n_capitals": count_of(t, capitals),
            "n_exclaims": count_of(t, "!"),
            "n_symbol_runs": F.regexp_count(t, F.lit(f"[{SYMBOLS}]+")),
            "n_plain_words": F.size(F.filter(words, lambda w: w.rlike(PLAIN))),
        }
        return F.struct(*[values[k].cast("long").alias(k) for k in FEATURES])

    full = lambda t: F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    every = let(F.struct(words.alias("w"), full(text).alias("l")), lambda x: counted(text, x["w"], x["l"]))
    return docs.withColumn("_q", every)


def votes(counts: str = "_q") -> Column:
    """The votes of all rules as an array of -1, 0 and 1."""
    out = []
    for _, bad, good in RULES:
        bad, good = (F.expr(_of(counts, x)) for x in (bad, good))
        out.append(F.when(bad, -1).when(good, 1).otherwise(0))
    return F.array(*out)


def _of(counts: str, rule: str) -> str:
    return re.sub(r"\b(" + "|".join(FEATURES) + r")\b", rf"`{counts}`.\1", rule)


def base_failed(counts: str = "_q") -> Column:
    return F.expr(_of(counts, f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PCT} * n_words"))


def fit(patterns: DataFrame) -> DataFrame:
    """Posterior of every vote pattern: ``votes, p_good`` from ``votes, n``, one row per pattern.

    A rule says nothing where it abstains; where it votes, ``b`` and ``g`` are its shares of bad votes on bad and on
    good documents. The pattern table is gathered in one row (at most 3 to the number of rules entries), sorted so
    that sums are made in the same order every time, and the rounds of expectation-maximisation fold over it.
    """
    rules = f"sequence(0, {len(RULES) - 1})"
    # The log odds of being good that a pattern v has under a model m.
    odds = f"""(ln(m.good) - ln(1 - m.good) + aggregate({rules}, 0D, (a, j) -> a + CASE get(v, j)
        WHEN -1 THEN ln(get(m.g, j) / get(m.b, j)) WHEN 1 THEN ln((1 - get(m.g, j)) / (1 - get(m.b, j))) ELSE 0D END))"""
    posterior = lambda m, v: f"get(transform(array(struct({m} AS m, {v} AS v)), e -> 1 / (1 + exp(-{odds.replace('m.', 'e.m.').replace('get(v,', 'get(e.v,')}))), 0)"
    total = lambda value, test="true": f"aggregate(w, 0D, (a, r) -> a + CASE WHEN {test} THEN {value} ELSE 0D END)"
    # Shares of bad votes among a class's votes, drawn towards the guess.
    share = lambda mass, guess, held: f"""transform({rules}, j ->
        ({total(mass, "get(r.votes, j) = -1")} + k * {held}D * {guess}D) / ({total(mass, "get(r.votes, j) <> 0")} + k * {held}D))"""  # noqa: E731
    model = f"""named_struct(
        'good', ({total("r.g")} + k * {GOOD_SHARE}D) / ({total("r.n")} + k),
        'b', {share("r.n - r.g", PRIOR_BAD, round(1 - GOOD_SHARE, 6))},
        'g', {share("r.g", PRIOR_GOOD, GOOD_SHARE)})"""
    weighed = f"transform(rows, r -> named_struct('votes', r.votes, 'n', r.n, 'g', r.n * {posterior('s', 'r.votes')}))"
    step = f"get(transform(array({weighed}), w -> {model}), 0)"
    first = f"""named_struct('good', {GOOD_SHARE}D, 'b', array_repeat({PRIOR_BAD}D, {len(RULES)}),
        'g', array_repeat({PRIOR_GOOD}D, {len(RULES)}))"""
    entries = F.sort_array(F.collect_list(F.struct("votes", F.col("n").cast("double").alias("n"))))
    rows = patterns.groupBy().agg(entries.alias("rows"), (F.sum("n") * GUESS_SHARE).alias("k")).where("size(rows) > 0")
    fitted = rows.selectExpr("rows", f"aggregate(sequence(1, {ROUNDS}), {first}, (s, i) -> {step}) AS model")
    return fitted.selectExpr(f"inline(transform(rows, r -> struct(r.votes AS votes, {posterior('model', 'r.votes')} AS p_good)))")


def judged(counted: DataFrame) -> DataFrame:
    """``counted`` (with ``_q``) and ``_base_failed, _p_good, _kept``.

    The join is on the votes, with at most 3 to the number of rules rows on the other side, hence the broadcast.
    """
    voted = counted.withColumn("_votes", votes())
    model = fit(voted.groupBy(F.col("_votes").alias("votes")).agg(F.count("*").alias("n")))
    model = F.broadcast(model.select(F.col("votes").alias("_votes"), F.col("p_good").alias("_p_good")))
    out = voted.join(model, "_votes").drop("_votes").withColumn("_base_failed", base_failed())
    # One condition that needs the posterior: the base rule alone would be pushed below the join, and the counts with it.
    return out.withColumn("_kept", F.when(F.col("_base_failed"), False).otherwise(F.col("_p_good") >= KEEP_FROM))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, all columns as they are.

    Null and empty texts fail the base rule. Equal rows are judged alike, extra columns pass through, no rows give
    no rows.
    """
    held = numbered(docs, "text")
    return judged(features(held)).where("_kept").select(*held.columns).toDF(*docs.columns)


def report(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed`` and ``kept`` for every row of ``docs``.

    The counts are staged: they are narrow, and both the fit and the result need them.
    """
    counted = staged(features(picked(docs, "doc_id", "text")).select("doc_id", "_q"))
    out = judged(counted)
    kept = [F.col("_q")[c].alias(c) for c in FEATURES[:5]]
    return out.select("doc_id", *kept, F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"))
