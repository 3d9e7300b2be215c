"""Quality by weak supervision (DataFrame only): rules vote or abstain,
expectation-maximisation estimates each rule's accuracy, and the posterior
probability of good quality decides, instead of all rules having to pass.

Rules vote +1 (good) or -1 (bad) on measures of one text, or abstain. Rows are
counted by vote pattern -- at most 2 ** len(RULES) patterns, however many
documents there are -- and each EM step is one aggregate over that table; only
the per-rule parameters come to the driver. The model: a text is good with
probability ``prior``; each rule votes with its own rate on good and on bad
texts, so its accuracy is the share of its votes that fall on the right class.
One defect is evidence, not a verdict: rules that speak for the text weigh
against it by the accuracies found. The starting rates keep a fixed weight, so
that a rule that hardly ever votes stays near them.

Defined cases: a null text counts as empty; it has no words, all measures are
0 and it fails the base rule. An empty table keeps the starting parameters.
All words of a text count, whatever its length; nothing is sampled.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, fresh, materialize

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """Votes where ``when`` holds, and abstains elsewhere. ``good`` and ``bad``
    are where EM starts: the share of good and of bad texts that get the vote."""
    name: str
    vote: int
    when: str
    good: float
    bad: float


#: most rules name one defect, a few speak for a text; words >= 1 where they are asked
RULES = (
    Rule("symbols", -1, "n_symbols > 0.2 * n_words", 0.02, 0.3),
    Rule("upper", -1, "n_upper > 0.4 * n_letters", 0.02, 0.3),
    Rule("bars", -1, "n_bars > 0.15 * n_words", 0.02, 0.3),
    Rule("repeats", -1, "n_repeat_words > 0.3 * n_words", 0.02, 0.3),
    Rule("lines", -1, "n_dup_lines > 0.3 * n_lines", 0.02, 0.3),
    Rule("narrow", -1, "n_distinct < 0.1 * n_words", 0.02, 0.3),
    Rule("glued", -1, "word_chars > 15 * n_words", 0.02, 0.1),
    Rule("no_sentences", -1, "n_ends < 0.005 * n_words", 0.02, 0.2),
    Rule("sentences", 1, "n_ends between 0.01 * n_words and 0.5 * n_words", 0.9, 0.6),
    Rule("letters", 1, "n_letters > 0.85 * word_chars and n_upper < 0.3 * n_letters", 0.9, 0.6),
    Rule("varied", 1, "n_distinct > 0.3 * n_words", 0.9, 0.6),
)
#: weight of the starting rates against what the texts show
PRIOR_WEIGHT = 0.25


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measures of each text, by expressions on its own row."""
    body, words, lines, grams, pairs, reps = fresh(docs, "q_body", "q_words", "q_lines", "q_grams", "q_pairs", "q_reps")
    out = docs.withColumn(body, F.coalesce(F.col(text), F.lit("")))
    out = out.withColumn(words, F.filter(F.split(body, SPACE), lambda w: w != ""))
    out = out.withColumn(lines, F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    out = (out.withColumn("n_words", F.size(words).cast("long"))
           .withColumn("word_chars", F.length(F.regexp_replace(body, SPACE, "")).cast("long"))
           .withColumn("n_symbols", _count(body, r"[^#*$%&|<>]+"))
           .withColumn("n_lines", F.size(lines).cast("long"))
           .withColumn("n_dup_lines", (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))
           .withColumn("n_upper", _count(body, r"\P{Lu}+"))
           .withColumn("n_letters", _count(body, r"\P{L}+"))
           .withColumn("n_bars", _count(body, r"[^|]+"))
           .withColumn("n_ends", _count(body, r"[^.!?]+"))
           .withColumn("n_distinct", F.size(F.array_distinct(words)).cast("long")))
    # 3-word windows with their places, sorted: equal ones are neighbours. First
    # by a 64-bit hash (numbers sort fast), then those found twice by their words.
    at = F.sequence(F.lit(0), F.col("n_words").cast("int") - 3)
    window = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(3)])
    out = out.withColumn(grams, F.when(F.col("n_words") >= 3, F.transform(at, window)))
    repeated = F.size(F.array_distinct(grams)) < F.size(grams)
    out = out.withColumn(pairs, F.when(repeated, F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("k"), i.alias("i"))))))
    out = out.withColumn(reps, F.sort_array(F.transform(_twins(pairs), lambda p: F.struct(
        F.concat_ws(" ", *[F.get(words, p["i"] + k) for k in range(3)]).alias("k"), p["i"].alias("i")))))
    out = out.withColumn(pairs, F.sort_array(F.transform(_twins(reps), lambda p: p["i"])))
    # each repeated window covers 3 words, or as many as the next one lets it
    covered = F.aggregate(F.transform(pairs, lambda p, i: F.least(
        F.lit(3), F.coalesce(F.get(pairs, i + 1) - p, F.lit(3)))), F.lit(0), lambda s, x: s + x)
    return out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop(
        body, words, lines, grams, pairs, reps)


def _count(body: str, others: str) -> Column:
    """Characters of ``body`` left once runs of ``others`` are taken out."""
    return F.length(F.regexp_replace(body, others, "")).cast("long")


def _twins(name: str) -> Column:
    """Entries of a sorted (k, i) array whose k a neighbour shares."""
    arr = F.col(name)
    return F.filter(arr, lambda p, i: (F.get(arr, i - 1)["k"] == p["k"]) | (F.get(arr, i + 1)["k"] == p["k"]))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def votes(measured: DataFrame, rules=RULES, name: str = "votes") -> DataFrame:
    """Adds the vote pattern, one digit per rule: 1 where it votes, else 0."""
    digits = [F.when((F.col("n_words") > 0) & F.expr(r.when), F.lit("1")).otherwise(F.lit("0")) for r in rules]
    return measured.withColumn(name, F.concat(*digits))


@dataclass(frozen=True)
class Model:
    """Share of good texts, and per rule how often it votes on good and bad ones."""
    prior: float
    rates: tuple

    def accuracy(self, rules=RULES) -> dict[str, float]:
        """Share of each rule's votes that are right."""
        out = {}
        for r, (good, bad) in zip(rules, self.rates):
            good, bad = good * self.prior, bad * (1 - self.prior)
            out[r.name] = (good if r.vote > 0 else bad) / (good + bad)
        return out

    def posterior(self, pattern: Column) -> Column:
        """Probability that a text with this vote pattern is good."""
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for k, (good, bad) in enumerate(self.rates):
            yes, no = math.log(good / bad), math.log((1 - good) / (1 - bad))
            total = total + F.when(F.substring(pattern, k + 1, 1) == "1", F.lit(yes)).otherwise(F.lit(no))
        return 1 / (1 + F.exp(-total))


def fit(patterns: DataFrame, rules=RULES, name: str = "votes", rounds: int = 25) -> Model:
    """EM over the table of vote patterns with their counts (``n``).

    Each round is one aggregate: the expected good texts, and per rule the
    votes on all and on good texts.
    """
    model = Model(0.8, tuple((r.good, r.bad) for r in rules))
    for _ in range(rounds):
        good = F.col("n") * model.posterior(F.col(name))
        cast = [F.sum(F.when(F.substring(name, k + 1, 1) == "1", x)).alias(f"{c}{k}")
                for k in range(len(rules)) for c, x in (("g", good), ("a", F.col("n")))]
        row = patterns.agg(F.sum("n").alias("all"), F.sum(good).alias("good"), *cast).first().asDict()
        every, fine = float(row["all"] or 0), row["good"] or 0.0
        rates = []
        for k, r in enumerate(rules):
            g, a = row[f"g{k}"] or 0.0, row[f"a{k}"] or 0
            rates.append((_rate(g, fine, r.good), _rate(max(a - g, 0.0), max(every - fine, 0.0), r.bad)))
        new = Model((fine + 4) / (every + 5), tuple(rates))
        done = max(abs(x - y) for a, b in zip(new.rates, model.rates) for x, y in zip(a, b)) < 1e-4
        model = new
        if done:
            break
    return model


def _rate(votes: float, texts: float, start: float) -> float:
    weight = PRIOR_WEIGHT * texts + 1
    return (votes + weight * start) / (texts + weight)


def _pattern_counts(table: DataFrame, name: str) -> DataFrame:
    return materialize(table.groupBy(name).agg(F.count("*").alias("n")).coalesce(1), "patterns")


def assess(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """doc_id, measures, base_failed, posterior and kept per row of ``docs``."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    table = votes(measures(slim)).withColumn("base_failed", base_failed())
    table = materialize(table.select("doc_id", *MEASURES, "base_failed", "votes"), "quality")
    model = fit(_pattern_counts(table.filter(~F.col("base_failed")), "votes"))
    out = table.withColumn("posterior", model.posterior(F.col("votes")))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))


def keep_good(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that the rules reject; same columns."""
    mark, = fresh(docs, "q_votes")
    inner = [f"c{i}" for i in range(len(docs.columns))]  # any column name may clash with a measure
    body = inner[docs.columns.index(text)]
    # written before anything is filtered: a filter would be pushed below the
    # measures and compute them again
    table = votes(measures(docs.toDF(*inner), body), name=mark).withColumn(mark, F.when(~base_failed(), F.col(mark)))
    table = materialize(table.select(*inner, mark), "quality").filter(F.col(mark).isNotNull())
    model = fit(_pattern_counts(table, mark), name=mark)
    return table.filter(model.posterior(F.col(mark)) >= threshold).select(*inner).toDF(*docs.columns)
