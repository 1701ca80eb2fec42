"""Quality rules: failures by host, shrunk with an empirical beta prior, joined back to documents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.shared import cut, fresh, lookup_join
from .text import BLANKS, let, shingles, words

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class QualityRules:
    """Limits of the rules.

    A host is rejected when a rule's shrunk failure rate exceeds ``host_rate``, or when, less ``host_deviations`` of the
    posterior's standard deviations, it is above ``host_factor`` times the prior's mean and above that mean by ``host_margin``.
    """

    min_words: int = 50
    repeat_percent: int = 50
    symbol_percent: int = 10
    dup_line_percent: int = 30
    min_mean_chars: int = 3
    max_mean_chars: int = 10
    host_rate: float = 0.5
    host_factor: float = 2.0
    host_margin: float = 0.05
    host_deviations: float = 2.0
    #: Strength of the prior, in documents, where the hosts' rates do not differ at all.
    flat_strength: float = 20.0


RULES = ("short", "repeats", "symbols", "dup_lines", "word_length")


def _repeated_words(found: Column) -> Column:
    """Words that lie in a 3-word window found twice or more; windows may overlap.

    Only texts with a repeated window sort their (window, place) pairs.
    """

    def covered(grams: Column) -> Column:
        pairs = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

        def places(q: Column) -> Column:
            same = lambda x, k: F.coalesce(F.get(q, k)["g"] == x["g"], F.lit(False))
            return F.sort_array(F.transform(F.filter(q, lambda x, k: same(x, k + 1) | ((k > 0) & same(x, F.greatest(k - 1, F.lit(0))))), lambda x: x["i"]))

        def union(p: Column) -> Column:
            steps = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
            return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

        return let(pairs, lambda q: let(places(q), union))

    grams = shingles(found, 3, lambda w: F.xxhash64(*w))
    return let(grams, lambda g: F.when(F.size(F.array_distinct(g)) < F.size(g), covered(g)).otherwise(F.lit(0)))


def quality_measures(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """``docs`` and the measures of each whole text, ``base_failed`` and one flag per rule.

    A null text counts as empty. Measures that clash with columns of ``docs`` replace them.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    squeezed = F.translate(text, BLANKS, "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    w, found = fresh("__w", docs), fresh("__l", docs)
    out = docs.withColumns({w: words(F.col("text")), found: lines})
    out = out.withColumns(
        {
            "n_words": F.size(w).cast("long"),
            "word_chars": F.length(squeezed).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size(found) - F.size(F.array_distinct(found))).cast("long"),
            "n_lines": F.size(found).cast("long"),
            "n_repeat_words": _repeated_words(F.col(w)).cast("long"),
        }
    ).drop(w, found)
    n = F.col("n_words")
    flags = {
        "short": n < rules.min_words,
        "repeats": 100 * F.col("n_repeat_words") > rules.repeat_percent * n,
        "symbols": 100 * F.col("n_symbols") > rules.symbol_percent * n,
        "dup_lines": 100 * F.col("n_dup_lines") > rules.dup_line_percent * F.col("n_lines"),
        "word_length": (F.col("word_chars") < rules.min_mean_chars * n) | (F.col("word_chars") > rules.max_mean_chars * n),
    }
    out = out.withColumns({f"fails_{k}": v for k, v in flags.items()})
    return out.withColumn("base_failed", F.col("fails_short") | F.col("fails_repeats"))


def host_verdicts(measured: DataFrame, host: str, rules: QualityRules = QualityRules()) -> DataFrame:
    """One row per host: documents, shrunk failure rate of each rule, ``host_rejected`` and ``host_excess``.

    ``host_excess`` is the most that a rule's shrunk rate, the mean of the posterior, is above the mean of the prior.

    The prior of a rule is the beta distribution with the mean and variance of the hosts' rates
    (each host weighing alike). Where these have no such distribution the mean keeps
    ``flat_strength`` documents of weight. Only that one row of moments reaches the driver.
    """
    counts = measured.groupBy(host).agg(
        F.count(F.lit(1)).alias("host_docs"),
        *(F.sum(F.col(f"fails_{r}").cast("long")).alias(f"n_{r}") for r in RULES),
    )
    counts = cut(counts)
    moments = counts.agg(*(f(F.col(f"n_{r}") / F.col("host_docs")).alias(f"{k}_{r}") for r in RULES for k, f in (("m", F.avg), ("v", F.var_pop)))).first()
    rates, over, excess = {}, F.lit(False), []
    for r in RULES:
        mean, var = moments[f"m_{r}"] or 0.0, moments[f"v_{r}"] or 0.0
        strength = mean * (1 - mean) / var - 1 if var > 1e-12 else rules.flat_strength
        strength = strength if strength > 0 else rules.flat_strength
        rates[f"rate_{r}"] = (F.col(f"n_{r}") + F.lit(mean * strength)) / (F.col("host_docs") + F.lit(strength))
        rate = F.col(f"rate_{r}")
        deviation = F.sqrt(rate * (F.lit(1.0) - rate) / (F.col("host_docs") + F.lit(strength) + F.lit(1.0)))
        over = over | (rate > F.lit(rules.host_rate)) | (rate - F.lit(rules.host_deviations) * deviation > F.lit(max(rules.host_factor * mean, mean + rules.host_margin)))
        excess.append(rate - F.lit(mean))
    return counts.withColumns(rates).select(host, "host_docs", *rates, over.alias("host_rejected"), F.greatest(*excess).alias("host_excess"))


def apply_quality_rules(docs: DataFrame, host: str = "source", rules: QualityRules = QualityRules(), carry_text: bool = True, with_excess: bool = False) -> DataFrame:
    """``docs`` with measures, rule flags, ``base_failed``, ``host_rejected`` and ``kept`` (``host_excess`` too if asked for).

    ``kept`` is false for a document that fails the base rules, and for one of a rejected host
    that itself fails some rule; a clean document stays, whatever its host. Documents without a
    host form one host. Repeated rows count each. An empty table gives an empty result.

    Measures are computed once and written to the shared folder with the columns of ``docs``
    (without ``text`` unless ``carry_text``); the host table is broadcast only up to a checked number of rows.
    """
    measured = quality_measures(docs, rules)
    measured = cut(measured if carry_text else measured.drop("text"))
    hosts = host_verdicts(measured, host, rules)
    hosts = hosts.select(host, "host_rejected", "host_excess") if with_excess else hosts.filter("host_rejected").select(host, "host_rejected")
    spread = F.struct("n_words", "word_chars", "n_symbols", "n_repeat_words")
    out = lookup_join(measured, cut(hosts), host, spread)
    failed = F.lit(False)
    for r in RULES:
        failed = failed | F.col(f"fails_{r}")
    out = out.withColumn("host_rejected", F.coalesce("host_rejected", F.lit(False)))
    return out.withColumn("kept", ~F.col("base_failed") & ~(F.col("host_rejected") & failed))
