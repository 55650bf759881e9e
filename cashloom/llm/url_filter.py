"""URL filter: host and path rules, and a character language model for the URLs that no rule fits.

The model is a ratio of two smoothed variable-order Markov models, one of accepted and one of rejected
URLs. A character's probability after its ``ORDER`` predecessors is interpolated with the one after a
predecessor less, and so on down to an even share of all characters; where a context was never seen
the shorter one decides alone. A URL's score is the mean log ratio of its characters; the threshold
is chosen on labelled URLs that the model hasn't learned from.

All counts cover all URLs. They are gathered for each different URL and each different run of
``ORDER`` + 1 characters, of which there are far fewer than rows; scores are sums of whole numbers, so
that their order doesn't matter.

Defined results: a null URL counts as empty, without host and path; equal URLs get equal verdicts;
without labelled URLs of both kinds every URL is accepted; an empty table gives an empty one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashloom.llm.storage import stored

ALLOW, BLOCK = "allow", "block"
ORDER = 4
#: Weight of the shorter context, in characters seen; characters that could come.
SMOOTHING, ALPHABET = 4.0, 256.0
#: A log ratio as a whole number; scores of a bin of the calibration.
UNITS, BINS = 1 << 20, 200
#: URLs whose MD5 starts with one of these digits are kept for the calibration: a quarter.
HELD_BACK = "0123"
PAD, STOP = "\u0002", "\u0003"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str, str]


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def with_rules(pages: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict; both null where no rule fits.

    A rule (verdict, host, path start) fits its host and all hosts below it. The longest one wins, of
    equally long ones the one with the longer host. The rules become part of the plan: some hundreds.
    """
    parts = pages.withColumn("host", host(F.col(url))).withColumn("path", path(F.col(url)))
    rule = verdict = F.lit(None).cast("string")
    for decision, name, start in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]))):
        fits = F.col("path").startswith(start) & ((F.col("host") == name) | F.col("host").endswith("." + name))
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return parts.withColumn("rule", rule).withColumn("verdict", verdict)


def _grams(url: Column) -> Column:
    """For each character and the stop after them, it and the ``ORDER`` characters before."""
    padded = F.concat(F.lit(PAD * ORDER), url, F.lit(STOP))
    return F.transform(F.sequence(F.lit(1), F.length(url) + 1), lambda i: F.substring(padded, i, F.lit(ORDER + 1)))


def log_ratios(labelled: DataFrame) -> DataFrame:
    """gram, ratio: log of its last character's probability as accepted over that as rejected, in units.

    ``labelled`` has url and weights ``accepted`` and ``rejected``, both zero for URLs not learned from.
    """
    seen = labelled.select(F.explode(_grams(F.col("url"))).alias("gram"), "accepted", "rejected")
    grams = stored(seen.groupBy("gram").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected")), "grams")
    model = grams.select("gram")
    odds = {kind: F.lit(1.0 / ALPHABET) for kind in ("accepted", "rejected")}
    for length in range(1, ORDER + 2):
        end = F.substring("gram", ORDER + 2 - length, length)
        counts = grams.groupBy(end.alias(f"end{length}")).agg(
            F.sum("accepted").alias(f"accepted{length}"), F.sum("rejected").alias(f"rejected{length}")
        )
        before = F.substring(f"end{length}", 1, length - 1)
        contexts = counts.groupBy(before.alias(f"before{length}")).agg(
            F.sum(f"accepted{length}").alias(f"all_accepted{length}"), F.sum(f"rejected{length}").alias(f"all_rejected{length}")
        )
        known = counts.join(contexts, before == F.col(f"before{length}")).drop(f"before{length}")
        model = model.join(known, end == F.col(f"end{length}")).drop(f"end{length}")
        for kind in odds:
            shorter = SMOOTHING * odds[kind]
            odds[kind] = (F.col(f"{kind}{length}") + shorter) / (F.col(f"all_{kind}{length}") + F.lit(SMOOTHING))
    ratio = F.ln(odds["accepted"] / odds["rejected"]) * UNITS
    return stored(model.select("gram", F.round(ratio).cast("long").alias("ratio")), "log-ratios")


def threshold(scored: DataFrame) -> float:
    """The score from which URLs are accepted: the bin's edge with the best mean of both hit rates.

    ``scored`` has score and weights accepted and rejected of labelled URLs; only sums of bins, whose
    number is bounded by the range of scores, are brought together.
    """
    bins = scored.groupBy(F.floor(F.col("score") * BINS).alias("bin")).agg(
        F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected")
    )
    rows = sorted((r["bin"], r["accepted"], r["rejected"]) for r in bins.where("accepted + rejected > 0").collect())
    all_accepted, all_rejected = (sum(r[k] for r in rows) for k in (1, 2))
    if not all_accepted or not all_rejected:
        return float("-inf")
    best = (-1.0, 0.0, 0)
    below_accepted = below_rejected = 0
    for edge, accepted, rejected in rows:
        hits = (all_accepted - below_accepted) / all_accepted + below_rejected / all_rejected
        best = max(best, (hits, -abs(edge), edge))
        below_accepted, below_rejected = below_accepted + accepted, below_rejected + rejected
    return best[2] / BINS


def judged(pages: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, score and verdict: the rule's, else the model's.

    The URLs that rules allow and block are what the model learns from. Columns of these names, and one
    named scored_url, are replaced.
    """
    ruled = with_rules(pages.drop("score", "scored_url"), rules, url)
    key = F.coalesce(url, F.lit(""))
    urls = ruled.groupBy(key.alias("url")).agg(F.count(F.lit(1)).alias("n"), F.max("verdict").alias("verdict"))
    held = F.substring(F.md5(F.encode("url", "UTF-8")), 1, 1).isin(*HELD_BACK)
    kinds = {"accepted": F.col("verdict") == ALLOW, "rejected": F.col("verdict") == BLOCK}
    weights = [F.when(is_kind, F.col("n")).otherwise(F.lit(0)).alias(kind) for kind, is_kind in kinds.items()]
    urls = stored(urls.select("url", held.alias("held"), *weights), "urls")
    learned = [F.when(F.col("held"), F.lit(0)).otherwise(F.col(kind)).alias(kind) for kind in kinds]
    ratios = log_ratios(urls.select("url", *learned))
    found = urls.select("url", F.explode(_grams(F.col("url"))).alias("gram")).join(ratios, "gram")
    score = F.sum("ratio") / F.lit(float(UNITS)) / F.count(F.lit(1))
    scores = stored(found.groupBy("url").agg(score.alias("score")), "url-scores")
    edge = threshold(urls.where("held").join(scores, "url"))
    chosen = F.when(F.col("score") >= F.lit(edge), ALLOW).otherwise(BLOCK)
    joined = ruled.join(scores.withColumnRenamed("url", "scored_url"), key == F.col("scored_url")).drop("scored_url")
    return joined.withColumn("verdict", F.coalesce("verdict", chosen))
