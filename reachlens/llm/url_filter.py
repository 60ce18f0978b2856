"""URL filter: longest matching host/path rule, else a character language-model ratio.

URLs that a rule decides are the training text of two variable-order Markov
models over characters (accepted, rejected).  Orders are interpolated by
Witten-Bell smoothing down to a uniform alphabet, so an unseen context falls
back to its suffix.  A URL's score is the log-likelihood difference per
character; the threshold is calibrated on a quarter of the ruled URLs that the
models have not seen.  Everything is DataFrame functions: grams are counted and
joined as tables that grow with the distinct grams; the groups of one context
or one suffix are bounded by the alphabet.

Defined results: a null url, or one without ``://``, has empty host and path
and is judged by the models; an empty table gives an empty result; without
ruled URLs of both verdicts the threshold is 0; repeated rows are judged alike
and each counts in the models and the threshold; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reachlens.llm.common import salted_join, written

ORDER = 4
ALPHABET = 1024
START, END = "\u0002", "\u0003"
HELD_OUT = "0123"  # first hex digit of md5(host + path): a quarter
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.coalesce(F.regexp_extract(url, rest, 1), F.lit(""))
    return F.translate(host, _UPPER, _LOWER), F.coalesce(F.regexp_extract(url, rest, 2), F.lit(""))


def longest_rule(host: Column, path: Column,
                 rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule text, rule verdict) of the longest fitting rule, null if none fits."""
    rule = verdict = F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = (((host == rule_host) | F.endswith(host, F.lit("." + rule_host)))
                & F.startswith(path, F.lit(rule_path)))
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _grams(texts: DataFrame, order: int) -> DataFrame:
    """A row for each character of ``s`` and its end, with the ``order`` before it."""
    padded = F.concat(F.lit(START * order), "s", F.lit(END))
    at = F.explode(F.sequence(F.lit(1), F.length("s") + 1)).alias("at")
    return (texts.withColumn("padded", padded).select("*", at)
            .withColumn("gram", F.substring("padded", F.col("at"), F.lit(order + 1)))
            .drop("padded", "at"))


def gram_ratios(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, ratio): ln p(accepted) - ln p(rejected) of each gram's last
    character after the others, in millionths.  ``counts``: gram, allow, block."""
    lower = None
    for k in range(order + 1):
        grams = (counts.groupBy(F.right("gram", F.lit(k + 1)).alias("gram"))
                 .agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")))
        same = Window.partitionBy(F.left("gram", F.lit(k)))
        for side in ("allow", "block"):
            grams = (grams.withColumn(f"n_{side}", F.sum(side).over(same))
                     .withColumn(f"t_{side}", F.sum(F.when(F.col(side) > 0, 1).otherwise(0)).over(same)))
        if lower is None:
            grams = grams.withColumns({f"q_{s}": F.lit(1.0 / ALPHABET) for s in ("allow", "block")})
        else:
            grams = grams.withColumn("tail", F.right("gram", F.lit(k))).join(
                lower.select(F.col("gram").alias("tail"), F.col("p_allow").alias("q_allow"),
                             F.col("p_block").alias("q_block")), "tail")
        seen = {s: F.col(f"n_{s}") + F.col(f"t_{s}") for s in ("allow", "block")}
        lower = grams.select("gram", *[
            F.when(seen[s] > 0, (F.col(s) + F.col(f"t_{s}") * F.col(f"q_{s}")) / seen[s])
            .otherwise(F.col(f"q_{s}")).alias(f"p_{s}") for s in ("allow", "block")])
    ratio = F.round((F.ln("p_allow") - F.ln("p_block")) * 1e6).cast("bigint")
    return lower.select("gram", ratio.alias("ratio"))


def threshold(scores: DataFrame) -> float:
    """The score (in steps of 0.01) that best parts held-out ruled URLs by mean
    recall; the one nearest 0 among equals.  A row counts ``pages`` times if it has
    that column.  Collects at most 2001 bins."""
    pages = F.col("pages") if "pages" in scores.columns else F.lit(1)
    step = F.least(F.lit(1000), F.greatest(F.lit(-1000), F.floor(F.col("score") * 100)))
    bins = (scores.where("verdict is not null").groupBy(step.alias("bin"))
            .agg(F.sum(F.expr("int(verdict = 'allow')") * pages).alias("allow"),
                 F.sum(F.expr("int(verdict = 'block')") * pages).alias("block")).orderBy("bin").collect())
    allow, block = sum(b.allow for b in bins), sum(b.block for b in bins)
    if not allow or not block:
        return 0.0
    best, below_allow, below_block, gap = (-1.0, 0.0, 0.0), 0, 0, -1000
    for b in bins:
        balanced = below_block / block + 1 - below_allow / allow
        at = min(max(0, gap), b.bin) / 100  # any step from the last bin to this parts alike
        best = max(best, (balanced, -abs(at), at))
        below_allow, below_block, gap = below_allow + b.allow, below_block + b.block, b.bin + 1
    return best[2]


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
               order: int = ORDER) -> DataFrame:
    """page_id, host, path, rule, verdict, score (null where a rule decides)."""
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    ruled = urls.withColumns({"rule": rule, "ruled": verdict, "s": F.concat("host", "path")})

    distinct = ruled.groupBy("s").agg(F.first("ruled").alias("verdict"), F.count("*").alias("pages"))
    held_out = F.substring(F.md5("s"), 1, 1).isin(*HELD_OUT)
    asked = F.expr("verdict is null") | held_out
    counts = (_grams(distinct, order).groupBy("gram")
              .agg(*[F.sum(F.when((F.col("verdict") == v) & ~held_out, F.col("pages")).otherwise(0)).alias(v)
                     for v in ("allow", "block")]))
    ratios = gram_ratios(written(counts, "grams"), order)
    asked_grams = _grams(distinct.where(asked).select("s", "verdict", "pages"), order)
    scores = written(
        salted_join(asked_grams, ratios, "gram", "s", "inner").groupBy("s")
        .agg(F.first("verdict").alias("verdict"), F.first("pages").alias("pages"),
             (F.sum("ratio") / 1e6 / (F.length("s") + 1)).alias("score")), "url-scores")
    limit = threshold(scores)
    open_scores = scores.where("verdict is null").select("s", "score")
    judged = salted_join(ruled, open_scores, "s", "page_id")
    return judged.select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("score") >= limit, "allow").otherwise("block"))
        .alias("verdict"), "score")
