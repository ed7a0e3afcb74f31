"""URL filters, in DataFrame functions only: rules, then a character language-model ratio.

URLs that a rule allows or blocks are the training text of two models: variable-order Markov
models of whole URLs, character by character as they are, with as much context as training has
seen, up to MEMORY characters, smoothed by Witten-Bell interpolation with the next shorter one. A URL without a rule is blocked if its mean log-likelihood difference, accepted
minus rejected, lies below a threshold, calibrated on the scores of the rules' own URLs.

A model has an entry for each distinct piece of MEMORY + 1 characters, so it grows with the
input; URLs are joined to it. Both sides are shuffled: planning takes the pieces of all URLs for
smaller than the file of the URLs, and would send them through the driver.
"""

import string

from pyspark.sql import Window
from pyspark.sql import functions as F

from naviscope.session import materialise

# Fixed values: (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
MEMORY = 7
# Code points that a character may be; START and END frame a URL.
ALPHABET = 0x110000
START, END = "\x02", "\x03"
# Scores are counted in bins of this width, between plus and minus SCORE_LIMIT, for calibration.
SCORE_STEP = 0.01
SCORE_LIMIT = 20


def lower(text):
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url):
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without `://`."""
    part = lambda k: F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", k), F.lit(""))
    return lower(part(1)), part(2)


def rule_of(host, path, rules=RULES):
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, of_host, of_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == of_host) | host.endswith("." + of_host)) & path.startswith(of_path)
        rule = F.when(fits, F.lit(of_host + of_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def framed(url):
    """The text the models see: the whole URL, none for null, with START before and END after it."""
    return F.concat(F.lit(START * MEMORY), F.coalesce(url, F.lit("")), F.lit(END))


def grams(rows, *keep):
    """A row per character of `framed`, with its context: MEMORY + 1 characters."""
    # One pass over the URL: at each character, what it begins.
    overlapping = F.regexp_extract_all("framed", F.lit(f"(?s)(?=(.{{{MEMORY + 1}}}))."), F.lit(1))
    return rows.select(*keep, F.explode(overlapping).alias("gram"))


def model(rows):
    """gram -> log-likelihood difference, for every gram of any URL."""
    trained = {c: F.sum((F.col("verdict") == c).cast("long")) for c in ("allow", "block")}
    counted = grams(rows, "verdict").groupBy("gram").agg(*[F.coalesce(n, F.lit(0)).alias(f"n_{c}") for c, n in trained.items()])
    full = materialise(counted, "url-grams")
    lower_order = None
    for size in range(1, MEMORY + 2):
        order = full if size == MEMORY + 1 else full.groupBy(F.substring("gram", MEMORY + 2 - size, size).alias("gram")).agg(*[F.sum(f"n_{c}").alias(f"n_{c}") for c in trained])
        context = Window.partitionBy("context")
        order = order.withColumn("context", F.substring("gram", 1, size - 1))
        order = order.select("*", *[F.sum(f"n_{c}").over(context).alias(f"all_{c}") for c in trained], *[F.sum((F.col(f"n_{c}") > 0).cast("long")).over(context).alias(f"kinds_{c}") for c in trained])
        if lower_order is None:
            order = order.select("*", *[F.lit(1 / ALPHABET).alias(f"shorter_{c}") for c in trained])
        else:
            order = order.withColumn("suffix", F.substring("gram", 2, size - 1)).join(lower_order, "suffix")
        p = [F.when(F.col(f"all_{c}") > 0, (F.col(f"n_{c}") + F.col(f"kinds_{c}") * F.col(f"shorter_{c}")) / (F.col(f"all_{c}") + F.col(f"kinds_{c}"))).otherwise(F.col(f"shorter_{c}")).alias(f"shorter_{c}") for c in trained]
        lower_order = order.select(F.col("gram").alias("suffix"), *p)
    return materialise(lower_order.select(F.col("suffix").alias("gram"), (F.log("shorter_allow") - F.log("shorter_block")).alias("llr")), "url-model")


def threshold(scored):
    """The score that best parts the rules' accepted and rejected URLs; 0 if one kind is missing.

    The sum of both error rates is least there; of equals, the one nearest to 0. A bounded
    histogram reaches the driver.
    """
    bins = F.floor(F.least(F.greatest("score", F.lit(-SCORE_LIMIT)), F.lit(SCORE_LIMIT)) / SCORE_STEP)
    rows = scored.where(F.col("verdict").isNotNull()).groupBy(bins.alias("bin")).agg(*[F.sum((F.col("verdict") == c).cast("long")).alias(c) for c in ("allow", "block")]).orderBy("bin").collect()
    total = {c: sum(r[c] for r in rows) for c in ("allow", "block")}
    if not all(total.values()):
        return 0.0
    best, below = (1.0, abs(rows[0]["bin"]), rows[0]["bin"]), {"allow": 0, "block": 0}
    for r, after in zip(rows, [*rows[1:], None]):
        below = {c: below[c] + r[c] for c in below}
        errors = below["allow"] / total["allow"] + 1 - below["block"] / total["block"]
        # All cuts up to the next score are equal.
        cut = min(max(0, r["bin"] + 1), after["bin"] if after else r["bin"] + 1)
        best = min(best, (errors, abs(cut), cut))
    return best[2] * SCORE_STEP


def judge(pages, rules=RULES):
    """Verdict on every url: page_id, host, path, rule, verdict and, where a score decided, score.

    One row per input row; a null url, or one without `://`, has empty host and path, and the
    models score what it holds; repeated rows are judged alike; an empty table gives no row; other
    columns are ignored. A score equal to the threshold is accepted.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string")).select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), framed(F.col("url")).alias("framed"))
    rows = materialise(rows.withColumn("uid", F.monotonically_increasing_id()), "urls")
    scores = grams(rows, "uid").join(model(rows).hint("merge"), "gram").groupBy("uid").agg(F.avg("llr").alias("score"))
    scored = materialise(rows.drop("framed").join(scores.hint("merge"), "uid"), "url-scores")
    limit = threshold(scored)
    decided = F.coalesce("verdict", F.when(F.col("score") < limit, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", decided.alias("verdict"), F.round("score", 6).alias("score"))
