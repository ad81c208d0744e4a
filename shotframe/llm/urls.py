"""URL filter: host rules, then the ratio of two character language models.

Both models are variable-order Markov chains over 48 symbols with up to two
symbols of context and Witten-Bell smoothing: how far a context is trusted
against the next shorter one depends on what was counted in it.  One model
is counted from all URLs that the rules accept, the other from all that they reject.  A URL's
score is the mean log-likelihood difference over its symbols; the threshold
is the score that parts the rules' own URLs best.  Everything is DataFrame
operations; the table of log ratios has 48**3 rows at most, so it may be
broadcast at any size of the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut, stored

#: The rules (pattern, verdict).
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789/.-_?=&%:#"
#: Symbols: 0 any other character, then the alphabet, then the edge of a URL.
EDGE = len(ALPHABET) + 1
SYMBOLS = len(ALPHABET) + 2
#: Scores are counted in steps of one hundredth for the threshold, within these bounds.
SCORE_BOUND = 1000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``? #`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (host or a subdomain, and start of the path) and its verdict, or null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for pattern, says in sorted(rules, key=lambda r: len(r[0])):
        name, _, rest = pattern.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        rule, verdict = F.when(fits, pattern).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def contexts_of(url: Column) -> Column:
    """One number per symbol of a URL and its closing edge: two symbols of context, then the symbol."""
    text = F.translate(F.coalesce(url, F.lit("")), _UPPER, _LOWER)
    codes = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c))
    edge = F.lit(EDGE)
    padded = F.concat(F.array(edge, edge), codes, F.array(edge))
    # a lambda over one array binds the codes, so that they are worked out once a URL
    return F.get(F.transform(F.array(padded), lambda p: F.transform(F.sequence(F.lit(2), F.size(p) - 1), lambda i: (
        (F.get(p, i - 2) * SYMBOLS + F.get(p, i - 1)) * SYMBOLS + F.get(p, i)).cast("bigint"))), F.lit(0))


def _smoothed(n: str) -> Column:
    """Witten-Bell probability of c after (a, b) from the counts ``n`` of the whole grid of (a, b, c)."""
    count = F.col(n).cast("double")
    over = lambda *keys: Window.partitionBy(*keys)
    n_c, n_bc = F.sum(count).over(over("c")), F.sum(count).over(over("b", "c"))
    n_b, n_ab = F.sum(count).over(over("b")), F.sum(count).over(over("a", "b"))
    kinds_ab = F.sum((count > 0).cast("int")).over(over("a", "b"))
    # every (b, c) stands in the grid once for each a
    kinds_b = F.size(F.collect_set(F.when(count > 0, F.col("c"))).over(over("b")))
    p0 = (n_c + 1) / (F.col(f"all_{n}") + SYMBOLS)
    p1 = F.when(n_b > 0, (n_bc + kinds_b * p0) / (n_b + kinds_b)).otherwise(p0)
    return F.when(n_ab > 0, (count + kinds_ab * p1) / (n_ab + kinds_ab)).otherwise(p1)


def log_ratios(labelled: DataFrame) -> DataFrame:
    """(context, ratio) for the whole grid, from rows (context, accepted) of all labelled URLs."""
    counts = labelled.groupBy("context").agg(
        F.count(F.when(F.col("accepted"), 1)).alias("good"), F.count(F.when(~F.col("accepted"), 1)).alias("bad"))
    grid = labelled.sparkSession.range(SYMBOLS**3).withColumnRenamed("id", "context")
    full = (grid.join(counts, "context", "left").fillna(0, ["good", "bad"])
            .withColumn("a", F.floor(F.col("context") / SYMBOLS**2))
            .withColumn("b", F.floor(F.col("context") / SYMBOLS) % SYMBOLS).withColumn("c", F.col("context") % SYMBOLS))
    totals = counts.agg(F.coalesce(F.sum("good"), F.lit(0)).alias("g"), F.coalesce(F.sum("bad"), F.lit(0)).alias("b")).first()
    full = full.withColumn("all_good", F.lit(float(totals.g))).withColumn("all_bad", F.lit(float(totals.b)))
    if not totals.g or not totals.b:
        return cut(full.select("context", F.lit(0.0).alias("ratio")))
    return cut(full.select("context", (F.log(_smoothed("good")) - F.log(_smoothed("bad"))).alias("ratio")))


def best_threshold(scored: DataFrame) -> float:
    """Of the rows (score, accepted) of labelled URLs: the score from which on accepting parts them best.

    Counted over all of them in steps of a hundredth; 0 unless both kinds occur.
    """
    step = F.greatest(F.lit(-SCORE_BOUND), F.least(F.lit(SCORE_BOUND), F.floor(F.col("score") * 100))).cast("int")
    bins = scored.groupBy(step.alias("step")).agg(
        F.count(F.when(F.col("accepted"), 1)).alias("good"), F.count(F.when(~F.col("accepted"), 1)).alias("bad"))
    rows = sorted(bins.collect())
    good, bad = sum(r.good for r in rows), sum(r.bad for r in rows)
    if not good or not bad:
        return 0.0
    best, at, lost, left = -1.0, 0, 0, bad
    for r in rows:  # accept from this step on
        gain = (good - lost) / good - left / bad
        if gain > best + 1e-12:
            best, at = gain, r.step
        lost, left = lost + r.good, left - r.bad
    below = [r.step for r in rows if r.step < at]
    return ((at + max(below) + 1) / 2 if below else at) / 100


def judged(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, score``, one row per row of ``pages``.

    The longest fitting rule decides; else ``allow`` from the threshold on and
    ``block`` under it.  Null and empty URLs, and URLs without ``://``, have an
    empty host and path, fit no rule and are scored like others (a null URL as
    an empty one: its closing edge).  Without URLs of both kinds every score and
    the threshold are 0, which allows.  Repeated rows repeat; other columns are ignored.
    """
    url = F.col(url_col).cast("string")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = (pages.select(F.col(id_col).alias("page_id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
            .withColumn("rule", rule).withColumn("said", verdict))
    labelled = rows.where("said IS NOT NULL").select(
        F.explode(contexts_of(F.col("url"))).alias("context"), (F.col("said") == "allow").alias("accepted"))
    ratios = log_ratios(labelled)
    facts = ["page_id", "host", "path", "rule", "said"]
    scored = stored(rows.withColumn("row", F.monotonically_increasing_id())
                    .select("row", *facts, F.explode(contexts_of(F.col("url"))).alias("context"))
                    .join(F.broadcast(ratios), "context")
                    .groupBy("row", *facts).agg(F.avg("ratio").alias("score")), "url-scores")
    least = best_threshold(scored.where("said IS NOT NULL").select("score", (F.col("said") == "allow").alias("accepted")))
    return scored.select("page_id", "host", "path", "rule", F.coalesce(
        "said", F.when(F.col("score") >= least, "allow").otherwise("block")).alias("verdict"), "score")
