"""Mixing sources to target weights by iterative proportional fitting.

Token counts of the cells (source, language, topic) are raked until their
sums agree with target shares for every source, every language and every
topic.  A cell's documents are then sampled with probability proportional to
its weight over its tokens, calibrated so that the expected tokens meet the
budget with no probability above 1.  Only DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut, whole_row

MARGINS = ("source", "lang", "topic")
#: Target shares are the corpus's own shares to this power, normalised: under 1 evens them out.
SMOOTHING = 0.7
#: Tokens to keep, as a share of all.
KEEP_SHARE = 0.7
#: Fitting stops when every margin's share is this near its target, or after so many rounds.
TOLERANCE = 1e-4
MAX_ROUNDS = 100
#: Cells that one partition of the fitting holds.
CELLS_PER_PARTITION = 50_000
#: What stands for a null source or language.
UNKNOWN = "unknown"


def _times(text: Column, piece: str) -> Column:
    """How often a piece occurs in a text, by what taking it out takes off."""
    return (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(piece), F.lit("")))) / F.lit(len(piece))


def tokens_of(text: Column) -> Column:
    """One more than the spaces, tabs and line ends inside a text, as its weight; null and blank texts have none."""
    t = F.coalesce(text, F.lit(""))
    blank = F.trim(t, F.lit(" \t\n\r")) == ""
    return F.when(blank, 0).otherwise(1 + _times(t, " ") + _times(t, "\n") + _times(t, "\t")).cast("bigint")


def topic_of(text: Column) -> Column:
    """A coarse kind of text from counts of signs: the topic where a corpus has none of its own."""
    t = F.coalesce(text, F.lit(""))
    n = F.octet_length(t)
    marks = sum((_times(t, mark) for mark in ("###", "***", "&&&", "$$$", "%%%")), F.lit(0))
    return (F.when(n == 0, "empty")
            .when(_times(t, "|") * 50 > n, "table")
            .when(F.regexp_count(t, F.lit("[A-Z]{3}")) * 20 > n, "capitals")
            .when(marks * 100 > n, "marked")
            .when(n < 200, "note").when(n < 2000, "article").otherwise("long"))


def smoothed_targets(cells: DataFrame, margin: str, power: float = SMOOTHING) -> DataFrame:
    """(value, target): the margin's own token shares to a power, normalised to 1."""
    own = cells.groupBy(margin).agg(F.sum("tokens").alias("n")).where("n > 0")
    every = Window.partitionBy(F.lit(1))
    return own.select(F.col(margin).alias("value"),
                      (F.pow("n", F.lit(power)) / F.sum(F.pow("n", F.lit(power))).over(every)).alias("target"))


def given_targets(cells: DataFrame, margin: str, shares: dict[str, float]) -> DataFrame:
    """(value, target) of given shares, scaled to 1."""
    whole = sum(shares.values())
    if whole <= 0 or min(shares.values()) < 0:
        raise ValueError(f"the target shares of {margin} must not be negative and need a positive sum")
    return cells.sparkSession.createDataFrame([(str(v), float(x) / whole) for v, x in shares.items()], "value string, target double")


def rake(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = TOLERANCE,
         max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """``cells`` (margin columns, tokens > 0) with ``weight``: shares that meet every margin's targets.

    Values without a target, or with target 0, get weight 0.  One round scales the cells to each
    margin in turn; rounds are checkpointed.  ``deviation`` is the largest distance of a margin's share from its
    target in the end: above ``tolerance`` where the targets contradict each other, or values that have a target
    have no cells, so that no weights meet them all.
    """
    margins = list(targets)
    wanted = {m: F.col(f"__{m}_target__") for m in margins}
    for m, t in targets.items():
        cells = cells.join(t.select(F.col("value").alias(m), F.col("target").cast("double").alias(f"__{m}_target__")), m, "left")
    cells = cells.fillna(0.0, [f"__{m}_target__" for m in margins])
    n = cells.count()
    now = cut(cells.withColumn("weight", F.col("tokens").cast("double")).coalesce(max(1, -(-n // CELLS_PER_PARTITION))))
    deviation = 0.0
    for _ in range(max_rounds):
        for m in margins:
            sums = F.sum("weight").over(Window.partitionBy(m))
            now = now.withColumn("weight", F.when(sums > 0, F.col("weight") * wanted[m] / sums).otherwise(0.0))
        now = cut(now)
        # the last margin fits exactly; how far are the others?
        offs = [F.max(F.abs(F.col(f"__{m}_sum__") - wanted[m])).alias(f"o{i}") for i, m in enumerate(margins)]
        off = now.withColumns({f"__{m}_sum__": F.sum("weight").over(Window.partitionBy(m)) for m in margins}).agg(*offs).first()
        deviation = max([x or 0.0 for x in off])
        if deviation <= tolerance:
            break
    for m, t in targets.items():  # a target that no cell can take up
        lost = t.join(now.select(F.col(m).alias("value")).distinct(), "value", "left_anti").agg(F.max("target")).first()[0]
        deviation = max(deviation, lost or 0.0)
    return now.drop(*[f"__{m}_target__" for m in margins]).withColumn("deviation", F.lit(float(deviation)))


def calibrated(cells: DataFrame, keep_share: float = KEEP_SHARE, rounds: int = 60) -> DataFrame:
    """``probability`` per cell: in proportion to weight over tokens, at most 1, meeting the token budget."""
    ratio = F.col("weight") / F.col("tokens")
    total = cells.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).first().n
    # a positive weight can reach at most its cell's tokens
    reach = cells.agg(F.coalesce(F.sum(F.when(F.col("weight") > 0, F.col("tokens"))), F.lit(0)).alias("n")).first().n
    budget, scale = min(keep_share * total, reach), keep_share * total
    for _ in range(rounds):
        got = cells.agg(F.sum(F.when(ratio * scale < 1, F.col("weight") * scale)).alias("open"),
                        F.sum(F.when(ratio * scale >= 1, F.col("tokens"))).alias("full")).first()
        open_, full = got.open or 0.0, got.full or 0
        if open_ <= 0 or abs(open_ + full - budget) <= 1e-6 * max(budget, 1):
            break
        scale *= (budget - full) / open_
    return cells.withColumn("probability", F.least(F.lit(1.0), ratio * scale))


def draw_of(id_: Column, text: Column, seed: int = 0) -> Column:
    """A number in 0..1 that depends on the id and the text of a row alone."""
    return F.pmod(F.xxhash64(id_, text, F.lit(seed)), F.lit(2**52)) / F.lit(float(2**52))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          lang_col: str = "lang", topic: Column | None = None, smoothing: float = SMOOTHING,
          keep_share: float = KEEP_SHARE, seed: int = 0, targets: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """All columns of ``docs`` and a struct ``mix`` of ``source, lang, topic, tokens, weight, probability, kept, converged``.

    ``targets`` gives the share of tokens of each value of the margins ``source``, ``lang`` and ``topic``, scaled to
    1; a margin that it does not name aims at the corpus's own shares to the power ``smoothing``.  A value that a
    named margin leaves out gets no weight, and its documents are not kept.  ``converged`` tells whether
    the weights meet all targets.

    Null sources and languages are the value ``unknown``.  Null and blank texts have no tokens
    and weight nothing in the fit; they are kept (probability 1).  Rows with
    equal id and text share their draw.  An empty table gives an empty result.  A column of ``docs``
    named ``mix`` is replaced.
    """
    own = topic_of(F.col(text_col)) if topic is None else topic
    named = [F.coalesce(F.col(source_col).cast("string"), F.lit(UNKNOWN)).alias("source"),
             F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), own.alias("topic"),
             tokens_of(F.col(text_col)).alias("tokens")]
    cells = cut(docs.select(*named).groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")).where("tokens > 0"))
    raked = rake(cells, {m: given_targets(cells, m, targets[m]) if m in (targets or {}) else smoothed_targets(cells, m, smoothing)
                         for m in MARGINS})
    final = cut(calibrated(raked, keep_share).select(*[F.col(m).alias(f"cell_{m}") for m in MARGINS], "weight", "probability",
                                                     (F.col("deviation") <= TOLERANCE).alias("converged")))
    rest = [c for c in docs.columns if c != "mix"]
    rows = docs.select(whole_row(rest).alias("row"), F.struct(*named).alias("own"),
                       draw_of(F.col(id_col), F.col(text_col), seed).alias("draw"))
    on = [F.col(f"own.{m}") == F.col(f"cell_{m}") for m in MARGINS]
    p = F.coalesce("probability", F.lit(1.0))
    return rows.join(final, on, "left").select("row.*", F.struct(
        "own.*", F.coalesce("weight", F.lit(0.0)).alias("weight"), p.alias("probability"), (F.col("draw") < p).alias("kept"),
        F.coalesce("converged", F.lit(True)).alias("converged")).alias("mix"))
