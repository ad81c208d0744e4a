"""Shards of near-equal bytes by sampled splitters.

Records are ordered by the key (hash of the text, hash of the id), so that
equal texts are neighbours.  A sample whose draws are weighted by size gives
quantile boundaries; exact sizes of the ranges between them show in which
range each shard ends.  Such a range that is overfull, with more records than
one task should order, is subdivided by a sample of its own, again and again;
inside the last, small ranges running sums give the exact splitter.  A text
whose copies would overfill a shard is split among neighbours by the second
part of the key; a small group of equal texts stays whole.  Only DataFrame
operations.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut, drop_stored, stored, whole_row

#: Ranges between the sampled boundaries of one subdivision, and expected draws in each.
RANGES = 256
DRAWS = 40
#: A range of more records than this is subdivided before its keys are put in order.
MOST_IN_RANGE = 200_000
#: Bytes of a piece of a shard; slots are numbered piece by piece.
PIECE_BYTES = 32 << 20
#: A group of equal texts up to this share of a shard is not cut by a splitter.
WHOLE_SHARE = 0.002

Key = tuple[int, int]


def size_of(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def key_of(id_: Column, text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text), F.xxhash64(id_, F.lit(1))


def at_or_after(h: Column, d: Column, key: Key) -> Column:
    return (h > key[0]) | ((h == key[0]) & (d >= key[1]))


def place_in(h: Column, d: Column, bounds: list[Key]) -> Column:
    """How many of the sorted ``bounds`` are at or under a key, from constant arrays."""
    if not bounds:
        return F.lit(0)
    own = [F.split(F.lit(",".join(str(b[i]) for b in bounds)), ",").cast("array<bigint>") for i in (0, 1)]
    return F.size(F.filter(F.arrays_zip(own[0].alias("h"), own[1].alias("d")),
                           lambda b: (b["h"] < h) | ((b["h"] == h) & (b["d"] <= d))))


def shard_of(h: Column, d: Column, cuts: list[Key]) -> Column:
    """How many of a few splitters are at or under a key."""
    shard = F.lit(0)
    for c in cuts:
        shard = shard + at_or_after(h, d, c).cast("int")
    return shard


@dataclass(frozen=True)
class Range:
    """Keys from ``low`` (None: the first) to before ``high`` (None: the last), with the bytes before them."""

    low: Key | None
    high: Key | None
    before: int
    size: int
    rows: int

    def holds(self, h: Column, d: Column) -> Column:
        inside = F.lit(True) if self.low is None else at_or_after(h, d, self.low)
        return inside if self.high is None else inside & ~at_or_after(h, d, self.high)


def _after(key: Key) -> Key:
    return (key[0], key[1] + 1) if key[1] < 2**63 - 1 else (key[0] + 1, -(2**63))


def sampled_bounds(keys: DataFrame, total: int, ranges: int = RANGES, draws: int = DRAWS) -> list[Key]:
    """Quantile boundaries of a sample of about ``ranges * draws`` keys, drawn in proportion to size.

    A key that holds several quantiles by itself is set apart from its
    neighbours.  Every row draws for itself, so that the copies of a key count
    by their number; the splitters do not depend on the draws.
    """
    times = F.floor(F.col("size") * F.lit(ranges * draws / total) + F.rand(17)).cast("int")
    drawn = keys.select("h", "d", times.alias("n")).where("n > 0").groupBy("h", "d").agg(F.sum("n").alias("n")).collect()
    picks, at = [], 0
    for h, d, n in sorted(map(tuple, drawn)):
        picks += [(h, d)] * ((at + n - 1) // draws - (at - 1) // draws)
        at += n
    several = {a for a, b in zip(picks, picks[1:]) if a == b}
    return sorted(set(picks) | {_after(k) for k in several})


def _subdivided(keys: DataFrame, one: Range, targets: list[int], ranges: int, draws: int) -> list[Range]:
    """The parts of a range, between boundaries sampled in it, that hold a target."""
    h, d = F.col("h"), F.col("d")
    inside = keys.where(one.holds(h, d))
    bounds = [b for b in sampled_bounds(inside, one.size, ranges, draws) if one.low is None or b > one.low]
    sums = inside.groupBy(place_in(h, d, bounds).alias("part")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    edges, before, out = [one.low, *bounds, one.high], one.before, []
    for r in sorted(sums.collect()):
        if any(before <= t < before + r["size"] for t in targets):
            out.append(Range(edges[r.part], edges[r.part + 1], before, r["size"], r.rows))
        before += r["size"]
    return out


def splitters(keys: DataFrame, shards: int, ranges: int = RANGES, draws: int = DRAWS,
              most_in_range: int = MOST_IN_RANGE) -> list[Key]:
    """The keys at which shards 1, 2, ... start, so that bytes are near-equal."""
    whole = keys.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("rows")).first()
    total = whole.n
    targets = sorted({total * k // shards for k in range(1, shards)})
    if not total or not targets:
        return []
    found: list[Range] = []
    overfull = _subdivided(keys, Range(None, None, 0, total, whole.rows), targets, ranges, draws)
    while overfull:
        found += [r for r in overfull if r.rows <= most_in_range or r.high == (r.low and _after(r.low))]
        parts = [(r, _subdivided(keys, r, targets, ranges, draws)) for r in overfull if r not in found]
        found += [r for r, own in parts if own == [r]]  # no boundary fell inside
        overfull = [part for r, own in parts if own != [r] for part in own]
    h, d = F.col("h"), F.col("d")
    place = F.lit(None).cast("int")
    for k, r in enumerate(found):
        place = F.when(r.holds(h, d), k).otherwise(place)
    start = F.create_map(*[F.lit(x) for k, r in enumerate(found) for x in (k, r.before)])
    order = Window.partitionBy("range").orderBy("h", "d").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    near = cut(keys.withColumn("range", place).where("range IS NOT NULL")
               .groupBy("range", "h", "d").agg(F.sum("size").alias("size"))
               .withColumn("upto", F.sum("size").over(order) + start[F.col("range")]))
    # the first key whose last byte lies beyond the target starts the next shard
    home = {t: next(k for k, r in enumerate(found) if r.before <= t < r.before + r.size) for t in targets}
    firsts = near.agg(*[F.min(F.when((F.col("range") == home[t]) & (F.col("upto") > t), F.struct("h", "d"))).alias(f"t{k}")
                        for k, t in enumerate(targets)]).first()
    of_target = {t: (x.h, x.d) for t, x in zip(targets, firsts)}
    cuts = [of_target[total * k // shards] for k in range(1, shards)]
    groups = {r.h: r.n for r in keys.where(F.col("h").isin(sorted({c[0] for c in cuts})))
              .groupBy("h").agg(F.sum("size").alias("n")).collect()}
    small = WHOLE_SHARE * total / shards
    return sorted((h, -(2**63)) if groups[h] <= small else (h, d) for h, d in cuts)


def sharded(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
            piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """All columns of ``docs`` and ``shard int, slot bigint`` (gapless from 0 in each shard).

    Law ``bytes``: the shards' sizes (UTF-8 bytes plus 1 per record) differ by
    no more than a record and a small group of equal texts.  Null texts count 1 byte; null ids
    are a key like others.  Rows with equal text and id have the same key and
    stay together.  An empty table gives an empty result.  Columns of ``docs``
    named shard or slot are replaced, others may have any name.
    """
    h, d = key_of(F.col(id_col), F.col(text_col))
    keys = stored(docs.select(h.alias("h"), d.alias("d"), size_of(F.col(text_col)).alias("size")), "shard-keys")
    cuts = splitters(keys, shards)
    sizes = keys.withColumn("shard", shard_of(F.col("h"), F.col("d"), cuts))
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first().n
    pieces = max(1, -(-total // (shards * piece_bytes)))
    piece = lambda a, b: F.pmod(F.xxhash64(a, b, F.lit(23)), F.lit(pieces))
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    table = cut(sizes.groupBy("shard", piece(F.col("h"), F.col("d")).alias("piece")).agg(F.count(F.lit(1)).alias("n"))
                .select("shard", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin")))
    drop_stored(keys)
    names = [c for c in docs.columns if c not in ("shard", "slot")]
    own = docs.select(whole_row(names).alias("row"), h.alias("h"), d.alias("d"))
    own = (own.withColumn("shard", shard_of(F.col("h"), F.col("d"), cuts))
           .withColumn("piece", piece(F.col("h"), F.col("d"))))
    rank = F.row_number().over(Window.partitionBy("shard", "piece").orderBy("h", "d"))
    return (own.withColumn("rank", rank).join(table, ["shard", "piece"])
            .select("row.*", "shard", (F.col("begin") + F.col("rank") - 1).alias("slot")))
