"""Near-duplicate documents by b-bit MinHash.

1. One Arrow pass over the texts gives each document its exact digest, the
   size of its set of five-word shingles, band keys (each a hash of
   ``band_rows`` full minima) and the packed low ``BITS`` bits of all minima.
2. Exact copies collapse to the smallest document id of their digest.
3. Within each band bucket every member is paired with the bucket's smallest
   member (a star, not all pairs).  Pairs whose similarity, estimated from
   bit counts and corrected for chance collisions, is far too low are left
   out; the rest are confirmed on full shingle sets.
4. Documents of buckets whose members, the smallest aside, the stars left in
   several components are compared once more, so that no link between different texts is lost to the
   star: by an exact prefix filter, in which linked sets share one of their
   rarest shingles.  Where a shared shingle stands among a set's shared ones
   bounds what the set can have in common with any other, and with that the
   sizes of sets it can link with; sets meet by shingle and size band only
   where both bounds allow it, then size, place and bit counts decide.  Many
   documents of one template, each with enough text of its own, have no such
   sizes and meet nobody.  A shingle and band with very many sets is dealt to
   several tasks.
5. Links give connected components; the smallest document id stays.

Size of the bands, the estimate's cut and the prefixes follow the threshold:
a pair at it shares no band with probability (1 - 0.85**6)**32 < 3e-7 at 0.85
and (1 - 0.8**5)**38 < 3e-7 at 0.8; the cut lies over five standard deviations
under the threshold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import cut, drop_stored, slices, stored
from .words import SPACES, mix, shingle_hashes, word_hashes

SHINGLE_WORDS = 5
HASHES = 192
#: Low bits of each minimum that the signature keeps.
BITS = 2
PER_WORD = 64 // BITS
PACKED = HASHES // PER_WORD
#: Links have 100 * intersection >= percent * union; the percent where nothing is said.
PERCENT = 85
#: Largest probability that a pair at the threshold shares no band.
MISSED = 3e-7
#: Standard deviations of the estimate from the threshold down to its cut.
DEVIATIONS = 6.0
#: Ratio of neighbouring size bands; sets of a shingle and band that one task pairs at most; lanes of a hot key.
BAND_RATIO, MOST_IN_TASK, LANES = 1.15, 1000, 16

_RNG = np.random.default_rng(99173)
_MULTIPLIERS = (_RNG.integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_ADDENDS = _RNG.integers(0, 2**32, HASHES, dtype=np.uint32)[:, None]
_BAND_WEIGHTS = _RNG.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_SEEDS = _RNG.integers(1, 2**63, HASHES, dtype=np.uint64)
_SHIFTS = (np.arange(PER_WORD, dtype=np.uint64) * np.uint64(BITS))[None, :]

SIGNED_SCHEMA = "doc_id bigint, digest binary, n_shingles bigint, signature array<bigint>, bands array<bigint>"


def band_rows(percent: int) -> int:
    """The most minima in a band with which a pair at the threshold is missed with a probability under ``MISSED``."""
    fit = [r for r in range(1, HASHES + 1) if (1 - (percent / 100) ** r) ** (HASHES // r) < MISSED]
    return max(fit, default=1)


def estimate_cut(percent: int) -> float:
    """Pairs whose estimated similarity is under this are not confirmed."""
    chance = 2.0**-BITS
    agree = percent / 100 * (1 - chance) + chance
    return percent / 100 - DEVIATIONS * (agree * (1 - agree) / HASHES) ** 0.5 / (1 - chance)


def minima(shingles: np.ndarray, block: int = 2048) -> np.ndarray:
    """The ``HASHES`` minima of a non-empty set of 64-bit shingle hashes."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(x), block):
        h = _MULTIPLIERS * x[None, at: at + block]
        h += _ADDENDS
        np.minimum(out, h.min(axis=1), out=out)
    return out


def band_keys(m: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    size = band_rows(percent)
    bands = HASHES // size
    rows = m[: bands * size].reshape(bands, size).astype(np.uint64)
    return mix((rows * _BAND_WEIGHTS[None, :size]).sum(axis=1, dtype=np.uint64) + _BAND_SEEDS[:bands]).view(np.int64)


def pack(m: np.ndarray) -> np.ndarray:
    low = (m & np.uint32(2**BITS - 1)).astype(np.uint64).reshape(PACKED, PER_WORD)
    return np.bitwise_or.reduce(low << _SHIFTS, axis=1).view(np.int64)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    values = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int64, copy=False)))


def _sign(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    none = np.zeros(0, np.int64)
    for batch in batches:
        for at, buf, offsets in slices(batch.column(1)):
            hashes, first, _, _ = word_hashes(buf, offsets, SPACES)
            sizes, sigs, keys = [], [], []
            for s in shingle_hashes(hashes, first, SHINGLE_WORDS):
                sizes.append(len(s))
                m = minima(s) if len(s) else None
                sigs.append(none if m is None else pack(m))
                keys.append(none if m is None else band_keys(m, percent))
            raw = buf.tobytes()
            ends = offsets.tolist()
            digests = [hashlib.md5(b" ".join(raw[a:b].lower().split())).digest()
                       for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, len(sizes)), pa.array(digests, pa.binary()),
                 pa.array(sizes, pa.int64()), _lists(sigs), _lists(keys)],
                ["doc_id", "digest", "n_shingles", "signature", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, buf, offsets in slices(batch.column(1)):
            hashes, first, _, _ = word_hashes(buf, offsets, SPACES)
            parts = [s.view(np.int64) for s in shingle_hashes(hashes, first, SHINGLE_WORDS)]
            whole = [int(mix(s.view(np.uint64)).sum(dtype=np.uint64).view(np.int64)) for s in parts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, len(parts)), pa.array(whole, pa.int64()),
                 pa.array([len(s) for s in parts], pa.int64()), _lists(parts)], ["node", "set", "n", "shingles"])


def sign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """Digest, set size, packed signature and band keys of every whole text."""
    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(lambda batches: _sign(batches, percent), SIGNED_SCHEMA))


def shingle_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(node, set, n, shingles): the full set of each document as distinct 64-bit hashes, a hash of the set, its size."""
    return (docs.select(F.col(id_col).cast("bigint").alias("node"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(_sets, "node bigint, set bigint, n bigint, shingles array<bigint>"))


def estimated_similarity(left: Column, right: Column) -> Column:
    """Similarity from two packed signatures.

    Unequal fields are counted by bits; of unequal minima a share of 2**-BITS
    agrees in its low bits by chance, which is taken off again.
    """
    fields = int("01" * PER_WORD, 2)
    unequal = F.lit(0)
    for i in range(PACKED):
        x = left[i].bitwiseXOR(right[i])
        unequal = unequal + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(fields)))
    agree = 1 - unequal / F.lit(float(HASHES))
    chance = 2.0**-BITS
    return (agree - chance) / (1 - chance)


def _close(left: str, right: str, percent: int) -> Column:
    """Whether sizes and signatures leave it open that two sets are linked."""
    n, m = F.col(f"{left}.n_shingles"), F.col(f"{right}.n_shingles")
    return ((100 * F.least(n, m) >= percent * F.greatest(n, m))
            & (estimated_similarity(F.col(f"{left}.signature"), F.col(f"{right}.signature")) >= estimate_cut(percent)))


def with_reach(keys: DataFrame, percent: int) -> DataFrame:
    """Adds ``reach`` to (n, place): the largest set that a set can link with which agrees in no key before ``place``.

    At most ``n - place`` shingles are common then, and 100 * common >=
    percent * (n + m - common) bounds m.
    """
    left = F.col("n") - F.col("place")
    return keys.withColumn("reach", F.floor((100 + percent) * left / percent).cast("bigint") - F.col("n"))


def _band(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(BAND_RATIO))).cast("int")


def _meet(small: DataFrame, large: DataFrame, percent: int) -> DataFrame:
    """(a, b): sets of a key where the smaller and the larger are within each other's reach and in two components.

    The smaller look in the size bands that they can reach.  A key and band
    that more than ``MOST_IN_TASK`` of the larger share is split by them into
    several tasks, to which its smaller ones are copied.
    """
    most = F.least(F.col("reach"), F.floor(100 * F.col("n") / percent).cast("bigint"))
    probes = small.where("reach >= n").withColumn("band", F.explode(F.sequence(_band(F.col("n")), _band(most))))
    held = large.withColumn("band", _band(F.col("n")))
    hot = (held.groupBy("key", "band").agg(F.count(F.lit(1)).alias("many")).where(F.col("many") > MOST_IN_TASK)
           .select("key", "band", F.ceil(F.col("many") / MOST_IN_TASK).cast("int").alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    probes = (probes.join(hot, ["key", "band"], "left")
              .withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts").alias("s"))
    held = (held.join(hot, ["key", "band"], "left")
            .withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int")).drop("parts").alias("m"))
    n, m = F.col("s.n"), F.col("m.n")
    return (probes.join(held, (F.col("s.key") == F.col("m.key")) & (F.col("s.band") == F.col("m.band"))
                        & (F.col("s.part") == F.col("m.part")))
            .where((F.col("s.component") != F.col("m.component")) & (n <= m) & (m <= F.col("s.reach")) & (n <= F.col("m.reach"))
                   & (100 * n >= percent * m)
                   & (estimated_similarity(F.col("s.signature"), F.col("m.signature")) >= estimate_cut(percent)))
            .select(F.least("s.node", "m.node").alias("a"), F.greatest("s.node", "m.node").alias("b")))


def prefix_keys(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(node, n, place, key): the rarest shingles of each set, enough that linked sets share one.

    A linked set agrees in at least ``percent`` of ``n`` shingles, so two linked
    sets share one of their ``n - ceil(percent / 100 * n) + 1`` rarest ones.
    ``place`` counts from 0 in the order of rarity; shingles of one set alone
    come first and are left out.
    """
    grams = sets.select("node", "set", "n", F.explode("shingles").alias("key"))
    often = grams.groupBy("key").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    ranked = (grams.join(often, "key").groupBy("node", "set", "n")
              .agg(F.sort_array(F.collect_set(F.struct("held", "key"))).alias("ranked"))
              .withColumn("alone", F.col("n") - F.size("ranked"))
              .withColumn("length", F.expr(f"n - ({percent} * n + 99) div 100 + 1 - alone")))
    return (ranked.where("length > 0")
            .select("node", "n", "alone", F.posexplode(F.slice("ranked", F.lit(1), F.col("length").cast("int"))))
            .select("node", "n", (F.col("alone") + F.col("pos")).alias("place"), F.col("col.key").alias("key")))


def _divided(members: DataFrame) -> DataFrame:
    """Members (key, node, component, ...) of keys that more than one component holds, and the key's largest component."""
    split = (members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("largest"),
                                 F.count(F.lit(1)).alias("parts"))
             .where("parts > 1").select("key", "largest"))
    # a key that very many members share is dealt to several tasks
    lanes = split.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(LANES - 1))))
    dealt = members.withColumn("lane", F.pmod(F.xxhash64("node"), F.lit(LANES)).cast("int"))
    return dealt.join(lanes, ["key", "lane"]).drop("lane")


def _sets_of(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Full shingle sets of the documents in ``nodes`` (node), written to the shared folder."""
    texts = docs.select(F.col(id_col).cast("bigint").alias(id_col), text_col).join(
        nodes.select(F.col("node").alias(id_col)).distinct(), id_col, "left_semi")
    return stored(shingle_sets(texts, id_col, text_col), "minhash-sets")


def _confirmed(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """Of pairs (a, b) those whose full shingle sets are linked."""
    sets = _sets_of(docs, pairs.select(F.explode(F.array("a", "b")).alias("node")), id_col, text_col)
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b"))
    common = F.size(F.array_intersect("x", "y"))
    links = cut(both.select("a", "b", common.alias("i"), (F.size("x") + F.size("y")).alias("n"))
                .where("100 * i >= %d * (n - i)" % percent).select("a", "b").distinct())
    drop_stored(sets)
    return links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Links join documents whose sets of distinct five-word shingles have
    100 * intersection >= ``percent`` * union, 1 to 100.  A text with one to four words has its
    whole sequence as one shingle.  Null, empty and white-space texts have an
    empty set, link with nothing and are kept.  Rows that share a document id
    are one vertex of the link graph; a row without id links with nothing, has
    a null component and is kept.  An empty table gives an empty result.
    Other columns are ignored.
    """
    signed = stored(sign(docs, id_col, text_col, percent), "minhash-signed")
    nodes = stored(signed.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("digest")
                   .agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"),
                        F.first("signature").alias("signature"), F.first("bands").alias("bands")), "minhash-nodes")
    buckets = nodes.select(F.explode("bands").alias("key"), "node")
    shared = (buckets.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last"))
              .where("head < last").select("key", "head"))
    members = stored(buckets.join(shared, "key").distinct(), "minhash-buckets")
    facts = nodes.select("node", "n_shingles", "signature")

    stars = members.where("head <> node").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    pairs = cut(stars.join(facts.alias("l"), F.col("a") == F.col("l.node"))
                .join(facts.alias("r"), F.col("b") == F.col("r.node"))
                .where(_close("l", "r", percent)).select("a", "b").distinct())
    links = _confirmed(pairs, docs, id_col, text_col, percent)

    first = components(links)
    marked = cut(members.join(first, "node", "left")
                 .select("key", "node", "head", F.coalesce("component", "node").alias("component")))
    # a bucket's head has met all of its bucket already
    few = cut(_divided(marked.where("head <> node")).select("node", "component").distinct())
    sets = _sets_of(docs, few, id_col, text_col)
    keys = cut(prefix_keys(sets, percent).join(few, "node"))
    drop_stored(sets)
    open_ = with_reach(cut(_divided(keys)), percent).join(facts.withColumnRenamed("n_shingles", "n"), ["node", "n"])
    open_ = cut(open_.where("reach >= %d * n div 100" % percent))
    rest = open_.where("component <> largest")
    more = cut(_meet(rest, open_, percent).unionByName(_meet(open_, rest, percent)).distinct())
    if not more.isEmpty():
        links = cut(links.unionByName(_confirmed(more, docs, id_col, text_col, percent)).distinct())
        first = components(links)
    of_digest = nodes.select("digest", "node").join(first, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("component"))
    found = cut(signed.select("doc_id", "digest", "n_shingles").join(of_digest, "digest", "left")
                .select("doc_id", "n_shingles",
                        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
                .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
    drop_stored(signed, nodes, members)
    return found


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The documents with one of each near-duplicate group, all columns.

    Of rows that share a kept document id the one with the smallest text stays; rows without an id stay.
    """
    found = near_duplicates(docs, id_col, text_col, percent)
    kept = found.where(F.col("kept") & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias(id_col)).distinct()
    named = docs.where(F.col(id_col).isNotNull())
    rows = (named.join(kept, id_col, "left_semi").groupBy(id_col)
            .agg(F.min_by(F.struct(*[c for c in docs.columns if c != id_col]),
                      F.coalesce(text_col, F.lit(""))).alias("row"))
            .select(*[F.col(c) if c == id_col else F.col(f"row.{c}") for c in docs.columns]))
    return rows.unionByName(docs.where(F.col(id_col).isNull()))
