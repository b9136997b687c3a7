"""Near-duplicates by one-permutation MinHash, verified on whole shingle sets.

1. Documents with equal shingle sets are one class; only one row of a class goes on.
2. One hash deals a set's shingles over ``BANDS * ROWS`` bins; a bin's minimum is its signature, and an empty bin borrows
   that of the first filled bin in an order which its number alone fixes (optimal densification).  Two sets of
   similarity 0.85 share none of 36 bands of 6 bins with a chance of 4 in 10^8.
3. Each band is a bucket.  Candidate edges are a star: a bucket's hub, the least member, with all other members, so a
   bucket of n members makes n - 1 pairs, most of them known from other buckets.  Exact similarity makes them links,
   links make components.
4. A star tells nothing of two members that both miss the hub.  Buckets whose members, spent hubs apart, are still of
   several components get a new hub for a second star.  What is then unsettled is searched exactly, without buckets:
   by prefixes.  Of two sets that similar, the first shingles of each (rarest first; about 15 % of a set) share one
   (prefix filter), and its places in both bound the overlap (position filter); pairs within a component are left out.

So no bucket is cut short, and pairs never are all pairs of a bucket.  All joins are on plain keys that adaptive
execution splits where a key is heavy.  Sets hold 64-bit hashes of shingles: a chance of 2^-64 for each pair of
shingles of two compared documents stands against equality.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, stored, word_blocks
from .components import connected_components

SHINGLE, PERCENT = 3, 85
BANDS, ROWS = 36, 6
#: Stars before the exact search.
STARS = 2

_U = np.uint64
_BINS = BANDS * ROWS


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(text: bytes | None, k: int) -> np.ndarray:
    """The distinct shingles of ``k`` words of a text, as ascending hashes; fewer words are one shingle, none is none."""
    parts, few = [], []
    for block in word_blocks((text or b"").lower(), k - 1):
        if len(block) < k:
            few = block
            continue
        word = np.fromiter(map(xxhash.xxh64_intdigest, block), _U, len(block))
        s = np.zeros(len(word) - k + 1, _U)
        for j in range(k):
            s = _mix(s ^ word[j:len(s) + j])
        parts.append(np.unique(s))
    if not parts:
        return np.array([xxhash.xxh64_intdigest(b" ".join(few), 1)] if few else [], _U)
    return np.unique(np.concatenate(parts))


def _asked(bins: np.ndarray, first: int, many: int) -> np.ndarray:
    """The bins that each of the (empty) ``bins`` asks at the attempts ``first`` and on: hashes of its number and theirs."""
    asked = _mix(bins.astype(_U)[:, None] * _U(0x9E3779B97F4A7C15) + np.arange(first, first + many, dtype=_U)[None, :])
    return (asked % _U(_BINS)).astype(np.intp)


#: The first attempts of all bins, and how many of them are looked at together.
_ORDER = _asked(np.arange(_BINS), 1, 1024)
_STEPS = [(0, 8), (8, 40), (40, 168), (168, 1024)]


def signature(shingle: np.ndarray) -> np.ndarray:
    """The densified bins of a set that is not empty."""
    h = _mix(shingle ^ _U(0xD6E8FEB86659FD93))
    out = np.full(_BINS, ~_U(0))
    np.minimum.at(out, (h >> _U(40)).astype(np.int64) % _BINS, h)
    full = out != ~_U(0)
    if full.all():
        return out
    empty, at = np.flatnonzero(~full), 1025
    source = np.empty(_BINS, np.intp)
    left = empty
    for low, high in _STEPS:
        asked = _ORDER[left, low:high]
        hit = full[asked]
        found = hit.any(1)
        source[left[found]] = asked[found, hit[found].argmax(1)]
        left = left[~found]
        if not len(left):
            break
    while len(left):  # very few bins are filled
        asked = _asked(left, at, 1024)
        hit = full[asked]
        found = hit.any(1)
        source[left[found]] = asked[found, hit[found].argmax(1)]
        left, at = left[~found], at + 1024
    out[empty] = out[source[empty]]
    return out


def bands(sig: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band, the band's number being part of it."""
    key = np.arange(1, BANDS + 1, dtype=_U)
    for row in sig.reshape(BANDS, ROWS).T:
        key = _mix(key * _U(0xC2B2AE3D27D4EB4F) ^ row)
    return key.view(np.int64)


def _key(shingle: np.ndarray) -> str | None:
    """128 bits of hash over a whole set; null for the empty one."""
    return xxhash.xxh3_128_hexdigest(shingle.tobytes()) if len(shingle) else None


def _signed(k: int):
    """mapInArrow (doc_id, text_key, text): (doc_id, text_key, n, key, bands)."""
    def run(frames):
        for b in batches_of(frames):
            n, key, band = [], [], []
            for t in b.column(2).cast(pa.binary()).to_pylist():
                own = shingles(t, k)
                n.append(len(own))
                key.append(_key(own))
                band.append(bands(signature(own)) if len(own) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(key, pa.string()),
                                              pa.array(band, pa.list_(pa.int64()))], names=["doc_id", "text_key", "n", "key", "bands"])

    return run


def _whole_sets(k: int):
    """mapInArrow (node, key, text): (node, n, shingles) of the texts whose set has the key."""
    def run(frames):
        for b in batches_of(frames, 128):
            found = [(node, own) for node, key, t in zip(*(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist()))
                     if _key(own := shingles(t, k)) == key]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([len(f[1]) for f in found], pa.int64()),
                                              pa.array([f[1].view(np.int64) for f in found], pa.list_(pa.int64()))],
                                             names=["node", "n", "shingles"])

    return run


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose sets are similar enough, compared whole."""
    def side(c):
        return sets.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("shingles").alias(f"s_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b") \
        .where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    shared = F.size(F.array_intersect("s_a", "s_b"))
    return both.withColumn("shared", shared).where(F.col("shared") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("shared")) * percent) \
        .select("a", "b")


def _labelled(nodes: DataFrame, links: DataFrame | None) -> DataFrame:
    """``nodes`` with their component, the node itself where nothing links it."""
    if links is None:
        return nodes.withColumn("component", F.col("node"))
    found = stored(connected_components(links), "components")
    return nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _unsettled(members: DataFrame, links: DataFrame) -> DataFrame:
    """(bucket, node, component) of the buckets whose members are of several components."""
    now = stored(_labelled(members, links), "members")
    span = now.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    return stored(now.join(span.select("bucket"), "bucket"), "unsettled")


def _prefix_pairs(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of ``rest`` (node, component), of two components, that can reach the similarity."""
    own = stored(rest.join(sets.select("node", "n", "shingles"), "node"), "rest")
    count = own.select(F.explode("shingles").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("df"))
    ranked = own.select("node", "component", "n", F.explode("shingles").alias("s")).join(count, "s") \
        .groupBy("node", "component", "n").agg(F.sort_array(F.collect_list(F.struct("df", "s"))).alias("order"))
    # n - ceil(n * percent / 100) + 1 shingles; a shingle that no other set has leads to nothing but takes its place
    long = F.col("n") - F.ceil(F.col("n") * percent / 100 - 1e-9) + 1
    token = ranked.select("node", "component", "n", F.posexplode(F.slice("order", F.lit(1), long.cast("int"))).alias("at", "o")) \
        .where("o.df > 1").select(F.col("o.s").alias("s"), "node", "component", "n", "at")
    token = stored(token, "tokens")
    # of each shingle's sets those of its largest component meet the others only
    many = token.groupBy("s", "component").agg(F.count(F.lit(1)).alias("c"))
    main = many.groupBy("s").agg(F.max_by("component", F.struct("c", "component")).alias("main"), F.count(F.lit(1)).alias("k")).where("k > 1")
    token = stored(token.join(main.select("s", "main"), "s"), "open_tokens")
    minor = token.where("component <> main")
    left = minor.select("s", *[F.col(c).alias(f"{c}_a") for c in ("node", "component", "n", "at")])
    right = token.select("s", "main", *[F.col(c).alias(f"{c}_b") for c in ("node", "component", "n", "at")])
    # the first that two sets share is at these places, so what they share is at most what follows
    overlap = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    return left.join(right, "s").where((F.col("component_a") != F.col("component_b"))
                                       & ((F.col("component_b") == F.col("main")) | (F.col("node_a") < F.col("node_b")))
                                       & (overlap * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent)) \
        .select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def _sets_of(rows: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(node, n, shingles): the sets of the ``wanted`` rows, cut again from their texts."""
    asked = stored(wanted.select("node", "key", F.col("doc_id").alias("_id"), F.col("text_key").alias("_text_key")), "asked")
    texts = rows.join(asked, (F.col("text_key") == F.col("_text_key")) & F.col("doc_id").eqNullSafe(F.col("_id"))).select("node", "key", "text")
    sets = stored(texts.mapInArrow(_whole_sets(k), "node long, n long, shingles array<long>"), "sets")
    # rows that repeat id and text have one node and come once each
    return sets if sets.count() == asked.count() else stored(sets.dropDuplicates(["node"]), "sets")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    percent: int = PERCENT, stars: int = STARS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``.

    Words are runs of non-space characters of the whole text, A-Z lower-cased; a set holds the distinct shingles of
    ``shingle`` words, of a text with fewer words their whole sequence.  Two documents link when 100 * intersection >=
    ``percent`` * union of their sets; texts without words link with nothing.  ``component_id`` is the least doc_id that
    links reach, itself included; null only where all ids of the component are null.  ``kept``: the id is the
    component's (rows that share id and component are one document).  An empty table gives an empty result; other
    columns are not read."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    made = stored(rows.mapInArrow(_signed(shingle), f"doc_id {kind}, text_key long, n long, key string, bands array<long>")
                  .withColumn("node", F.monotonically_increasing_id()), "signed")
    full = made.where("key IS NOT NULL")
    classes = stored(full.groupBy("key").agg(F.min("node").alias("node"), F.min("doc_id").alias("first_id"),
                                             F.count(F.lit(1)).alias("copies")), "classes")
    # the rows of a class but its first
    later = full.select("node", "key").join(classes.where("copies > 1").select("key", F.col("node").alias("first")), "key") \
        .where("node <> first").select("node")
    each = full.select("node", "bands").join(stored(later, "later"), "node", "left_anti").select("node", F.explode("bands").alias("bucket"))
    each = stored(each, "bands")
    hubs = each.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub < last")
    members = stored(each.join(stored(hubs.select("bucket", "hub"), "hubs"), "bucket"), "members")
    sets = _sets_of(rows, full.join(stored(members.select("node").distinct(), "wanted"), "node"), shingle)
    links, tried, open_ = None, None, members
    for _ in range(stars):
        meet = open_ if tried is None else open_.where("component <> hub_component")
        pairs = meet.where("node <> hub").select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct()
        pairs = pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        found = stored(_links(pairs, sets, percent), "links")
        links = found if links is None else links.unionByName(found)
        # a hub has met all members of its bucket
        open_ = _unsettled(open_.where("node <> hub").select("bucket", "node"), links)
        if open_.isEmpty():
            break
        # the next hub: of the members outside the component of the least one
        least = open_.groupBy("bucket").agg(F.min("component").alias("least"))
        # stored, so that a heavy bucket's members are split in the join and folded in each task for the minimum
        other = stored(open_.join(least, "bucket").where("component <> least").select("bucket", "node", "component"), "others")
        hub = other.groupBy("bucket").agg(F.min("node").alias("hub"), F.min_by("component", "node").alias("hub_component"))
        open_ = stored(open_.join(hub, "bucket"), "open")
    if not open_.isEmpty():
        rest = stored(open_.select("node", "component").distinct(), "rest_nodes")
        pairs = stored(_prefix_pairs(rest, sets, percent).join(tried, ["a", "b"], "left_anti"), "rest_pairs")
        links = links.unionByName(stored(_links(pairs, sets, percent), "rest_links"))

    least = stored(_labelled(classes, links), "labels")
    named = least.join(least.groupBy("component").agg(F.min("first_id").alias("component_id")), "component")
    # only classes of several rows or in a component with others change anything
    told = stored(named.where("copies > 1 OR NOT (component_id <=> first_id)").select("key", "component_id"), "told")
    out = made.select("doc_id", "n", "key").join(told.withColumn("linked", F.lit(True)), "key", "left")
    out = out.withColumn("component_id", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("doc_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
