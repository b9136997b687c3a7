"""SimHash near-duplicates by a self-join of binary tries.

Fingerprints are 64-bit SimHashes of word shingles.  Two differ in at most ``max_bits`` bits only if they agree
wholly on one of ``max_bits + 1`` blocks of bits, so the join runs over that many tries, each over the fingerprints
rotated to begin with another block.  A pair of nodes is walked down together; the bits in which the two paths
differ add up, and a pair beyond the budget is pruned with all that is below it.  In the trie of a block only equal
prefixes need be started, so a trie falls apart by its first block and the parts are dealt out over the cluster
without copying any fingerprint.  A part that is too large for a task is opened level by level (as a DataFrame of
node pairs) until each remaining pair of subtries is small enough.

Within a part the matched pairs are folded into a spanning forest before they leave the task: a cluster of n
fingerprints sends n - 1 links, however many pairs it has.
"""
from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, stored, word_blocks
from .components import connected_components

SEED = 42
#: Fingerprints that a task walks at once, and node pairs it keeps in one array.
PART_ROWS, FRONTIER = 50_000, 500_000
#: Bits by which a part that is too large is opened at a time.
STRIDE = 4


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The SimHash of a text in UTF-8 (A-Z lower-cased): bit i is set if over half the shingle hashes have it set."""
    counts, total = np.zeros(64, np.int64), 0
    first: list = []
    for block in word_blocks((text or b"").lower(), shingle - 1):
        if len(block) < shingle:
            first = block
            continue
        parts = zip(*(block[k:] for k in range(shingle))) if shingle > 1 else zip(block)
        h = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, parts), repeat(SEED)), np.uint64)
        total += len(h)
        for at in range(0, len(h), 1 << 15):
            part = h[at:at + (1 << 15)].view(np.uint8).reshape(-1, 8)
            counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    if not total and first:
        return xxhash.xxh64_intdigest(b" ".join(first), SEED)
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.uint64)[0]) if total else 0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                 text_key: bool = False) -> DataFrame:
    """(doc_id, fp): a row per row of ``docs``; the fingerprint as a signed 64-bit integer; with ``text_key`` also the
    text's sha256 (null counts as empty).

    Null and wordless texts have the fingerprint zero, and a text of fewer words than a shingle has the hash of its
    whole word sequence.  A null id stays null.  Other columns are not read."""
    def run(frames):
        for b in batches_of(frames):
            texts = b.column(1).cast(pa.binary()).to_pylist()
            fps = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64)), *b.columns[2:]],
                                             names=["doc_id", "fp", *(["text_sha256"] if text_key else [])])

    text = F.col(text_col).cast("string")
    key = [F.sha2(F.coalesce(text, F.lit("")), 256).alias("text_sha256")] if text_key else []
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), *key) \
        .mapInArrow(run, "doc_id long, fp long" + ", text_sha256 string" * text_key)


def _rotl(x: np.ndarray, by: np.ndarray) -> np.ndarray:
    by = by.astype(np.uint64) & np.uint64(63)
    return (x << by) | (x >> ((np.uint64(64) - by) & np.uint64(63)))


def _fold(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge the trees of ``label`` that the pairs (i, j) link; ``label`` ends flat, with the least index as root."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(flat := label[label], label):
            label[:] = flat


def walk(key: np.ndarray, depth: int, pairs: tuple, max_bits: int, label: np.ndarray) -> None:
    """Walk pairs of trie nodes down and fold the matches into ``label``.

    ``key``: sorted keys; a node is a range of them.  ``pairs``: arrays (a_lo, a_hi, b_lo, b_hi, bits) of node pairs
    at ``depth``, where a pair is either a node with itself or two nodes without a common key."""
    ones: dict[int, np.ndarray] = {}
    stack = [(depth, *pairs)]
    while stack:
        d, al, ah, bl, bh, err = stack.pop()
        same = (al == bl) & (ah == bh)
        keep = (ah > al) & (bh > bl) & (err <= max_bits) & ~(same & (ah - al < 2))
        single = keep & ~same & (ah - al == 1) & (bh - bl == 1)
        if single.any():  # two leaves: the rest of their bits at once
            i, j = al[single], bl[single]
            near = np.bitwise_count(key[i] ^ key[j]) <= max_bits
            if near.any():
                _fold(label, i[near], j[near])
        keep &= ~single
        if d >= 64 or not keep.any():
            continue
        al, ah, bl, bh, err, same = (x[keep] for x in (al, ah, bl, bh, err, same))
        if len(al) > FRONTIER:
            for at in range(0, len(al), FRONTIER):
                stack.append((d, *(x[at:at + FRONTIER] for x in (al, ah, bl, bh, err))))
            continue
        if d not in ones:
            bit = (key >> np.uint64(63 - d)) & np.uint64(1)
            ones[d] = np.concatenate([np.zeros(1, np.int64), np.cumsum(bit, dtype=np.int64)])
        c = ones[d]
        am, bm = ah - (c[ah] - c[al]), bh - (c[bh] - c[bl])
        one, two = err + 1, ~same
        stack.append((d + 1,
                      np.concatenate([al, am, al, am[two]]), np.concatenate([am, ah, am, ah[two]]),
                      np.concatenate([bl, bm, bm, bl[two]]), np.concatenate([bm, bh, bh, bm[two]]),
                      np.concatenate([err, err, one, one[two]])))


def _parts(max_bits: int):
    """A mapInArrow function over rows (rot, depth, a, b, key), the rows of a part together: links (x, y)."""
    def links(rows: list[np.ndarray]):
        rot, depth, a, b, key = (np.concatenate(x) for x in zip(*rows))
        a, b, key = (x.view(np.uint64) for x in (a, b, key))
        order = np.lexsort((key, b, a, depth, rot))
        rot, depth, a, b, key = (x[order] for x in (rot, depth, a, b, key))
        new = (np.diff(rot) != 0) | (np.diff(depth) != 0) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        lo = np.concatenate([[0], np.flatnonzero(new) + 1])
        hi = np.append(lo[1:], len(key))
        label = np.arange(len(key))
        for d in np.unique(depth[lo]).tolist():
            at = depth[lo] == d
            l, h = lo[at], hi[at]
            shift = np.uint64(64 - d)
            # keys under b follow those under a, since a < b
            under = np.concatenate([[0], np.cumsum((key >> shift if d < 64 else key) == a)])
            mid = l + under[h] - under[l]
            same = a[l] == b[l]
            err = np.bitwise_count(a[l] ^ b[l]).astype(np.int64)
            walk(key, d, (l, np.where(same, h, mid), np.where(same, l, mid), h, err), max_bits, label)
        own = np.flatnonzero(label != np.arange(len(label)))
        back = (64 - rot[own]) & 63
        return _rotl(key[own], back).view(np.int64), _rotl(key[label[own]], back).view(np.int64)

    def run(frames):
        held: list = []
        n, last = 0, None
        for f in frames:
            if not f.num_rows:
                continue
            cols = [f.column(k).to_numpy(zero_copy_only=False) for k in range(5)]
            # the rows after the last change of part may go on in the next batch
            change = np.zeros(f.num_rows, bool)
            for c in cols[:4]:
                change[1:] |= c[1:] != c[:-1]
            change[0] = last is not None and last != tuple(int(c[0]) for c in cols[:4])
            last = tuple(int(c[-1]) for c in cols[:4])
            cut = int(np.flatnonzero(change)[-1]) if change.any() else -1
            if cut >= 0 and n + cut >= PART_ROWS // 4:
                held.append([c[:cut] for c in cols])
                x, y = links(held)
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["x", "y"])
                held, n, cols = [], 0, [c[cut:] for c in cols]
            held.append(cols)
            n += len(cols[0])
        if n:
            x, y = links(held)
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["x", "y"])

    return run


def links(fps: DataFrame, max_bits: int = 3, part_rows: int = PART_ROWS) -> DataFrame:
    """(x, y): pairs of different fingerprints that span the same components as all pairs within ``max_bits`` bits.

    ``fps`` has a column ``fp`` of distinct fingerprints.  ``part_rows`` bounds what one task walks at once and never
    changes the components."""
    blocks = max_bits + 1
    head = 64 // blocks
    # key: the fingerprint rotated left by rot bits, so that block number rot / head comes first
    rotated = fps.select("fp", F.explode(F.array(*[F.lit(k * head) for k in range(blocks)])).alias("rot"))
    key = F.expr("shiftleft(fp, rot) | IF(rot = 0, 0L, shiftrightunsigned(fp, 64 - rot))")
    keys = rotated.select("rot", key.alias("key")).withColumn("a", F.shiftrightunsigned("key", 64 - head))
    crowded = stored(keys.groupBy("rot", "a").agg(F.count("key").alias("n")).where(F.col("n") > part_rows), "crowded")
    whole = keys.withColumn("b", F.col("a")).withColumn("depth", F.lit(head))
    if not crowded.isEmpty():
        whole = whole.join(crowded.select("rot", "a"), ["rot", "a"], "left_anti")
        inner = stored(keys.join(crowded.select("rot", "a"), ["rot", "a"], "left_semi").select("rot", "key"), "crowd")
        for depth, pairs in _open(inner, crowded, head, max_bits, part_rows):
            node = F.shiftrightunsigned("key", 64 - depth) if depth < 64 else F.col("key")
            at = inner.withColumn("node", node)
            for side in ("a", "b"):
                use = pairs if side == "a" else pairs.where("a != b")
                whole = whole.unionByName(at.join(use.withColumn("node", F.col(side)), ["rot", "node"])
                                          .select("rot", "key", "a", "b", F.lit(depth).alias("depth")))
    part = ["rot", "depth", "a", "b"]
    whole = whole.select(*part, "key").repartition(*part).sortWithinPartitions(*part)
    return whole.mapInArrow(_parts(max_bits), "x long, y long")


def _open(keys: DataFrame, crowded: DataFrame, depth: int, max_bits: int, part_rows: int):
    """Walk the crowded nodes down until each pair holds at most ``part_rows`` keys: (depth, pairs (rot, a, b))."""
    pairs = crowded.select("rot", "a", F.col("a").alias("b"))
    while True:
        step = min(STRIDE, 64 - depth)
        depth += step
        child = keys.groupBy("rot", (F.shiftrightunsigned("key", 64 - depth) if depth < 64 else F.col("key"))
                             .alias("node")).agg(F.count("key").alias("n"))
        child = stored(child.withColumn("up", F.shiftrightunsigned("node", step)), "nodes")
        left = child.select("rot", F.col("up").alias("a"), F.col("node").alias("a2"), F.col("n").alias("na"))
        right = child.select("rot", F.col("up").alias("b"), F.col("node").alias("b2"), F.col("n").alias("nb"))
        # unsigned order of the children: by the parents, then by the last bits, which are never negative
        last = (1 << step) - 1
        grown = pairs.join(left, ["rot", "a"]).join(right, ["rot", "b"]) \
            .where((F.col("a") != F.col("b")) | (F.col("a2").bitwiseAND(last) <= F.col("b2").bitwiseAND(last))) \
            .where(F.bit_count(F.col("a2").bitwiseXOR(F.col("b2"))) <= max_bits) \
            .select("rot", F.col("a2").alias("a"), F.col("b2").alias("b"),
                    F.when(F.col("a2") == F.col("b2"), F.col("na")).otherwise(F.col("na") + F.col("nb")).alias("n"))
        grown = stored(grown, "pairs")
        small = grown.where(F.col("n") <= part_rows) if depth < 64 else grown
        yield depth, small.select("rot", "a", "b")
        pairs = grown.where(F.col("n") > part_rows).select("rot", "a", "b")
        if depth >= 64 or pairs.isEmpty():
            return


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 3, text_key: bool = False) -> DataFrame:
    """(doc_id, fp, component_id) for each row of ``docs``: the least doc_id that links of at most ``max_bits``
    differing bits reach, itself included.

    Rows of one fingerprint are one node, so copies cost nothing beyond their own row.  Null or wordless texts share
    the fingerprint zero and link like any other.  A null id is never the least; if all ids of a component are null,
    ``component_id`` is null.  Repeated rows are kept; an empty table gives an empty result.  With ``text_key`` each row
    also has its text's ``text_sha256`` and its ``component``, which is never null."""
    prints = stored(fingerprints(docs, id_col, text_col, shingle, text_key), "fps")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    comp = connected_components(links(nodes.select("fp"), max_bits), "x", "y")
    comp = comp.withColumnRenamed("node", "fp")
    named = nodes.join(comp, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    named = stored(named, "named")
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    more = ["component"] if text_key else []
    ids = named.join(least, "component").select("fp", "component_id", *more)
    return prints.join(ids, "fp").select("doc_id", "fp", "component_id", *(["text_sha256", *more] if text_key else []))
