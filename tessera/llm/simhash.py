"""SimHash near-dedup over a Gray-order hierarchical index (operator 5).

Every text gets a 64-bit fingerprint of its word shingles. Equal fingerprints
form one class. Classes within ``max_bits`` differing bits are linked through
an index of masked bit patterns: an upper node is a mask and the pattern its
members share on it. Two fingerprints that differ in at most ``max_bits`` bits
agree wholly on one of ``max_bits + 1`` blocks, so they meet below one upper
node without any accumulated difference there. A node with more members than
``GROUP`` is factored again over its remaining bits by the same rule, so no
hot pattern is held whole; after six levels at most 2^12 distinct members can
remain below a node (for 3 bits). Below a node the members are sorted by Gray
rank; runs of neighbours form groups that store the bits all members share;
pairs of groups whose shared bits already differ too much are pruned together.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Wide, components, materialise, pick

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Most members of an upper node that one task links at once.
GROUP = 4096
#: Fan-out of the Gray-order groups.
FAN = 16
_FULL = (1 << 64) - 1


def fingerprint(data: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of one text (UTF-8 bytes): A-Z lower-cased, whitespace words, word shingles.

    Fewer words than a shingle: the whole sequence is the one shingle; no
    words (or null): 0. A bit is 1 if set in over half of the shingle hashes,
    repeats included. Works through long texts in blocks of 65,536 shingles.
    """
    if not data:
        return 0
    words = data.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - shingle + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = [e + i for i, e in enumerate(accumulate(map(len, words)))]
    starts = [0, *[e + 1 for e in ends[:n - 1]]]
    hashed = map(xxhash.xxh64_intdigest, map(joined.__getitem__, map(slice, starts, ends[shingle - 1:])), repeat(SEED))
    h = np.fromiter(hashed, dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 65536):
        part = h[i:i + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, text_hash, fp`` (fp: signed 64-bit long with the fingerprint's bits), one row per input row."""
    @F.pandas_udf("long")
    def fp(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield pd.Series(np.array([fingerprint(b, shingle) for b in s], dtype=np.uint64).view(np.int64))

    d = pick(docs, "doc_id", "text")
    return d.select("doc_id", text_hash(F.col("text")).alias("text_hash"), fp(F.coalesce(F.col("text").cast("binary"), F.lit(b""))).alias("fp"))


def text_hash(text) -> Column:
    """64-bit hash that tells rows of one doc_id apart (null text as the empty one)."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def split_mask(fixed: int, blocks: int) -> list[int]:
    """Masks of the child nodes of a node with ``fixed`` bits: the rest in ``blocks`` equal runs, each added."""
    rest = [i for i in range(64) if not fixed >> i & 1]
    cut = [len(rest) * k // blocks for k in range(blocks + 1)]
    return [fixed | sum(1 << i for i in rest[a:b]) for a, b in zip(cut, cut[1:]) if b > a]


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Rank of a code word in the binary reflected Gray order."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Union of the pairs (i, j) in ``label`` (each entry points to a smaller member of its set, roots to themselves)."""
    while True:
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            return
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(label, nxt := label[label]):
            label[:] = nxt


def link_group(f: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Component label (smallest position) of each fingerprint of one node by the Gray-order index.

    ``f`` (uint64) is sorted by Gray rank here. Level by level, pairs of groups
    survive only while the bits that both groups share whole differ in at most
    ``max_bits`` places; the members of surviving leaf pairs are compared.
    """
    n = len(f)
    order = np.argsort(gray_rank(f), kind="stable")
    x = f[order]
    levels = [(x, x)]  # (bits set in all members, bits set in any member)
    while len(levels[-1][0]) > FAN:
        lo, hi = levels[-1]
        at = np.arange(0, len(lo), FAN)
        levels.append((np.bitwise_and.reduceat(lo, at), np.bitwise_or.reduceat(hi, at)))
    label = np.arange(n)
    top = len(levels[-1][0])
    i, j = np.triu_indices(top)

    def descend(level: int, i: np.ndarray, j: np.ndarray) -> None:
        every, some = levels[level]
        if level == 0:
            keep = (i != j) & (np.bitwise_count(x[i] ^ x[j]) <= max_bits)
            _merge(label, i[keep], j[keep])
            return
        differ = (every[i] & ~some[j]) | (every[j] & ~some[i])  # set in all of one group, in none of the other
        keep = np.bitwise_count(differ) <= max_bits
        i, j = i[keep], j[keep]
        below = len(levels[level - 1][0])
        step = 1 << 12
        for s in range(0, len(i), step):
            a = (i[s:s + step, None, None] * FAN + np.arange(FAN)[None, :, None] + np.zeros((1, 1, FAN), dtype=np.int64)).ravel()
            b = (j[s:s + step, None, None] * FAN + np.arange(FAN)[None, None, :] + np.zeros((1, FAN, 1), dtype=np.int64)).ravel()
            ok = (a < below) & (b < below) & (a <= b)
            descend(level - 1, a[ok], b[ok])

    descend(len(levels) - 1, i, j)
    out = np.empty(n, dtype=np.int64)
    # name each component by the smallest position in the caller's order
    first = np.full(n, n, dtype=np.int64)
    np.minimum.at(first, label, order)
    out[order] = first[label]
    return out


def _link_partition(parts: Iterator[pd.DataFrame], max_bits: int) -> Iterator[pd.DataFrame]:
    """Star edges of the components below each node; rows come sorted by (mask, pattern)."""
    def edges(mask, pattern, f):
        n = len(f)
        if n < 2:
            return
        new = np.empty(n, dtype=bool)
        new[0] = True
        new[1:] = (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, n))
        gid = np.repeat(np.arange(len(start)), size)
        label = np.arange(n)
        # small nodes: one leaf each, all of them at once by offset
        small = size[gid] <= FAN
        for off in range(1, min(FAN, n)):
            i = np.arange(n - off)
            i = i[small[i] & (gid[i] == gid[i + off])]
            if not len(i):
                break
            hit = i[np.bitwise_count(f[i] ^ f[i + off]) <= max_bits]
            _merge(label, hit, hit + off)
        for s, m in zip(start[size > FAN], size[size > FAN]):
            label[s:s + m] = link_group(f[s:s + m], max_bits) + s
        linked = np.flatnonzero(label != np.arange(n))
        if len(linked):
            yield pd.DataFrame({"a": f[linked].view(np.int64), "b": f[label[linked]].view(np.int64)})

    held = None
    for pdf in parts:
        if not len(pdf):
            continue
        got = [pdf["mask"].to_numpy(np.int64), pdf["pattern"].to_numpy(np.int64), pdf["fp"].to_numpy(np.int64).view(np.uint64)]
        if held is not None:
            got = [np.concatenate(x) for x in zip(held, got)]
        mask, pattern, f = got
        change = np.flatnonzero((mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1]))
        cut = int(change[-1]) + 1 if len(change) else 0
        yield from edges(mask[:cut], pattern[:cut], f[:cut])
        held = [v[cut:] for v in got]
    if held is not None:
        yield from edges(*held)


def link_fingerprints(classes: DataFrame, max_bits: int = MAX_BITS, group: int = GROUP) -> DataFrame:
    """Edges ``(a, b)`` that connect distinct fingerprints ``fp`` within ``max_bits`` bits, chained or direct.

    The edges span exactly the components of the full link graph (at most one
    edge per member and node), without emitting all pairs below a node.
    """
    blocks = max_bits + 1
    rows = classes.select("fp")
    done = None
    nodes = rows.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in split_mask(0, blocks)])).alias("mask"))
    while True:
        nodes = materialise(nodes.withColumn("pattern", F.col("fp").bitwiseAND(F.col("mask"))))
        hot = materialise(nodes.groupBy("mask", "pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group).drop("n"))
        if hot.isEmpty():
            break
        # hot nodes are factored once more over their free bits (while these leave more members than a group); the others are ready
        masks = [r["mask"] for r in hot.select("mask").distinct().collect()]  # at most (max_bits + 1) ** level
        kids = [(m, [_signed(k) for k in split_mask(m & _FULL, blocks)]) for m in masks if 64 - (m & _FULL).bit_count() > 12]
        if not kids:
            break
        table = F.broadcast(nodes.sparkSession.createDataFrame(kids, "mask long, kids array<long>"))
        hot = hot.join(table, "mask")
        ready = nodes.join(hot, ["mask", "pattern"], "left_anti")
        done = ready if done is None else done.unionByName(ready)
        nodes = nodes.join(hot, ["mask", "pattern"]).select("fp", F.explode("kids").alias("mask")).distinct()
    return _edges(nodes if done is None else done.unionByName(nodes), max_bits)


def _edges(nodes: DataFrame, max_bits: int) -> DataFrame:
    return (nodes.select("mask", "pattern", "fp").repartition("mask", "pattern").sortWithinPartitions("mask", "pattern")
            .mapInPandas(lambda parts: _link_partition(parts, max_bits), "a long, b long"))


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, group: int = GROUP) -> DataFrame:
    """One row per document: ``doc_id, text_hash, fp, root, component_id``.

    ``root`` names the component (a fingerprint, never null), ``component_id``
    is the smallest doc_id reachable over links, itself included. Texts that
    are null or hold no word have fingerprint zero and link like any other.
    Null doc_ids never name a component that has another id (only a component
    of null ids has a null component_id); repeated rows come out once each. An
    empty table gives an empty result; extra columns are ignored.
    """
    fps = materialise(fingerprints(docs, shingle))
    classes = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("low")))
    comp = components(link_fingerprints(classes, max_bits, group))
    # fingerprints without any link are their own component
    named = classes.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    low = named.groupBy("root").agg(F.min("low").alias("component_id"))
    table = materialise(named.select("fp", "root").join(low, "root"))
    return fps.join(table, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def hex16(fp) -> Column:
    """The 16 lowercase hex digits of a signed 64-bit fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, group: int = GROUP) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: that of the smallest doc_id (nulls last).

    Documents that share a doc_id but not the text are told apart by a hash of
    the text; rows that repeat both are reduced to one of them. All columns
    pass through untouched.
    """
    w = Wide(docs)
    c = materialise(simhash_components(docs, shingle, max_bits, group))
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("won_id"), F.col("text_hash").alias("won_hash"))
    best = c.groupBy("root").agg(F.min(order).alias("w")).select("w.won_id", "w.won_hash")
    rows = c.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    best = materialise(best.join(rows, best["won_id"].eqNullSafe(rows["doc_id"]) & (best["won_hash"] == rows["text_hash"]), "left")
                       .select("won_id", "won_hash", F.col("n").isNotNull().alias("repeated")))
    same = w.col("doc_id").eqNullSafe(F.col("won_id")) & (text_hash(w.col("text")) == F.col("won_hash"))
    once = w.frame.join(best.where("not repeated"), same, "left_semi")
    many = best.where("repeated")
    if many.isEmpty():
        return w.restore(once)
    again = (w.frame.withColumn("text_hash", text_hash(w.col("text"))).withColumn("doc_id", w.col("doc_id"))
             .join(many, F.col("doc_id").eqNullSafe(F.col("won_id")) & (F.col("text_hash") == F.col("won_hash")), "left_semi")
             .dropDuplicates(["doc_id", "text_hash"]))
    return w.restore(once).union(w.restore(again))
