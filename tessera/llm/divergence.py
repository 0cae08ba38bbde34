"""Source divergence audit by a minimal-perfect-hash recount (operator 11).

A first pass counts, exactly, in how many documents of its language each term
occurs, and keeps the terms of at least ``LEAST_DOCS``. The kept terms of a
language are cut into shards, each with a minimal perfect hash (hash,
displace) and its keys in slot order. Waves of shards under a size bound are
broadcast; the second pass looks every counted term up, verifies the stored
key, and increments dense slots per (language, source) group. Divergences
follow from the slots in exact integers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tessera.functions.skew import top_k_per_key
from tessera.llm.common import materialise, pick

LEAST_DOCS = 10
SCALE = 1_000_000_000
TOP = 10
#: Keys of a shard, about; bytes of the shards that are broadcast together; slots a task holds before it writes them out.
SHARD_KEYS = 4096
WAVE_BYTES = 16 << 20
MOST_SLOTS = 1 << 22
#: Sources of one block: a task compares two blocks over one shard.
SOURCE_BLOCK = 64
#: Terms of a task's first-pass table before it writes them out.
MOST_TERMS = 400_000

# every byte of a UTF-8 character past 0x7F belongs to a term, so bytes can be cut without decoding them
_CUT = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """All ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` matches of a UTF-8 text, A-Z lower-cased."""
    return text.translate(_CUT).split()


def key_hash(keys: list[bytes], seed: int = 0) -> np.ndarray:
    """64-bit hashes of byte strings, seeded."""
    return pd.util.hash_array(_objects(keys), hash_key=f"{seed:016d}", categorize=False)


def _objects(keys: list[bytes]) -> np.ndarray:
    out = np.empty(len(keys), dtype=object)
    out[:] = keys
    return out


class PerfectHash:
    """Minimal perfect hash of distinct keys: each bucket's displacement moves its keys to free slots."""

    def __init__(self, seed: int, displace: np.ndarray, keys: list[bytes]):
        self.seed, self.displace, self.keys = seed, displace, keys

    @staticmethod
    def _places(h: np.ndarray, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        u = np.uint64
        return ((h >> u(40)) % u(buckets)).astype(np.int64), ((h & u(0xFFFFF)) % u(n)).astype(np.int64), ((h >> u(20)) % u(max(1, n - 1))).astype(np.int64) + 1

    @classmethod
    def of(cls, keys: list[bytes]) -> "PerfectHash":
        """Tries seeds until every key has a slot of its own; a seed that lets two keys collide is given up."""
        n = len(keys)
        buckets = max(1, n // 3)
        for seed in range(1000):
            h = key_hash(keys, seed)
            bucket, start, step = cls._places(h, n, buckets)
            displace, free, slot = np.zeros(buckets, np.int64), np.ones(n, bool), np.zeros(n, np.int64)
            order = np.argsort(bucket, kind="stable")
            bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in np.argsort(-np.diff(bounds), kind="stable"):
                mine = order[bounds[b]:bounds[b + 1]]
                if len(mine) == 0:
                    break
                for turn in range(256):
                    at = (start[mine] + turn * step[mine]) % n
                    if len(set(at.tolist())) < len(at):
                        continue
                    fits = np.flatnonzero(free)
                    shift = (fits - at[0]) % n  # only shifts that put the first key on a free slot
                    for other in at[1:]:
                        shift = shift[free[(other + shift) % n]]
                    if len(shift):
                        slot[mine] = (at + shift[0]) % n
                        free[slot[mine]] = False
                        displace[b] = turn * n + shift[0]
                        break
                else:
                    break
            if not free.any():
                out = np.empty(n, dtype=object)
                out[slot] = keys
                return cls(seed, displace, out.tolist())
        raise ValueError("no perfect hash found: the keys are not distinct")


class Lookup:
    """Several shards of one language side by side: terms -> global slots, -1 for terms that are not stored."""

    def __init__(self, shards: int, held: dict[int, tuple[int, list[int], list[bytes]]]):
        """``shards`` is the language's number of shards, ``held`` (seed, displace, keys) of those in this wave."""
        self.shards = shards
        self.size, self.start, self.at = (np.zeros(shards, np.int64) for _ in range(3))
        self.seed = np.full(shards, -1, np.int64)
        n = d = 0
        for s in sorted(held):
            seed, displace, keys = held[s]
            self.size[s], self.start[s], self.at[s], self.seed[s] = len(keys), n, d, seed
            n, d = n + len(keys), d + len(displace)
        self.n = n
        self.displace = np.concatenate([np.array(held[s][1], np.int64) for s in sorted(held)])
        self.keys = _objects([k for s in sorted(held) for k in held[s][2]])

    def slots(self, terms: list[bytes]) -> np.ndarray:
        out = np.full(len(terms), -1, np.int64)
        h0 = key_hash(terms)
        shard = shard_of(h0, self.shards)
        known = _objects(terms)
        for seed in np.unique(self.seed[self.seed >= 0]):
            mine = np.flatnonzero(self.seed[shard] == seed)
            if not len(mine):
                continue
            h = h0[mine] if seed == 0 else key_hash([terms[i] for i in mine], int(seed))
            s = shard[mine]
            n = self.size[s].astype(np.uint64)
            u = np.uint64
            bucket = ((h >> u(40)) % np.maximum(n // u(3), u(1))).astype(np.int64)
            n = n.astype(np.int64)
            start = (h & u(0xFFFFF)).astype(np.int64) % n
            step = ((h >> u(20)) % np.maximum(n - 1, 1).astype(np.uint64)).astype(np.int64) + 1
            d = self.displace[self.at[s] + bucket]
            slot = self.start[s] + (start + d // n * step + d % n) % n
            ok = self.keys[slot] == known[mine]  # a term that was not kept meets another term's key
            out[mine[ok]] = slot[ok]
        return out

    def shard_and_slot(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Global slots -> (shard, slot in it)."""
        held = np.flatnonzero(self.seed >= 0)
        i = held[np.searchsorted(self.start[held], slots, side="right") - 1]
        return i, slots - self.start[i]


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return np.mod(h.view(np.int64), shards)


def _rows(cols: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema)], schema=schema)


def _document_terms(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Per task: in how many of its documents of a language each term occurs, with the term's hash."""
    seen: dict[str, Counter] = {}

    def flush():
        for lang, count in seen.items():
            if count:
                keys = list(count)
                yield _rows([[lang] * len(keys), keys, key_hash(keys).view(np.int64), list(count.values())], schema)
        seen.clear()

    held = 0
    for b in batches:
        for text, lang in zip(b.column(0), b.column(1)):
            count = seen.setdefault(lang.as_py(), Counter())
            held -= len(count)
            count.update(set(terms_of(text.as_py())))
            held += len(count)
            if held > MOST_TERMS:
                yield from flush()
                held = 0
    yield from flush()


def _shard_record(pdf: pd.DataFrame) -> pd.DataFrame:
    p = PerfectHash.of(sorted(pdf["term"]))
    return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "shard": [pdf["shard"].iloc[0]], "seed": [p.seed], "displace": [p.displace.tolist()], "keys": [p.keys]})


def _recount(batches: Iterator[pa.RecordBatch], shards, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Per task: occurrences of the stored terms in dense slots per (language, source)."""
    lookup = {lang: Lookup(n, held) for lang, (n, held) in shards.value.items()}
    dense: dict[tuple[str, str], np.ndarray] = {}

    def flush():
        for (lang, source), slots in dense.items():
            hit = np.flatnonzero(slots)
            shard, slot = lookup[lang].shard_and_slot(hit)
            yield _rows([[lang] * len(hit), [source] * len(hit), shard, slot, slots[hit]], schema)
        dense.clear()

    def add(group, count):
        if group not in dense:
            dense[group] = np.zeros(lookup[group[0]].n, np.int64)
        slot = lookup[group[0]].slots(list(count))
        n = np.fromiter(count.values(), np.int64, len(count))
        dense[group][slot[slot >= 0]] += n[slot >= 0]

    for b in batches:
        some: dict[tuple[str, str], Counter] = {}
        for text, lang, source in zip(b.column(0), b.column(1), b.column(2)):
            group = (lang.as_py(), source.as_py())
            if group[0] in lookup:
                count = some.setdefault(group, Counter())
                count.update(terms_of(text.as_py()))
                if len(count) > MOST_TERMS:
                    add(group, some.pop(group))
        for group, count in some.items():
            if count:
                add(group, count)
            if sum(map(len, dense.values())) > MOST_SLOTS:
                yield from flush()
    yield from flush()


def _block_pairs(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sums of f over one shard for every pair of sources of two blocks.

    ``pdf`` has per source one row with slot -1 (p of a term that the source
    lacks, the shard's size in ``n``) and one row per slot that it holds.
    """
    empty = pdf["slot"].to_numpy() < 0
    heads = pdf[empty].sort_values("source", kind="stable")
    names = heads["source"].tolist()
    index = {s: i for i, s in enumerate(names)}
    p = np.repeat(heads["p"].to_numpy(np.int64)[:, None], int(heads["n"].iloc[0]), axis=1)
    body = pdf[~empty]
    p[body["source"].map(index).to_numpy(np.int64), body["slot"].to_numpy(np.int64)] = body["p"].to_numpy(np.int64)
    low, high = int(pdf["block_a"].iloc[0]), int(pdf["block_b"].iloc[0])
    block = heads["block"].to_numpy()
    a_rows, b_rows = np.flatnonzero(block == low), np.flatnonzero(block == high)
    out = []
    for i in a_rows:
        js = b_rows[b_rows > i] if low == high else b_rows
        if len(js):
            f = ((p[js] - p[i]) ** 2 // (p[js] + p[i])).sum(axis=1)
            out += [(names[i], names[j], int(v)) for j, v in zip(js, f)]
    text = lambda v: pd.Series(v, dtype=object)
    return pd.DataFrame({"lang": text([pdf["lang"].iloc[0]] * len(out)), "a": text([x[0] for x in out]), "b": text([x[1] for x in out]), "value": pd.Series([x[2] for x in out], dtype="int64")})


def _share(count: Column, n: Column, v: Column) -> Column:
    """p = 1 + floor(10^9 (count + 2) / (N + 2 V)), exact for any count."""
    big = lambda c: c.cast("decimal(20,0)")
    return (F.lit(1) + F.call_function("div", big(count + 2) * F.lit(SCALE).cast("decimal(10,0)"), big(n + 2 * v))).cast("long")


def _distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q).cast("long")


class Recount:
    """Tables of the two passes, all in the shared folder.

    ``groups`` (lang, source), ``kept`` (lang, term, shard, shards, v),
    ``shards`` (lang, shard, seed, displace, keys), ``counts`` (lang, source,
    shard, slot, n). The driver holds one wave of shards at a time (at most
    ``WAVE_BYTES`` of keys and displacements, or one shard).
    """

    def __init__(self, docs: DataFrame, least_docs: int = LEAST_DOCS):
        spark = docs.sparkSession
        d = pick(docs, "text", "lang", "source")
        blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
        self.d = d.select(F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"), blank("lang").alias("lang"), blank("source").alias("source"))
        self.groups = materialise(self.d.select("lang", "source").distinct())
        first = spark.createDataFrame([], "lang string, term binary, h long, n long").schema
        arrow = _arrow(first)
        common = (self.d.select("text", "lang").mapInArrow(lambda b: _document_terms(b, arrow), first)
                  .groupBy("lang", "term").agg(F.first("h").alias("h"), F.sum("n").alias("docs")).where(F.col("docs") >= least_docs))
        common = materialise(common.select("lang", "term", "h"))
        self.sizes = materialise(common.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
                                 .withColumn("shards", F.ceil(F.col("v") / SHARD_KEYS).cast("long")))
        kept = common.join(self.sizes, "lang").withColumn("shard", F.pmod("h", "shards"))
        self.shards = materialise(kept.select("lang", "shard", "term").groupBy("lang", "shard")
                                  .applyInPandas(_shard_record, "lang string, shard long, seed int, displace array<long>, keys array<binary>"))
        self.counts = materialise(self._count(spark))

    def _waves(self) -> list[Column]:
        """Conditions that cut the shards into waves of at most WAVE_BYTES (or one shard each)."""
        weight = F.aggregate("keys", F.lit(0).cast("long"), lambda acc, k: acc + F.octet_length(k) + 16) + 8 * F.size("displace")
        part = F.xxhash64("lang", "shard")
        total = self.shards.agg(F.sum(weight)).first()[0] or 0
        waves = 1
        while waves * WAVE_BYTES < total:
            waves *= 2
        while waves > 1:  # hashing is uneven: more waves until the heaviest fits or is a single shard
            heaviest = self.shards.groupBy(F.pmod(part, F.lit(waves))).agg(F.sum(weight).alias("w"), F.count(F.lit(1)).alias("k")).where("k > 1").agg(F.max("w")).first()[0]
            if (heaviest or 0) <= WAVE_BYTES:
                break
            waves *= 2
        return [F.pmod(part, F.lit(waves)) == i for i in range(waves)]

    def _count(self, spark) -> DataFrame:
        schema = spark.createDataFrame([], "lang string, source string, shard long, slot long, n long").schema
        arrow = _arrow(schema)
        out = spark.createDataFrame([], schema)
        for wave in self._waves():
            held: dict[str, tuple[int, dict]] = {}
            for r in self.shards.where(wave).join(self.sizes.select("lang", "shards"), "lang").collect():
                held.setdefault(r["lang"], (r["shards"], {}))[1][r["shard"]] = (r["seed"], r["displace"], [bytes(k) for k in r["keys"]])
            if held:
                sent = spark.sparkContext.broadcast(held)
                part = self.d.where(F.col("lang").isin(*held)).mapInArrow(lambda b, sent=sent: _recount(b, sent, arrow), schema)
                out = out.union(materialise(part.groupBy("lang", "source", "shard", "slot").agg(F.sum("n").alias("n"))))
                sent.unpersist()
        return out

    def terms(self) -> DataFrame:
        """``lang, shard, slot, term``: the stored key of every slot."""
        t = self.shards.select("lang", "shard", F.posexplode("keys").alias("slot", "key"))
        return t.select("lang", "shard", F.col("slot").cast("long").alias("slot"), F.col("key").cast("string").alias("term"))

    def shares(self) -> tuple[DataFrame, DataFrame]:
        """(counts with p, groups with N, V and p of a term that the group lacks)."""
        n = self.counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        g = (self.groups.join(n, ["lang", "source"], "left").join(self.sizes, "lang", "left")
             .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("shards", F.lit(0)).alias("shards")))
        g = materialise(g.withColumn("p0", F.when(F.col("v") > 0, _share(F.lit(0).cast("long"), F.col("total"), F.col("v")))))
        c = self.counts.join(g.select("lang", "source", "total", "v"), ["lang", "source"])
        return materialise(c.select("lang", "source", "shard", "slot", "n", _share(F.col("n"), F.col("total"), F.col("v")).alias("p"))), g


def pair_divergence(m: Recount, shares: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for every two sources of a language, both ways round.

    A task holds two blocks of about ``SOURCE_BLOCK`` sources over one shard's
    slots; its sums are added up over the shards. A language without kept
    terms has one empty shard, so that its pairs appear with value 0.
    """
    blocks = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / SOURCE_BLOCK).cast("long").alias("blocks"))
    g = groups.join(blocks, "lang").withColumn("block", F.pmod(F.xxhash64("source"), "blocks"))
    sizes = m.shards.select("lang", "shard", F.size("keys").cast("long").alias("slots"))
    heads = (g.join(sizes, "lang", "left").select("lang", "source", "block", "blocks", F.coalesce("shard", F.lit(0)).alias("shard"),
                                                   F.lit(-1).cast("long").alias("slot"), F.coalesce("slots", F.lit(0)).alias("n"), F.coalesce("p0", F.lit(1)).alias("p")))
    body = (shares.join(g.select("lang", "source", "block", "blocks"), ["lang", "source"])
            .select("lang", "source", "block", "blocks", "shard", "slot", "n", "p"))
    rows = heads.unionByName(body).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select("lang", "source", "block", "shard", "slot", "n", "p", F.least("block", "other").alias("block_a"), F.greatest("block", "other").alias("block_b"))
    sums = (rows.groupBy("lang", "shard", "block_a", "block_b").applyInPandas(_block_pairs, "lang string, a string, b string, value long")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return sums.select("lang", both.alias("x"), "value").select("lang", "x.source", "x.item", "value")


def term_divergence(m: Recount, shares: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """``lang, source, item, value, rank``: the terms that a group has most above its language, at most ``top`` a group."""
    world = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("v").alias("v"))
    q = shares.groupBy("lang", "shard", "slot").agg(F.sum("n").alias("n")).join(world, "lang")
    q = q.select("lang", "shard", "slot", _share(F.col("n"), F.col("total"), F.col("v")).alias("q"))
    keys = ["lang", "shard", "slot"]
    over = shares.join(q, keys).where(F.col("p") > F.col("q")).join(m.terms(), keys)
    over = over.select("lang", "source", F.col("term").alias("item"), _distance(F.col("p"), F.col("q")).alias("value"))
    return top_k_per_key(over, ["lang", "source"], [F.desc("value"), F.col("item")], top, rank_col="rank", salt_cols=["item"])


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """How sources of a language differ: ``lang, source, part, item, value, rank``.

    Part ``pair`` ranks all other sources of the language, part ``term`` the
    ``top`` terms that stand out of the language; value descending, then item
    by UTF-8 bytes. Null text, lang and source count as ''. A group without
    kept terms is compared like any other; a language with a single source has
    no pairs, one without kept terms has value 0 in all its pairs. Repeated
    rows are documents of their own; an empty table gives no rows; extra
    columns are ignored. All arithmetic is exact in integers.
    """
    m = Recount(docs, least_docs)
    shares, groups = m.shares()
    pairs = pair_divergence(m, shares, groups)
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    terms = term_divergence(m, shares, groups, top)
    part = lambda d, name: d.select("lang", "source", F.lit(name).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))
    return part(pairs, "pair").unionByName(part(terms, "term"))


def _arrow(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)
