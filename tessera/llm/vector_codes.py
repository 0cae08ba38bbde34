"""Vector code compression over Hilbert-sorted flat blocks (operator 12).

A vector is cut into equal parts; each part position has a small codebook of
integer entries, fitted by a fixed number of exact k-means rounds. Within a
chunk of vectors the parts of one position are sorted along a Hilbert curve
and cut into flat blocks that store their componentwise minimum, maximum and
sum. In each round the distances between entries and a block's box leave a
shortlist: an entry whose least possible distance is above another entry's
greatest possible one cannot win anywhere in the block. A block with one
entry left adds its stored sum; the others compare their points with the
shortlist in small integer kernels. All arithmetic is exact in 64 bits, so
neither chunks, partitions nor retries change a result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise, pick

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Vectors of one chunk (sorted together, in memory together) and points of one block.
CHUNK = 32768
BLOCK = 16
#: Components beyond this have no exact 64-bit distances for parts of up to 1,024 components.
LIMIT = 1 << 25
_KERNEL_CELLS = 1 << 21


def hilbert_keys(points: np.ndarray) -> np.ndarray:
    """Position of each integer point (rows) on a Hilbert curve through its box; close keys are close points.

    Coordinates are scaled to as many bits as fit 62 bits in all; columns past
    the 62nd are left out (the order serves pruning only, never results).
    """
    x = points[:, :62].astype(np.int64)
    n, d = x.shape
    if not n or not d:
        return np.zeros(n, np.int64)
    bits = max(1, min(16, 62 // d))
    x = x - x.min(axis=0)
    for _ in range(64):  # halve until the widest column fits
        if x.max() < 1 << bits:
            break
        x >>= 1
    # reflect and exchange axes from the highest bit down, so that consecutive cells share a face
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for i in range(d):
            on = (x[:, i] & level) != 0
            swap = np.where(on, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(on, low, swap)
            x[:, i] ^= np.where(i == 0, 0, swap)
        level >>= 1
    for i in range(1, d):
        x[:, i] ^= x[:, i - 1]
    flip, level = np.zeros(n, np.int64), 1 << (bits - 1)
    while level > 1:
        flip ^= np.where(x[:, d - 1] & level, level - 1, 0)
        level >>= 1
    x ^= flip[:, None]
    key = np.zeros(n, np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


class Block:
    """The blocks of one part position in one chunk: points in Hilbert order, boxes and sums."""

    def __init__(self, points: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, total: np.ndarray):
        self.points, self.order, self.low, self.high, self.total = points, order, low, high, total
        self.count = np.diff(np.append(np.arange(0, len(points), BLOCK), len(points)))

    @classmethod
    def of(cls, points: np.ndarray) -> "Block":
        order = np.argsort(hilbert_keys(points), kind="stable")
        p = points[order]
        at = np.arange(0, len(p), BLOCK)
        return cls(p, order, np.minimum.reduceat(p, at), np.maximum.reduceat(p, at), np.add.reduceat(p, at))

    def shortlists(self, entries: np.ndarray) -> np.ndarray:
        """Boolean (block, entry): entries that may be nearest to some point of the block (never empty)."""
        near, far = np.zeros((len(self.low), len(entries)), np.int64), np.zeros((len(self.low), len(entries)), np.int64)
        for j in range(entries.shape[1]):
            under, over = self.low[:, j, None] - entries[None, :, j], entries[None, :, j] - self.high[:, j, None]
            near += np.maximum(np.maximum(under, over), 0) ** 2
            far += np.maximum(np.abs(entries[None, :, j] - self.low[:, j, None]), np.abs(over)) ** 2
        return near <= far.min(axis=1, keepdims=True)

    def _kernel(self, blocks: np.ndarray, short: np.ndarray, entries: np.ndarray, best: np.ndarray, error: np.ndarray) -> None:
        """Nearest shortlisted entry of every point of ``blocks`` (whose shortlists are about equally long)."""
        width = int(short[blocks].sum(axis=1).max())
        # entries of a shortlist ascending, then the others: these are masked out
        lists = np.argsort(~short[blocks], axis=1, kind="stable")[:, :width]
        masked = ~np.take_along_axis(short[blocks], lists, axis=1)
        rows = np.minimum(blocks[:, None] * BLOCK + np.arange(BLOCK), len(self.points) - 1)
        dist = np.zeros((len(blocks), BLOCK, width), np.int64)
        for j in range(entries.shape[1]):
            dist += (self.points[rows, j][:, :, None] - entries[lists, j][:, None, :]) ** 2
        dist = np.where(masked[:, None, :], np.iinfo(np.int64).max, dist)
        pick_ = dist.argmin(axis=2)
        best[rows] = np.take_along_axis(lists, pick_, axis=1)
        error[rows] = np.take_along_axis(dist, pick_[:, :, None], axis=2)[:, :, 0]

    def _each_kernel(self, which: np.ndarray, short: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        best, error = np.full(len(self.points), -1, np.int64), np.zeros(len(self.points), np.int64)
        length = short.sum(axis=1)
        width = 1
        while width < 2 * len(entries):
            now = which[(length[which] > width // 2) & (length[which] <= width)]
            step = max(1, _KERNEL_CELLS // (BLOCK * width))
            for a in range(0, len(now), step):
                self._kernel(now[a:a + step], short, entries, best, error)
            width *= 2
        return best, error

    def sums(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Points and componentwise sums that each entry takes."""
        short = self.shortlists(entries)
        single = short.sum(axis=1) == 1
        n, total = np.zeros(len(entries), np.int64), np.zeros(entries.shape, np.int64)
        whole = short[single].argmax(axis=1)
        np.add.at(n, whole, self.count[single])
        np.add.at(total, whole, self.total[single])
        best, _ = self._each_kernel(np.flatnonzero(~single), short, entries)
        some = best >= 0
        np.add.at(n, best[some], 1)
        np.add.at(total, best[some], self.points[some])
        return n, total

    def codes(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry and squared distance of every point, in the chunk's own row order."""
        best, error = self._each_kernel(np.arange(len(self.low)), self.shortlists(entries), entries)
        code, err = np.empty_like(best), np.empty_like(error)
        code[self.order], err[self.order] = best, error
        return code, err


def _packed(x: np.ndarray) -> bytes:
    """Integers in the narrowest type that holds them, with that type's size in front."""
    for t in (np.int16, np.int32, np.int64):
        if t is np.int64 or not x.size or (x.min() >= np.iinfo(t).min and x.max() <= np.iinfo(t).max):
            return bytes([np.dtype(t).itemsize]) + np.ascontiguousarray(x, dtype=t).tobytes()
    return b""


def _unpacked(b: bytes) -> np.ndarray:
    return np.frombuffer(b, dtype=f"i{b[0]}", offset=1).astype(np.int64)


def _pack_chunks(batches: Iterator[pa.RecordBatch], schema: pa.Schema, parts: int) -> Iterator[pa.RecordBatch]:
    """Chunks of rows (id, label, x) -> one record per chunk with the blocks of all part positions."""
    def chunk(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        v = t["x"].combine_chunks()
        ints = v.flatten().to_numpy(zero_copy_only=False).reshape(len(t), -1)
        d = ints.shape[1] // parts
        blocks = [Block.of(ints[:, p * d:(p + 1) * d]) for p in range(parts)]
        fields = [[_packed(getattr(b, f)) for b in blocks] for f in ("points", "order", "low", "high", "total")]
        ids, labels = ([c] for c in (t["id"].to_pylist(), t["label"].to_pylist()))
        return pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip([ids, labels, *[[f] for f in fields]], schema)], schema=schema)

    held, n = [], 0
    for b in batches:
        while b.num_rows:
            part = b.slice(0, CHUNK - n)
            held.append(part)
            n += part.num_rows
            b = b.slice(part.num_rows)
            if n == CHUNK:
                yield chunk(pa.Table.from_batches(held))
                held, n = [], 0
    if n:
        yield chunk(pa.Table.from_batches(held))


def _blocks_of(row: dict, dim: int) -> list[Block]:
    shape = lambda b: _unpacked(b).reshape(-1, dim)
    return [Block(shape(p), _unpacked(o), shape(lo), shape(hi), shape(s))
            for p, o, lo, hi, s in zip(*(row[f] for f in ("points", "sorted", "low", "high", "total")))]


def _partial_sums(batches: Iterator[pa.RecordBatch], books: list, schema: pa.Schema, dim: int) -> Iterator[pa.RecordBatch]:
    """One row per part position and entry with what this task's chunks give it."""
    n = [np.zeros(len(b), np.int64) for b in books]
    total = [np.zeros(b.shape, np.int64) for b in books]
    for batch in batches:
        for i in range(batch.num_rows):
            for p, block in enumerate(_blocks_of(batch.slice(i, 1).to_pylist()[0], dim)):
                c, s = block.sums(books[p])
                n[p] += c
                total[p] += s
    rows = [(p, e, int(n[p][e]), *total[p][e].tolist()) for p in range(len(books)) for e in range(len(books[p])) if n[p][e]]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _final_codes(batches: Iterator[pa.RecordBatch], books: list, schema: pa.Schema, dim: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            found = [b.codes(books[p]) for p, b in enumerate(_blocks_of(row, dim))]
            code = np.stack([c for c, _ in found], axis=1).astype(np.uint8)
            error = np.sum([e for _, e in found], axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(
                [row["ids"], row["labels"], [c.tobytes() for c in code], error], schema)], schema=schema)


def _kept(vectors: DataFrame, parts: int, scale: int) -> DataFrame:
    """``id, label, x``: integer components of the usable vectors."""
    v = pick(vectors, id="vec_id", label="label", e="embedding")
    bad = F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    v = v.where(F.col("e").isNotNull() & (F.size("e") > 0) & (F.size("e") % parts == 0) & ~bad)
    big = F.exists("e", lambda x: F.abs(x.cast("double") * scale) >= LIMIT)
    x = F.when(big, F.raise_error(F.lit(f"a component's integer must be below {LIMIT}"))).otherwise(F.transform("e", lambda x: F.floor(x.cast("double") * scale)))
    return v.select("id", "label", x.alias("x"))


def _smallest(x: DataFrame, n: int) -> list:
    return [r["x"] for r in x.orderBy(F.col("id").asc_nulls_last(), "x").limit(n).collect()]


class Codebooks:
    """Fitted codebooks (``books``: one integer array (entry, component) per part position) and the block table they came from.

    The driver holds the seed vectors, the codebooks and one row per part
    position and entry of each round: all bounded by entries x vector length.
    """

    def __init__(self, vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE):
        if entries > 256:
            raise ValueError("codes have one byte a part: at most 256 entries")
        x = _kept(vectors, parts, scale)
        self.spark, self.types = vectors.sparkSession, dict(x.dtypes)
        seeds = _smallest(x, entries)
        if seeds:  # one length for all; only if the smallest ids differ in length must they be looked up again
            x = x.where(F.size("x") == len(seeds[0]))
            seeds = seeds if len({len(s) for s in seeds}) == 1 else _smallest(x, entries)
        self.dim = len(seeds[0]) // parts if seeds else 0
        self.books = [np.array([s[p * self.dim:(p + 1) * self.dim] for s in seeds], np.int64) for p in range(parts)]
        out = self.spark.createDataFrame([], f"ids array<{self.types['id']}>, labels array<{self.types['label']}>, points array<binary>, sorted array<binary>, "
                                             "low array<binary>, high array<binary>, total array<binary>")
        schema = out.schema
        arrow = _arrow(schema)
        self.blocks = materialise(x.mapInArrow(lambda b: _pack_chunks(b, arrow, parts), schema))
        for _ in range(rounds if seeds else 0):
            self._round()

    def _round(self) -> None:
        books, dim = self.books, self.dim
        cols = [f"s{j}" for j in range(dim)]
        schema = self.spark.createDataFrame([], ", ".join(["part int", "entry int", "n long", *[f"{c} long" for c in cols]])).schema
        arrow = _arrow(schema)
        got = (self.blocks.mapInArrow(lambda b: _partial_sums(b, books, arrow, dim), schema)
               .groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in cols]).collect())
        new = [b.copy() for b in books]
        for r in got:
            new[r["part"]][r["entry"]] = [r[c] // r["n"] for c in cols]  # // goes down for negative sums too
        self.books = new

    def sha256(self) -> str:
        """Digest of all components in order of part, entry and position, as decimal numbers joined by commas."""
        return hashlib.sha256(",".join(str(x) for b in self.books for x in b.ravel().tolist()).encode()).hexdigest()

    def encoded(self) -> DataFrame:
        """``vec_id, label, code, error``: code is binary, one byte per part position."""
        books, dim = self.books, self.dim
        schema = self.spark.createDataFrame([], f"vec_id {self.types['id']}, label {self.types['label']}, code binary, error long").schema
        arrow = _arrow(schema)
        return self.blocks.mapInArrow(lambda b: _final_codes(b, books, arrow, dim), schema)

    def decoded(self, code: Column) -> Column:
        """The vector of integers that a code stands for."""
        at = lambda p: F.conv(F.hex(F.substring(code, p + 1, 1)), 16, 10).cast("int")
        book = lambda b: F.array(*[F.array(*[F.lit(int(v)) for v in e]) for e in b])
        return F.flatten(F.array(*[F.get(book(b), at(p)) for p, b in enumerate(self.books)]))


def _arrow(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """One row per usable vector: ``vec_id, label, code, error, label_error, codebooks_sha256`` (code: lower-case hex, two digits a part).

    Vectors that are null, empty, or hold null or non-finite components are
    dropped, and so are those whose length is no multiple of ``parts`` or
    differs from that of the usable vector with the smallest vec_id. Null
    vec_ids and labels are kept (null ids sort last among the seeds; null
    labels are one label). Repeated rows and ids count and come out once per
    row; seeds with equal ids go by their components. With fewer rows than
    ``entries`` the codebooks have one entry a row; an empty table gives no
    rows. Components must stay below 2^25 after scaling, else the job fails
    with a clear error (distances would leave 64 bits). Extra columns are
    ignored.

    Each label's sum is joined back as a table; Spark broadcasts it only if
    small, and adaptive execution splits a hot label otherwise.
    """
    m = Codebooks(vectors, parts, entries, rounds, scale)
    coded = materialise(m.encoded())
    per = materialise(coded.groupBy("label").agg(F.sum("error").alias("label_error"))).withColumnRenamed("label", "of")
    out = coded.join(per, F.col("label").eqNullSafe(F.col("of")))
    return out.select("vec_id", "label", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(m.sha256()).alias("codebooks_sha256"))
