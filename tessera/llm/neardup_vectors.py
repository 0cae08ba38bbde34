"""Embedding near-dedup by randomised-rotation binary codes (operator 1).

Unit vectors are rotated by one random orthogonal matrix. Each keeps a binary
code (the signs of its rotated coordinates), the correction factor
``c = <code vector, vector>`` and a 4-bit quantised copy of its coordinates.
``<code_a, b> / c_a`` is an unbiased estimate of ``<a, b>``: the part of the
code vector that is orthogonal to ``a`` adds an error whose mean is zero over
rotations and whose size is at most ``sqrt(1 - c_a^2) * sqrt(1 - <a, b>^2)``
(plus the stored quantisation error of ``b``). A pair whose estimate plus this
bound stays below the threshold is dropped for certain; only the others are
computed anew in double precision. The bound holds always, not just with high
probability, so no pair at or above the threshold is lost.

Candidates come from the codes themselves. Vectors with cosine >= t lie within
``R^2 = 2 - 2t``; cut into blocks of rotated coordinates, one block holds at
most ``R^2 / blocks`` of it. There a coordinate whose sign differs moved by
``|a_i| + |b_i|``, so one of the two vectors reaches the other's block code by
flipping coordinates whose squares sum to at most ``R^2 / (2 blocks)``: each
vector is stored under its own block codes and looked up under all such
flipped ones. This too loses no pair. Wide blocks have more flipped codes, narrow
ones more vectors under each code: the width is chosen from the size of the
largest label (``block_width``), so that work per vector grows far slower than
the label.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import components, materialise, pick

THRESHOLD = 0.98
ROTATION_SEED = 20240521
#: Block widths that are weighed up.
WIDTHS = (16, 20, 24, 28, 32)
#: Room for floating-point rounding in bounds (cosines are exact to about 1e-15).
SLACK = 1e-9

_CODES = "cls string, label string, dim int, block int, key long, home boolean, code binary, c double, planes binary, lo double, step double, err double"


_ROTATIONS: dict[tuple[int, int], np.ndarray] = {}


def rotation(dim: int, seed: int = ROTATION_SEED) -> np.ndarray:
    """Random orthogonal matrix (Q of a Gaussian matrix, column signs fixed), made once per process."""
    if (dim, seed) not in _ROTATIONS:
        q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
        _ROTATIONS[dim, seed] = q * np.sign(np.diag(r))
    return _ROTATIONS[dim, seed]


def padded(dim: int, width: int) -> int:
    """Least multiple of the width that holds ``dim`` coordinates, a multiple of 8 too (codes are bytes)."""
    return -(-dim // math.lcm(width, 8)) * math.lcm(width, 8) if width % 8 else -(-dim // width) * width


def reach(dim: int, width: int, threshold: float) -> float:
    """Sum of squares that flipped coordinates of one block may have."""
    return (2 - 2 * threshold) / (2 * (padded(dim, width) // width)) * (1 + 1e-6) + SLACK


def block_width(dim: int, rows: int, threshold: float) -> int:
    """The width with the least work for ``rows`` vectors of a label: flipped codes per vector, each of which meets
    rows / 2^width vectors. The number of codes is measured on a few random directions of that dimension."""
    x = np.random.default_rng(1).standard_normal((32, dim))
    work = {}
    for w in WIDTHS:
        if w <= dim or w == WIDTHS[0]:
            codes = len(lookups(encode(x, w)["v"], reach(dim, w, threshold), w)[0]) / len(x)
            work[w] = codes * (1 + rows / 2.0 ** w)
            if codes > 1e5:
                break
    return min(work, key=work.get)


def encode(x: np.ndarray, width: int = 16) -> dict[str, np.ndarray]:
    """Codes and correction factors of vectors (rows of ``x``, none zero), after normalising and rotating."""
    n, dim = x.shape
    d = padded(dim, width)
    unit = np.zeros((n, d))
    unit[:, :dim] = x / np.abs(x).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    v = unit @ rotation(d)
    bits = v >= 0
    lo, hi = v.min(axis=1), v.max(axis=1)
    step = np.where(hi > lo, (hi - lo) / 15.0, 1.0)
    u = np.clip(np.rint((v - lo[:, None]) / step[:, None]), 0, 15).astype(np.uint8)
    err = np.linalg.norm(v - (lo[:, None] + step[:, None] * u), axis=1)
    return {"v": v, "bits": bits, "code": np.packbits(bits, axis=1), "c": np.abs(v).sum(axis=1) / np.sqrt(d), "u": u,
            "planes": np.concatenate([np.packbits((u >> j & 1).astype(bool), axis=1) for j in range(4)], axis=1), "lo": lo, "step": step, "err": err}


def estimate_bound(code, c, planes, lo, step, err, threshold: float):
    """Estimate of <a, b> from a's code and b's quantised copy, and the half-width that holds for pairs >= threshold."""
    nbytes = code.shape[1]
    d = nbytes * 8
    ones = np.bitwise_count(code).sum(axis=1, dtype=np.int64)
    dot_u, sum_u = np.zeros(len(code)), np.zeros(len(code))
    for j in range(4):
        p = planes[:, j * nbytes:(j + 1) * nbytes]
        all_p = np.bitwise_count(p).sum(axis=1, dtype=np.int64)
        dot_u += (2.0 * np.bitwise_count(code & p).sum(axis=1, dtype=np.int64) - all_p) * (1 << j)
        sum_u += all_p * (1 << j)
    raw = (lo * (2.0 * ones - d) + step * dot_u) / np.sqrt(d)
    width = (np.sqrt(np.clip(1 - c * c, 0, None)) * np.sqrt(max(0.0, 1 - threshold * threshold)) + err) / c
    return raw / c, width


def lookups(v: np.ndarray, limit: float, width: int = 16):
    """All block codes under which each vector is looked up: (row, block, key, is its own code)."""
    n, d = v.shape
    rows, blocks, keys, own = [], [], [], []
    weight = 1 << np.arange(width)
    for b in range(d // width):
        part = v[:, b * width:(b + 1) * width]
        key, sq = (part >= 0) @ weight, part * part
        row, total = np.arange(n), np.zeros(n)
        first = np.ones(n, dtype=bool)
        for k in range(width):
            more = total + sq[row, k]
            take = more <= limit
            row, total, key, first = (np.concatenate([row, row[take]]), np.concatenate([total, more[take]]),
                                      np.concatenate([key, key[take] ^ weight[k]]), np.concatenate([first, np.zeros(take.sum(), dtype=bool)]))
        rows.append(row), keys.append(key), own.append(first), blocks.append(np.full(len(row), b))
    return tuple(np.concatenate(x) for x in (rows, blocks, keys, own))


def _code_rows(parts: Iterator[pd.DataFrame], threshold: float, widths: dict[int, int]) -> Iterator[pd.DataFrame]:
    for pdf in parts:
        for dim, same in pdf.groupby("dim", sort=False):
            width = widths[int(dim)]
            step = 1024 if width <= 16 else 64
            for s in range(0, len(same), step):
                some = same.iloc[s:s + step]
                e = encode(np.stack(some["vec"].to_numpy()).astype(np.float64), width)
                row, block, key, home = lookups(e["v"], reach(int(dim), width, threshold), width)
                cls, label = some["cls"].to_numpy(), some["label"].to_numpy()
                code = np.array([x.tobytes() for x in e["code"]], dtype=object)
                planes = np.array([x.tobytes() for x in e["planes"]], dtype=object)
                yield pd.DataFrame({"cls": cls[row], "label": label[row], "dim": int(dim), "block": block, "key": key, "home": home,
                                    "code": code[row], "c": e["c"][row], "planes": np.where(home, planes[row], None),
                                    "lo": e["lo"][row], "step": e["step"][row], "err": e["err"][row]})


def _needs_exact(parts: Iterator[pd.DataFrame], threshold: float) -> Iterator[pd.DataFrame]:
    for pdf in parts:
        for _, same in pdf.groupby(pdf["code"].str.len(), sort=False):
            mat = lambda col: np.frombuffer(b"".join(same[col]), dtype=np.uint8).reshape(len(same), -1)  # noqa: B023,E731
            est, width = estimate_bound(mat("code"), same["c"].to_numpy(), mat("planes"), *(same[x].to_numpy() for x in ("lo", "step", "err")), threshold)
            keep = same[est + width >= threshold - SLACK]
            a, b = keep["cls"].to_numpy(), keep["other"].to_numpy()
            low = a < b
            yield pd.DataFrame({"a": np.where(low, a, b), "b": np.where(low, b, a)})


def vector_links(vectors: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members, classes and linked class pairs of ``vectors`` (vec_id, embedding, label).

    Members: vec_id and its class (null if the vector or its label can't
    link); classes (cls, n, low, vec): equal vectors of one label; pairs
    (a, b): different classes with cosine >= threshold.
    """
    v = pick(vectors, "vec_id", "embedding", "label").select("vec_id", F.col("label").cast("string").alias("label"), F.col("embedding").alias("e"))
    x = F.transform("e", lambda t: t.cast("double"))
    finite = F.forall(x, lambda t: t.isNotNull() & ~F.isnan(t) & (F.abs(t) != float("inf")))
    fit = F.col("label").isNotNull() & F.col("e").isNotNull() & finite & F.exists(x, lambda t: t != 0)
    cls = F.concat(F.hex(F.xxhash64(F.lit(1), "label", x)), F.lit("-"), F.hex(F.xxhash64(F.lit(2), x, "label")))
    members = materialise(v.select("vec_id", F.when(F.coalesce(fit, F.lit(False)), cls).alias("cls"), "label", F.when(fit, x).alias("vec")))
    classes = materialise(members.where("cls is not null").groupBy("cls").agg(
        F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("low"), F.any_value("label").alias("label"), F.any_value("vec").alias("vec")))
    # one row per length of vector: the most classes that a label has of it
    most = classes.groupBy("label", F.size("vec").alias("dim")).count().groupBy("dim").agg(F.max("count").alias("most")).collect()
    widths = {r["dim"]: block_width(r["dim"], r["most"], threshold) for r in most}
    codes = materialise(classes.select("cls", "label", F.size("vec").alias("dim"), "vec")
                        .mapInPandas(lambda parts: _code_rows(parts, threshold, widths), _CODES))
    place = ["label", "dim", "block", "key"]
    homes = codes.where("home").select(*place, F.col("cls").alias("other"), "planes", "lo", "step", "err")
    looks = codes.select(*place, "cls", "code", "c")
    found = (looks.join(homes, place).where(F.col("cls") != F.col("other")).select("cls", "other", "code", "c", "planes", "lo", "step", "err")
             .mapInPandas(lambda parts: _needs_exact(parts, threshold), "a string, b string").distinct())
    norm = lambda t: F.sqrt(F.aggregate(t, F.lit(0.0), lambda s, y: s + y * y))
    # scaled by the largest component, so that huge or tiny vectors neither overflow nor vanish
    vec = classes.select("cls", F.transform("vec", lambda y: y / F.array_max(F.transform("vec", F.abs))).alias("vec"))
    vec = materialise(vec.select("cls", "vec", norm(F.col("vec")).alias("norm")))
    pairs = (found.join(vec.toDF("a", "va", "na"), "a").join(vec.toDF("b", "vb", "nb"), "b")
             .withColumn("dot", F.aggregate(F.zip_with("va", "vb", lambda p, q: p * q), F.lit(0.0), lambda s, y: s + y))
             .where(F.col("dot") / (F.col("na") * F.col("nb")) >= F.lit(threshold)).select("a", "b"))
    return members.select("vec_id", "cls"), classes.select("cls", "n", "low"), materialise(pairs)


def near_duplicate_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors link when their labels are equal and not null and their cosine is
    at least ``threshold``. Equal vectors are compared once, as a class, and
    counted by their number. Vectors that are null, empty, zero, or hold null
    or non-finite components link with nothing: 0 links, a component of their
    own. Vectors of different length don't link. Null vec_ids count as
    vectors but never name a component (kept is false for them); repeated
    rows are vectors of their own that link with each other. An empty table
    gives an empty result; extra columns are ignored.
    """
    members, classes, pairs = vector_links(vectors, threshold)
    both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    size = classes.select(F.col("cls").alias("b"), "n")
    far = both.join(size, "b").groupBy("a").agg(F.sum("n").alias("far")).withColumnRenamed("a", "cls")
    comp = components(pairs).withColumnRenamed("node", "cls")
    named = classes.join(comp, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    low = named.groupBy("root").agg(F.min("low").alias("component_id"))
    table = materialise(named.join(far, "cls", "left").join(low, "root")
                        .select("cls", (F.col("n") - 1 + F.coalesce("far", F.lit(0))).alias("n_links"), "component_id"))
    alone = members.where("cls is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = members.where("cls is not null").join(table, "cls").select("vec_id", "n_links", "component_id").union(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
