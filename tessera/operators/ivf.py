"""Approximate nearest neighbours with an inverted file of coarse cells and part codes.

Unit vectors are assigned to the nearest of a set of k-means centroids and
carry a code of one byte per part (nearest codebook entry). A query probes the
nearest cells only; inside a cell all members are scored from their codes and
a shortlist is compared exactly. Centroids, codebooks and the number of cells
to probe come from a bounded sample; every row is indexed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import md5_order
from tessera.operators.similarity import top_k_neighbours
from tessera.session import cut_lineage

#: Rows the index is fitted on (the first by md5 of their id), and the most cells.
SAMPLE = 20_000
MOST_CELLS = 4096
PARTS, ENTRIES, ROUNDS = 16, 64, 10
#: Rows of a cell that one task scores; the share of the table that a query compares exactly at most.
BLOCK_ROWS = 4096
RERANK = 0.15
#: Share of the true neighbours of sample rows that must lie in the probed cells.
TARGET = 0.97


def _unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, n, out=np.zeros_like(x), where=n > 0)


def _lloyd(x: np.ndarray, k: int, spherical: bool) -> np.ndarray:
    """k-means centres of ``x``, started from its first k rows."""
    c = x[:k].copy()
    for _ in range(ROUNDS):
        near = (x @ c.T - (0 if spherical else (c ** 2).sum(1) / 2)).argmax(1)
        n = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
        c = _unit(c) if spherical else c
    return c


@dataclass
class Index:
    """What tasks need of a fitted index; bounded by the sample's parameters, not by the table."""

    centres: np.ndarray  # (cells, dim)
    books: list          # per part (entries, width)
    probes: int

    @classmethod
    def fit(cls, sample: np.ndarray, rows: int, k: int) -> "Index":
        """``sample``: unit vectors in random order; ``rows``: size of the whole table; ``k``: neighbours asked for."""
        cells = int(min(MOST_CELLS, max(1, np.sqrt(rows) / 2), max(1, len(sample) // 8)))
        centres = _lloyd(sample, cells, spherical=True)
        books = [_lloyd(part, min(ENTRIES, len(part)), spherical=False) for part in np.array_split(sample, min(PARTS, sample.shape[1]), axis=1)]
        # fewest cells (in steps of a quarter more) that hold the true neighbours of some sample rows
        asked = sample[:256]
        sims = asked @ sample.T
        sims[np.arange(len(asked)), np.arange(len(asked))] = -2
        true = np.argsort(-sims, axis=1)[:, :k]
        home = (sample @ centres.T).argmax(1)
        place = np.empty((len(asked), cells), int)
        np.put_along_axis(place, np.argsort(-(asked @ centres.T), axis=1), np.arange(cells)[None, :], axis=1)
        rank = np.take_along_axis(place, home[true], axis=1)
        probes = 1
        while probes < cells and (rank < probes).mean() < TARGET:
            probes = min(cells, max(probes + 1, int(probes * 1.25)))
        return cls(centres, books, probes)

    def codes(self, x: np.ndarray) -> np.ndarray:
        parts = np.array_split(x, len(self.books), axis=1)
        return np.stack([(p @ b.T - (b ** 2).sum(1) / 2).argmax(1) for p, b in zip(parts, self.books)], axis=1).astype(np.uint8)

    def scores(self, q: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """(queries, rows): dot products of the queries with what the codes stand for."""
        out = np.zeros((len(q), len(codes)), np.float32)
        for j, (p, b) in enumerate(zip(np.array_split(q, len(self.books), axis=1), self.books)):
            out += (p @ b.T).astype(np.float32)[:, codes[:, j]]
        return out


def _vectors(col: pd.Series) -> np.ndarray:
    return _unit(np.stack(col.to_numpy()).astype(np.float64))


def build(vecs: DataFrame, k: int, id_col: str = "id", vec: str = "embedding") -> tuple[Index, DataFrame]:
    """Fitted index and the table ``(cell, block, id, v, code)`` of every row with a non-zero, finite vector."""
    ok = (F.col(vec).isNotNull() & (F.size(vec) > 0) & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
          & F.exists(vec, lambda x: x != 0))
    v = vecs.filter(ok).select(F.col(id_col).cast("long").alias("id"), F.col(vec).alias("v"))
    rows = v.count()
    first = v.orderBy(md5_order("ivf", "id"), "id").limit(SAMPLE).toPandas()
    if not rows:
        return Index(np.zeros((0, 0)), [], 0), cut_lineage(v.selectExpr("0 AS cell", "0L AS block", "id", "v", "X'' AS code"))
    index = Index.fit(_vectors(first["v"]), rows, k)

    def assign(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            x = _vectors(pdf["v"])
            yield pd.DataFrame({"cell": (x @ index.centres.T).argmax(1).astype("int32"), "id": pdf["id"], "v": pdf["v"], "code": [c.tobytes() for c in index.codes(x)]})

    element = v.schema["v"].dataType.simpleString()
    placed = cut_lineage(v.mapInPandas(assign, f"cell int, id long, v {element}, code binary"))
    # a large cell is dealt over blocks, so no task holds more than about BLOCK_ROWS of it
    blocks = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("long").alias("blocks"))
    table = placed.join(blocks, "cell").withColumn("block", F.pmod(F.xxhash64("id"), "blocks"))
    return index, cut_lineage(table.select("cell", "block", "id", "v", "code"))


def search(index: Index, table: DataFrame, queries: DataFrame, k: int, q_id: str = "id", q_vec: str = "embedding", tie_digits: int = 9) -> tuple[DataFrame, DataFrame]:
    """``(a, b, sim, rank)`` of the k nearest found for each query (a row with the query's id removed), and
    ``(a, scored, compared)``: rows scored from codes and compared exactly per query."""
    q = queries.select(F.col(q_id).cast("long").alias("id"), F.col(q_vec).alias("v"))
    element = q.schema["v"].dataType.simpleString()

    def probe(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            if len(pdf) and index.probes:
                near = np.argsort(-(_vectors(pdf["v"]) @ index.centres.T), axis=1, kind="stable")[:, :index.probes]
                at = np.repeat(np.arange(len(pdf)), index.probes)
                yield pd.DataFrame({"cell": near.ravel().astype("int32"), "id": pdf["id"].to_numpy()[at], "v": pdf["v"].to_numpy()[at]})

    # the fewer cells a query probes, the more of each it may compare
    share = min(1.0, RERANK * len(index.centres) / max(1, index.probes))

    def best(key, asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({c: pd.Series([], dtype=t) for c, t in (("a", "int64"), ("b", "int64"), ("sim", "float64"), ("scored", "int64"), ("compared", "int64"))})
        if asked.empty or held.empty:
            return none
        x, ids = _vectors(held["v"]), held["id"].to_numpy()
        code = np.frombuffer(b"".join(held["code"]), np.uint8).reshape(len(held), -1)
        short = min(len(held), max(k + 1, int(np.ceil(share * len(held)))))
        out = []
        for at in range(0, len(asked), 256):
            qid, qv = asked["id"].to_numpy()[at:at + 256], _vectors(asked["v"].iloc[at:at + 256])
            rough = index.scores(qv, code)
            lists = np.argpartition(-rough, short - 1, axis=1)[:, :short]
            exact = np.einsum("qd,qsd->qs", qv, x[lists])
            exact[ids[lists] == qid[:, None]] = -np.inf
            order = np.lexsort((ids[lists], -np.round(exact, tie_digits)), axis=1)[:, :k]
            sim = np.take_along_axis(exact, order, axis=1)
            b = np.take_along_axis(ids[lists], order, axis=1)
            live = np.isfinite(sim)
            live[:, 0] = True  # each query keeps a row for its counts
            a = np.broadcast_to(qid[:, None], sim.shape)
            first = np.zeros(sim.shape, bool)
            first[:, 0] = True
            out.append(pd.DataFrame({"a": a[live], "b": b[live], "sim": sim[live], "scored": np.where(first, len(held), 0)[live], "compared": np.where(first, short, 0)[live]}))
        return pd.concat(out)

    blocks = table.select("cell", "block").distinct().toDF("at", "part")
    asked = q.mapInPandas(probe, f"cell int, id long, v {element}").join(blocks, F.col("cell") == F.col("at")).select("at", "part", "id", "v")
    found = cut_lineage(asked.groupBy("at", "part").cogroup(table.groupBy("cell", "block"))
                        .applyInPandas(best, "a long, b long, sim double, scored long, compared long"))
    work = found.groupBy("a").agg(F.sum("scored").alias("scored"), F.sum("compared").alias("compared"))
    return top_k_neighbours(found.filter("sim > double('-infinity')").select("a", "b", "sim"), k, tie_digits=tie_digits), work
