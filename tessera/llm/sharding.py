"""Sharding by K-d tree partitioning (operator 8)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.skew import running_in_group
from tessera.llm.common import Wide, materialise

SHARDS = 40
#: A group of equal texts above this share of a shard is placed by itself, before the tree is cut.
LARGE_GROUP = 0.01
#: Cells of each histogram that looks for a weighted median, and the share of a shard a cut may miss it by.
CELLS = 1024
MISS = 0.0005
_TOP = (1 << 31) - 1


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 16."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long")


def text_crc(text: Column) -> Column:
    """CRC-32 of the text's UTF-8 bytes, unsigned (null as the empty text)."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("long")


DIMENSIONS = ("d_size", "d_source", "d_lang", "d_text")


def dimensions(w: Wide) -> dict[str, Column]:
    """The metadata dimensions, each an integer in [0, 2^31): text size on a log scale, source, language, content hash."""
    spread = lambda c: F.shiftrightunsigned(F.xxhash64(F.coalesce(c.cast("string"), F.lit(""))), 33)
    size = F.least(F.lit(_TOP), F.floor(F.log2(record_size(w.col("text")).cast("double")) / 40.0 * _TOP)).cast("long")
    return dict(zip(DIMENSIONS, (size, spread(w.col("source")), spread(w.col("lang")), F.shiftright(text_crc(w.col("text")), 1))))


def _tree(cuts: dict, node: int = 1) -> Column:
    """The tree as one nested expression: the node in which a row ends."""
    if node not in cuts:
        return F.lit(node)
    dim, at = cuts[node]
    return F.when(F.col(dim) <= F.lit(at), _tree(cuts, 2 * node)).otherwise(_tree(cuts, 2 * node + 1))


def _cell(s: dict) -> int:
    """Width of a histogram cell of an open node."""
    return max(1, -(-(s["hi"] - s["lo"] + 1) // CELLS))


def grow_tree(points: DataFrame, dims: list[str], room: list[float]) -> tuple[dict, dict]:
    """Cuts of the K-d tree whose leaves receive the bytes in ``room``, in order.

    ``points`` holds ``size`` and a 63-bit long per dimension. Level by level,
    every node is cut along the dimension in which its points spread widest,
    at the weighted quantile that parts the room of its left leaves from that
    of its right ones. The cut comes from histograms of the open nodes (at
    most leaves x CELLS sums go to the driver), refined inside one cell until
    it is met within MISS of a shard. Returns ({node: (dimension, cut)},
    {leaf node: shard}).
    """
    spans, cuts, leaf = {1: (0, len(room))}, {}, {}
    target = sum(room) / max(1, len(room))
    while True:
        leaf.update({n: a for n, (a, b) in spans.items() if b - a == 1})
        spans = {n: s for n, s in spans.items() if s[1] - s[0] > 1}
        if not spans:
            return cuts, leaf
        at = points.withColumn("node", _tree(cuts)).where(F.col("node").isin(*spans))
        stats = {r["node"]: r for r in at.groupBy("node").agg(
            F.sum("size").alias("bytes"), *[f(d).alias(f"{k}_{d}") for d in dims for k, f in (("lo", F.min), ("hi", F.max))]).collect()}
        search = {}
        for n, (a, b) in spans.items():
            r = stats.get(n)
            wide = max(dims, key=lambda d: r[f"hi_{d}"] - r[f"lo_{d}"]) if r else dims[0]
            lo, hi = (r[f"lo_{wide}"], r[f"hi_{wide}"]) if r else (0, 0)
            half = (a + b) // 2
            whole = sum(room[a:b])
            # the shares hold for the bytes that are there, whatever earlier cuts missed
            want = (r["bytes"] if r else 0) * (sum(room[a:half]) / whole if whole else 0.5)
            search[n] = {"dim": wide, "lo": lo, "hi": hi, "want": want, "before": 0.0}
        open_ = {n for n, s in search.items() if s["hi"] > s["lo"]}
        while open_:
            rows = [(n, dims.index(s["dim"]) + 1, s["lo"], s["hi"], _cell(s)) for n, s in search.items() if n in open_]
            open_nodes = points.sparkSession.createDataFrame(rows, "node int, dim int, lo long, hi long, w long")
            x = F.element_at(F.array(*[F.col(d) for d in dims]), F.col("dim"))
            h = (at.join(F.broadcast(open_nodes), "node")  # at most one row per leaf
                 .withColumn("x", x).where("x >= lo and x <= hi").withColumn("cell", F.expr("(x - lo) div w")))
            cells = {}
            for r in h.groupBy("node", "cell").agg(F.sum("size").alias("bytes"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect():
                cells.setdefault(r["node"], []).append((r["lo"], r["hi"], float(r["bytes"])))
            for n in list(open_):
                s, run, left = search[n], search[n]["before"], search[n]["lo"] - 1
                for lo, hi, cell_bytes in sorted(cells[n]):
                    if run + cell_bytes >= s["want"]:
                        break
                    run, left = run + cell_bytes, hi
                over, under = run + cell_bytes - s["want"], s["want"] - run
                if min(abs(over), abs(under)) <= MISS * target or lo == hi:
                    s["cut"] = hi if over <= under else left
                    open_.discard(n)
                else:
                    s |= {"lo": lo, "hi": hi, "before": run}
        nxt = {}
        for n, (a, b) in spans.items():
            cuts[n] = (search[n]["dim"], search[n].get("cut", search[n]["hi"]))
            half = (a + b) // 2
            nxt |= {2 * n: (a, half), 2 * n + 1: (half, b)}
        spans = nxt


def _keyed(docs: DataFrame, wide: bool) -> tuple[Wide, DataFrame]:
    """The columns that decide a document's place (beside its own columns if ``wide``)."""
    w = Wide(docs)
    crc = text_crc(w.col("text"))
    own = [F.col(f"c{i}") for i in range(len(w.names))] if wide else []
    return w, w.frame.select(*own, w.col("doc_id").alias("doc_id"), record_size(w.col("text")).alias("size"), crc.alias("crc"),
                             F.xxhash64(F.coalesce(w.col("text"), F.lit(""))).alias("grp"),
                             *[F.shiftleft(v, 32).bitwiseOR(crc).alias(k) for k, v in dimensions(w).items()])


def one_place_per_text(points: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """A function that gives documents of equal text one place: the smallest of their coordinates.

    Only groups whose documents differ (in source or language) are joined;
    the table of these is usually small enough for Spark to broadcast.
    """
    mixed = ["d_source", "d_lang"]
    low = points.groupBy("grp", "crc").agg(*[f(d).alias(f"{k}_{d}") for d in mixed for k, f in (("low", F.min), ("high", F.max))])
    low = materialise(low.where(" or ".join(f"low_{d} <> high_{d}" for d in mixed)).select("grp", "crc", *[f"low_{d}" for d in mixed]))

    def unify(keyed: DataFrame) -> DataFrame:
        j = keyed.join(low, ["grp", "crc"], "left")
        return j.withColumns({d: F.coalesce(f"low_{d}", d) for d in mixed}).drop(*[f"low_{d}" for d in mixed])

    return unify


def plan_shards(points: DataFrame, dims: list[str], shards: int = SHARDS) -> Callable[[DataFrame], DataFrame]:
    """The shard of every point as a function that adds ``shard`` to a table with the same key columns."""
    total = points.agg(F.sum("size")).first()[0] or 0
    target = total / shards
    groups = points.groupBy("grp", "crc").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > LARGE_GROUP * target)
    room, placed = [float(target)] * shards, []
    # at most shards / LARGE_GROUP groups weigh that much
    for g in sorted(groups.collect(), key=lambda g: (-g["bytes"], g["grp"], g["crc"])):
        pieces = -(-g["bytes"] // max(1, int(target))) if g["bytes"] > target else 1
        to = []
        for _ in range(pieces):
            s = max(range(shards), key=lambda i: (room[i], -i))
            room[s] -= g["bytes"] / pieces
            to.append(s)
        placed.append((g["grp"], g["crc"], to))
    big = points.sparkSession.createDataFrame(placed, "grp long, crc long, to array<int>")
    rest = points.join(F.broadcast(big.select("grp", "crc")), ["grp", "crc"], "left_anti")
    cuts, leaf = grow_tree(rest, dims, [max(0.0, x) for x in room])
    node_shard = F.create_map(*[x for n, s in leaf.items() for x in (F.lit(n), F.lit(s))])

    def place(keyed: DataFrame) -> DataFrame:
        piece = F.pmod(F.xxhash64(F.lit("piece"), "doc_id"), F.size("to").cast("long")).cast("int")
        return (keyed.join(F.broadcast(big), ["grp", "crc"], "left")
                .withColumn("shard", F.when(F.col("to").isNotNull(), F.get("to", piece)).otherwise(node_shard[_tree(cuts)]).cast("int")).drop("to"))

    return place


def shard_records(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``; the law is ``bytes`` (sizes near equal).

    Documents with equal texts share a shard, unless their group alone is
    larger than a shard: such a group is dealt by doc_id over as many shards
    as it fills. Groups above LARGE_GROUP of a shard are placed first, largest
    first, on the emptiest shard; the K-d tree then fills the remaining room
    of every shard with all other documents. Each tree dimension is a
    superkey: the dimension's value, then the content hash, so that a cut
    runs between texts, never inside a group. ``slot`` counts the rows of a
    shard from 0 in the order of (content hash, doc_id); ``grown_shard`` is
    null, as this law moves rows when shards are added.

    Nulls: a null text has size 16 and the CRC of the empty text; null source,
    lang or doc_id are values like any other; repeated rows take slots of
    their own; an empty table gives an empty result; extra columns are ignored.
    """
    _, keyed = _keyed(docs, wide=False)
    points = materialise(keyed)
    points = materialise(one_place_per_text(points)(points))
    put = plan_shards(points, list(DIMENSIONS), shards)(points).select("doc_id", "size", "crc", "shard")
    return running_in_group(materialise(put), "shard", [F.col("crc"), F.col("doc_id")], out="slot").select(
        "doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("slot") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def assign_shards(docs: DataFrame, shards: int = SHARDS, out: str = "shard") -> DataFrame:
    """``docs``, texts and all, plus the same shard in column ``out`` (a column of that name gives way); texts aren't shuffled."""
    w, keyed = _keyed(docs, wide=True)
    _, narrow = _keyed(docs, wide=False)
    points = materialise(narrow)
    unify = one_place_per_text(points)
    place = plan_shards(materialise(unify(points)), list(DIMENSIONS), shards)
    placed = place(unify(keyed))
    own = [i for i, n in enumerate(w.names) if n.lower() != out.lower()]
    return placed.select(*[F.col(f"c{i}") for i in own], "shard").toDF(*[w.names[i] for i in own], out)
