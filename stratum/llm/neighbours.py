"""Approximate nearest neighbours by inner product: NN-descent and greedy graph search.

Equal vectors are one node. Every node keeps the ``k`` nodes it knows to be nearest. They start as the
best within blocks of nodes that are close on a few random directions, and each round joins neighbours of
neighbours: a node's new neighbours and the nodes that it is a neighbour of meet, compare, and tell each
other if one is nearer than what the other has. Rounds end when few lists change. A node that very many
have as neighbour meets them in groups of bounded size.

Who meets where is settled by ids alone. Meetings are then held in cells, the sides of some random planes on
which the meeting's node lies, and each vector goes to a cell once, however many meetings it attends
there; a cell tells each node only the best ``k`` it has found. Lists and beams are ranked by inner products
of the original vectors in double precision, so that near-equal vectors are told apart at each step.

A query is a node of the graph: its search starts from its own neighbours; each step opens the nodes of
its beam that aren't open yet, and their neighbours, as ids, are compared with the query in its cell, where
the best enter the beam. The search ends when no beam has anything left to open. Nodes stand for their
equal rows.

Defined cases: rows with a null id, or a vector that is null, zero, of another length than most, or
holding a null or non-finite component take no part; of rows with one id the smallest vector counts; ties
go to the smaller id; with fewer candidates than asked for, all are returned; an empty table gives an
empty result; extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratum.llm.common import dropped, map_groups, released, shuffle_width, stored

#: Neighbours per node; of those, how many new ones join in a round; nodes of a group besides a node's own
#: neighbours; nodes of a starting block and the number of random directions.
K, JOINED, GROUP, BLOCK, DIRECTIONS = 48, 24, 64, 512, 4
#: Most rounds; share of list entries that must change for another round; nodes in a query's beam.
ROUNDS, CHANGE, BEAM = 8, 0.02, 128
#: Nodes of a cell aimed at (twice as many at most); what the root of a small table's nodes is divided by for
#: the number of its cells; queries of a cell that search together.
CELL, SPREAD, ASKED = 8192, 25, 512
#: Nodes of a block, whose lists are merged together.
BLOCK_NODES = 256


def _matrix(vecs, kind: str) -> np.ndarray:
    if not len(vecs):
        return np.zeros((0, 1))
    return np.frombuffer(b"".join(vecs), kind).reshape(len(vecs), -1).astype(np.float64)


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): ids with a finite, non-zero vector of the most frequent length."""
    df = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    df = df.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0))
    size = df.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return df.filter(F.size("v") == (size[0][0] if size else 0)).groupBy("id").agg(F.min("v").alias("v"))


def _kind(vectors: DataFrame, vec_col: str) -> str:
    """The numpy type that holds the components as they are."""
    return "<f4" if vectors.schema[vec_col].dataType.elementType.typeName() == "float" else "<f8"


def _planes(size: int, n: int) -> np.ndarray:
    """Random planes that cut n nodes into cells of about CELL; a small table into more, smaller ones, whose
    number grows as the root of n, so that its tasks have work while vectors go to few cells."""
    cells = max(1.0, n ** 0.5 / SPREAD, n / CELL)
    return np.random.default_rng(11).normal(size=(round(np.log2(cells)), size))


def _nodes(rows: DataFrame, kind: str, n: int) -> DataFrame:
    """(node, vec, cell): one per different vector, named by its smallest id."""
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            m = np.stack([np.asarray(v).astype(kind) for v in b["v"]])
            sides = m.astype(np.float64) @ _planes(m.shape[1], n).T > 0
            yield pd.DataFrame({"node": b["node"], "vec": [v.tobytes() for v in m],
                                "cell": sides @ (1 << np.arange(sides.shape[1])) if sides.shape[1] else 0})

    nodes = stored(rows.groupBy("v").agg(F.min("id").alias("node")).select("node", "v")
                   .mapInPandas(encode, "node long, vec binary, cell long"), "nn_nodes")
    # crowded cells (near-equal vectors) are split by a hash; a cell's number holds its part
    parts = nodes.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(2 * CELL)).alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    return stored(nodes.join(parts, "cell").select("node", "vec", (F.shiftleft(part, 24) + F.col("cell")).alias("cell")), "nn_nodes")


#: What a task found for the nodes of a block, as pairs: a row per block, not per node.
TOLD = "block long, a array<long>, b array<long>, s array<double>"


def _block_count(n: int) -> int:
    """A prime number of blocks of nodes (node modulo it), so that even steps between ids fill them alike."""
    at = max(2, n // BLOCK_NODES)
    while any(at % d == 0 for d in range(2, int(at ** 0.5) + 1)):
        at += 1
    return at


def _column(parts) -> pd.Series:
    return pd.Series(list(parts), dtype=object)


def _best_of(a: np.ndarray, b: np.ndarray, s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each a, a pair found twice counted once."""
    order = np.lexsort((b, a))
    a, b, s = a[order], b[order], s[order]
    new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][:len(a)]
    a, b, s = a[new], b[new], s[new]
    order = np.lexsort((b, -s, a))
    a, b, s = a[order], b[order], s[order]
    keep = np.arange(len(a)) - np.searchsorted(a, a) < k
    return a[keep], b[keep], s[keep]


def _told(a: np.ndarray, b: np.ndarray, s: np.ndarray, k: int, blocks: int) -> pd.DataFrame:
    """TOLD: the k best that this frame has found for each a."""
    a, b, s = _best_of(a, b, s, k)
    block = a % blocks
    order = np.argsort(block, kind="stable")
    block, a, b, s = block[order], a[order], b[order], s[order]
    numbers, starts = np.unique(block, return_index=True)
    cut = lambda c: _column(np.split(c, starts[1:]) if len(numbers) else [])
    return pd.DataFrame({"block": numbers, "a": cut(a), "b": cut(b), "s": cut(s)})


def _start(nodes: DataFrame, n: int, k: int, width: int, kind: str) -> DataFrame:
    """TOLD: the best in blocks of nodes that lie close on a random direction."""
    blocks = _block_count(n)

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, own in frame.groupby(["direction", "cell", "part"], sort=False):
            m, ids = _matrix(own["vec"], kind), own["node"].to_numpy()
            s = m @ m.T
            np.fill_diagonal(s, -np.inf)
            best = np.argsort(-s, axis=1)[:, :min(max(1, 2 * k // DIRECTIONS), len(ids) - 1)]
            out.append((np.repeat(ids, best.shape[1]), ids[best].ravel(), np.take_along_axis(s, best, 1).ravel()))
        return _told(*map(np.concatenate, zip(*out)), k, blocks)

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            m = _matrix(b["vec"], kind)
            lines = np.random.default_rng(5).normal(size=(DIRECTIONS, m.shape[1]))
            at = (m @ lines.T) / np.linalg.norm(m, axis=1)[:, None] * np.sqrt(m.shape[1]) \
                / np.linalg.norm(lines, axis=1)
            # about evenly filled cells: the place on a direction is close to normal
            even = 1 / (1 + np.exp(-1.702 * at))
            for d in range(DIRECTIONS):
                yield b.assign(direction=d, cell=np.floor(even[:, d] * max(1, round(n / BLOCK))).astype(int))

    celled = stored(nodes.select("node", "vec").mapInPandas(cells, "node long, vec binary, direction int, cell long"), "nn_cells")
    # crowded cells (near-equal vectors) are split by a hash, another one for each direction
    parts = celled.groupBy("direction", "cell").agg(F.ceil(F.count("*") / F.lit(2 * BLOCK)).alias("parts"))
    celled = celled.join(parts, ["direction", "cell"]).withColumn(
        "part", F.pmod(F.xxhash64("node", "direction"), F.col("parts"))).drop("parts")
    return map_groups(celled, ["direction", "cell", "part"], width, compare, TOLD)


def _merged(lists: DataFrame, told: DataFrame, n: int, k: int, joined: int, width: int) -> DataFrame:
    """(a, cell, vec, nbrs, sims, fresh, role): each node's k best, nearest first; a pair told twice counts
    once, and is fresh only if no list had it as joined before. role: 2 for the fresh ones that join next,
    1 for others that join, 0 for those that don't."""
    blocks = _block_count(n)
    own = lists.select(F.pmod("a", F.lit(blocks)).alias("block"), F.col("a").alias("node"), "cell", "vec",
                       F.array_repeat("a", F.size("nbrs")).alias("a"), F.col("nbrs").alias("b"), F.col("sims").alias("s"), "fresh")
    new = told.select("block", *[F.lit(0).cast("long").alias(c) for c in ("node", "cell")], F.lit(None).cast("binary").alias("vec"),
                      "a", "b", "s", F.transform("a", lambda x: F.lit(True)).alias("fresh"))

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        base = frame[frame["vec"].notna()].sort_values("node")
        a, b, s, fresh = (np.concatenate(frame[c].to_numpy()).astype(t)
                          for c, t in (("a", np.int64), ("b", np.int64), ("s", float), ("fresh", bool)))
        order = np.lexsort((fresh, b, a))
        a, b, s, fresh = a[order], b[order], s[order], fresh[order]
        first = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][:len(a)]
        a, b, s, fresh = a[first], b[first], s[first], fresh[first]
        order = np.lexsort((b, -s, a))
        a, b, s, fresh = a[order], b[order], s[order], fresh[order]
        rank = np.arange(len(a)) - np.searchsorted(a, a)
        a, b, s, fresh, rank = (x[rank < k] for x in (a, b, s, fresh, rank))
        sums = np.r_[0, np.cumsum(fresh)]
        nth = sums[1:] - sums[np.searchsorted(a, a)]
        role = np.where(fresh, np.where(nth <= joined, 2, 0), np.where(rank < joined, 1, 0)).astype(np.int8)
        ends = np.searchsorted(a, base["node"].to_numpy(), side="right")
        cut = lambda c: _column(np.split(c, ends)[:len(base)])
        return pd.DataFrame({"a": base["node"].to_numpy(), "cell": base["cell"].to_numpy(), "vec": base["vec"].to_numpy(),
                             "nbrs": cut(b), "sims": cut(s), "fresh": cut(fresh), "role": cut(role)})

    return map_groups(own.unionByName(new), ["block"], width, merge,
                      "a long, cell long, vec binary, nbrs array<long>, sims array<double>, fresh array<boolean>, "
                      "role array<tinyint>")


def _seated(parties: DataFrame, who: str, graph: DataFrame, k: int) -> DataFrame:
    """(cell, node, vec, last): each vector once for each cell where it is wanted; ``last``: the least that a
    node must be told."""
    last = F.when(F.size("nbrs") < k, F.lit(float("-inf"))).otherwise(F.get("sims", F.size("sims") - 1))
    seats = parties.select("cell", F.explode(who).alias("node")).distinct()
    return seats.join(graph.select(F.col("a").alias("node"), "vec", last.alias("last")), "node")


def _round(graph: DataFrame, n: int, k: int, width: int, kind: str) -> DataFrame:
    """TOLD: pairs found among neighbours of one node, where b is nearer to a than a's last one."""
    blocks = _block_count(n)
    edges = graph.select("a", F.col("cell").alias("a_cell"), F.explode(F.arrays_zip("nbrs", "role")).alias("e")) \
        .select("a", "a_cell", F.col("e.nbrs").alias("b"), F.col("e.role").alias("role")).filter("role > 0") \
        .select("a", "a_cell", "b", (F.col("role") == 2).alias("fresh"))
    # groups that a node needs for those that have it as neighbour
    groups = edges.groupBy("b").agg(F.ceil(F.count("*") / F.lit(GROUP)).alias("b_groups")) \
        .join(graph.select(F.col("a").alias("b"), F.col("cell").alias("b_cell")), "b")
    groups = stored(groups, "nn_groups")
    edges = edges.join(groups, "b").join(groups.select(F.col("b").alias("a"), F.col("b_groups").alias("a_groups")),
                                         "a", "left")
    # a's neighbour b comes to every group of a; a comes to one group of b
    every = F.sequence(F.lit(0).cast("long"), F.coalesce("a_groups", F.lit(1)).cast("long") - 1)
    to_a = F.transform(every, lambda g: F.struct(F.col("a").alias("via"), F.col("a_cell").alias("cell"), g.alias("g"),
                                                 F.col("b").alias("node")))
    to_b = F.array(F.struct(F.col("b").alias("via"), F.col("b_cell").alias("cell"),
                            F.pmod(F.xxhash64("a"), F.col("b_groups")).cast("long").alias("g"), F.col("a").alias("node")))
    met = edges.select("fresh", F.explode(F.concat(to_a, to_b)).alias("e")).select("e.*", "fresh")
    # a node's first group meets in its cell, the others of a node that many have as neighbour anywhere
    cell = F.when(F.col("g") == 0, F.col("cell")).otherwise(-1 - F.pmod(F.xxhash64("via", "g"), F.lit(max(width, n // 2000)).cast("long")))
    parties = met.groupBy("via", "g", "cell").agg(F.collect_list("node").alias("who"), F.collect_list("fresh").alias("fresh")) \
        .filter(F.exists("fresh", lambda x: x)).select(cell.alias("cell"), "via", "who", "fresh")
    parties = stored(parties, "nn_parties")
    seats = _seated(parties, "who", graph, k)
    no_one = F.array().cast("array<long>")
    rows = parties.select("cell", "via", F.lit(0).cast("long").alias("node"), F.lit(None).cast("binary").alias("vec"),
                          F.lit(0.0).alias("last"), "who", "fresh") \
        .unionByName(seats.select("cell", F.lit(0).cast("long").alias("via"), "node", "vec", "last", no_one.alias("who"),
                                  F.array().cast("array<boolean>").alias("fresh")))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        a, b, s = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for _, own in frame.groupby("cell", sort=False):
            seat = own[own["vec"].notna()].sort_values("node")
            ids, last = seat["node"].to_numpy(), seat["last"].to_numpy()
            m = np.frombuffer(b"".join(seat["vec"]), kind).reshape(len(ids), -1)
            party = own[own["vec"].isna()]
            for who, new in zip(party["who"], party["fresh"]):
                who, place = np.unique(who, return_inverse=True)
                at, fresh = np.searchsorted(ids, who), np.zeros(len(who), bool)
                fresh[place[new.astype(bool)]] = True
                v = m[at].astype(np.float64)
                sim = v @ v.T
                nearer = (sim > last[at, None]) & (fresh[:, None] | fresh[None, :])
                np.fill_diagonal(nearer, False)
                i, j = np.nonzero(nearer)
                a.append(who[i])
                b.append(who[j])
                s.append(sim[i, j])
        return _told(np.concatenate(a), np.concatenate(b), np.concatenate(s), k, blocks)

    return map_groups(rows, ["cell"], width, compare, TOLD)


def build_graph(nodes: DataFrame, n: int, kind: str, k: int = K, joined: int = JOINED, rounds: int = ROUNDS,
                change: float = CHANGE) -> DataFrame:
    """NN-descent: (a, cell, vec, nbrs, sims, fresh, role) for each node."""
    spark = nodes.sparkSession
    width = max(shuffle_width(spark), n // 20_000)
    none = [F.array().cast(t).alias(c) for c, t in (("nbrs", "array<long>"), ("sims", "array<double>"), ("fresh", "array<boolean>"))]
    alone = nodes.select(F.col("node").alias("a"), "cell", "vec", *none)
    graph = stored(_merged(alone, _start(nodes, n, k, width, kind), n, k, joined, width), "nn_graph")
    for _ in range(rounds):
        old = graph.select("a", "cell", "vec", "nbrs", "sims",
                           F.zip_with("fresh", "role", lambda x, r: x & (r != 2)).alias("fresh"))
        after = stored(_merged(old, _round(graph, n, k, width, kind), n, k, joined, width), "nn_graph")
        dropped(graph)
        graph = after
        fresh, all_ = graph.agg(F.sum(F.size(F.filter("fresh", lambda x: x))), F.sum(F.size("nbrs"))).collect()[0]
        released(spark)
        if not fresh or fresh < change * all_:
            break
    return graph


def search(graph: DataFrame, queries: DataFrame, n: int, kind: str, k: int = K, beam: int = BEAM) -> DataFrame:
    """(query, node): the beam of each query node after greedy search."""
    spark = graph.sparkSession
    width = max(shuffle_width(spark), n // 20_000)
    own = graph.join(queries.select(F.col("node").alias("a")), "a", "left_semi")
    # cells with very many queries are held in parts
    crowd = own.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(ASKED)).alias("parts"))
    part = F.pmod(F.xxhash64("a"), F.col("parts"))
    state = stored(own.join(crowd, "cell").select(
        F.col("a").alias("query"), (F.shiftleft(part, 40) + F.col("cell")).alias("cell"), "vec", F.col("nbrs").alias("beam"),
        "sims", F.transform("nbrs", lambda x: F.lit(False)).alias("opened")), "nn_beams")
    columns = "query long, cell long, vec binary, beam array<long>, sims array<double>, opened array<boolean>"
    done = []

    def step(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, own in frame.groupby("cell", sort=False):
            seat = own[own["seated"]].sort_values("query")
            ids = seat["query"].to_numpy()
            m = np.frombuffer(b"".join(seat["vec"]), kind).reshape(len(ids), -1) if len(ids) else None
            for q, cell, vec, had, sims, asked in own[~own["seated"]][["query", "cell", "vec", "beam", "sims", "asked"]] \
                    .itertuples(index=False):
                s = m[np.searchsorted(ids, asked)].astype(np.float64) @ np.frombuffer(vec, kind).astype(np.float64) \
                    if len(asked) else np.zeros(0)
                node, s = np.r_[had, asked], np.r_[sims, s]
                opened = np.arange(len(node)) < len(had)
                best = np.lexsort((node, -s))[:beam]
                out.append((q, cell, vec, node[best], s[best], opened[best]))
        names = ["query", "cell", "vec", "beam", "sims", "opened"]
        return pd.DataFrame({c: _column(o[i] for o in out) for i, c in enumerate(names)}).astype({"query": "int64", "cell": "int64"})

    while True:
        closed = state.filter(F.exists("opened", lambda x: ~x))
        done.append(state.filter(~F.exists("opened", lambda x: ~x)).select("query", F.explode("beam").alias("node")))
        if not closed.limit(1).count():
            break
        frontier = closed.select("query", F.explode(F.arrays_zip("beam", "opened")).alias("e")).filter(~F.col("e.opened")) \
            .select("query", F.col("e.beam").alias("a"))
        told = frontier.join(graph.select("a", "nbrs"), "a").select("query", F.explode("nbrs").alias("node")) \
            .groupBy("query").agg(F.collect_set("node").alias("told"))
        asked = F.array_except(F.array_except("told", "beam"), F.array("query"))
        parties = stored(closed.join(told, "query", "left")
                         .withColumn("asked", F.coalesce(asked, F.array().cast("array<long>"))).drop("told"), "nn_asking")
        seats = _seated(parties, "asked", graph, k)
        empty = [F.array().cast(t).alias(c) for c, t in (("beam", "array<long>"), ("sims", "array<double>"),
                                                         ("opened", "array<boolean>"), ("asked", "array<long>"))]
        rows = parties.withColumn("seated", F.lit(False)).unionByName(
            seats.select(F.col("node").alias("query"), "cell", "vec", *empty, F.lit(True).alias("seated")))
        state = stored(map_groups(rows, ["cell"], width, step, columns), "nn_beams")
        released(spark)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def nearest(vectors: DataFrame, queries: DataFrame, top: int = 20, k: int = K, beam: int = BEAM,
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The ``top`` nearest rows found for each query id (column ``query_id``): query_id, rank, vec_id,
    score (inner product of the original vectors in double precision)."""
    spark = vectors.sparkSession
    rows = stored(usable(vectors, id_col, vec_col), "nn_rows")
    kind = _kind(vectors, vec_col)
    n = rows.select("v").distinct().count()
    nodes = _nodes(rows, kind, n)
    # a class never gives more than top + 1 rows to a query; the limit by rank runs before the shuffle
    classes = rows.groupBy("v").agg(F.min("id").alias("node"))
    of = stored(rows.join(classes, "v").select("id", "node"), "nn_classes")
    by = Window.partitionBy("node").orderBy("id")
    members = of.withColumn("r", F.row_number().over(by)).filter(F.col("r") <= top + 1).drop("r")
    asked = stored(of.join(queries.select(F.col("query_id").cast("long").alias("id")).distinct(), "id")
                   .select(F.col("id").alias("query_id"), F.col("node").alias("query")), "nn_asked")
    k = min(k, max(1, n - 1))
    if n > 1:
        graph = build_graph(nodes, n, kind, k)
        found = search(graph, asked.select(F.col("query").alias("node")).distinct(), n, kind, k, beam)
        pairs = found.unionByName(asked.select("query", F.col("query").alias("node")).distinct())
    else:
        pairs = asked.select("query", F.col("query").alias("node")).distinct()
    exact = classes.select("node", "v")
    dot = F.aggregate(F.zip_with("v", "w", lambda x, y: x * y), F.lit(0.0), lambda x, y: x + y)
    pairs = pairs.join(exact, "node").join(exact.select(F.col("node").alias("query"), F.col("v").alias("w")), "query") \
        .select("query", "node", dot.alias("score"))
    by_class = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    pairs = pairs.withColumn("r", F.row_number().over(by_class)).filter(F.col("r") <= top + 1).drop("r")
    # classes of a query come before their rows, so that at most (top + 1)^2 rows meet a query class
    by_query = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    of_class = pairs.join(members, "node").withColumn("r", F.row_number().over(by_query)) \
        .filter(F.col("r") <= top + 1).select("query", F.col("id").alias("vec_id"), "score")
    final = asked.join(of_class, "query").filter(F.col("query_id") != F.col("vec_id"))
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return final.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= top) \
        .select("query_id", "rank", "vec_id", "score")
