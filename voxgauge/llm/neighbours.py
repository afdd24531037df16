"""Approximate nearest neighbours by inner product: a neighbour graph by NN-descent, queries by greedy graph search.

Rows of one vector are one node, so copies form no cliques. Vectors of unequal length get one more coordinate, sqrt(M^2 -
|x|^2) with M the greatest length; then the nearest by distance to a query (with 0 there) are those of the largest
inner product, and neighbours in the graph are neighbours in the same sense. Of that coordinate, a node keeps how much it
falls short of M, as a float beside the coded real ones: where one vector is much longer than the rest it neither sets the
scale of the codes nor drowns their differences. The longest nodes are entries of every search.

The graph starts from random hyperplane cells, split by salt where they are large. In each round the neighbours of a node,
and the nodes that have it as a neighbour, are compared with one another if one of the two is new there, and whoever
is nearer than a node's last neighbour takes its place. It ends when few places change. Edges are then used both ways.

A query starts at its own node. In each round its best nodes not yet opened are opened, their neighbours scored, and the
best kept, for all queries at once by a join with the graph, until none has a better node to open. Candidates
are scored on vectors of one byte a coordinate and the best of them again on the original ones in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from voxgauge.llm.shared import broadcast_if_small, stored

#: Neighbours of a node, and nodes pointing at it that are compared in a round.
DEGREE, REVERSE = 24, 24
#: Tables of cells at the start, and nodes in a cell.
TABLES, CELL = 3, 256
ROUNDS, SETTLED = 8, 0.02
#: In one local comparison, at most this many nodes are proposed to a node.
PROPOSED = 6
#: Search: nodes kept, opened in a round, and rounds at most.
BEAM, OPENED, SEARCH_ROUNDS = 120, 10, 40
#: Entries of all queries: nodes drawn by hash, and the longest ones.
ENTRIES = 32
#: Nodes compared in one task group at once.
GROUP_NODES = 256


def usable(vectors: DataFrame) -> DataFrame:
    """Rows (vec_id, embedding: array<double>) with an id and a finite vector that is not zero."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(v, lambda x: x != 0)
    return vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), v.alias("embedding")
    ).filter(finite & some)


def _matrix(column: pa.ChunkedArray | pa.Array, kind: type) -> np.ndarray:
    parts = column.to_pylist()
    return np.frombuffer(b"".join(parts), kind).reshape(len(parts), -1)


def _bytes(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(rows)], pa.binary())


def make_nodes(spark: SparkSession, vectors: DataFrame, copies: int) -> DataFrame:
    """Distinct vectors: node, vector (doubles), code (bytes with a factor), ids: the ``copies`` least vec_ids, ascending;
    squared: length of the vector, squared.

    Rows of a dimension other than the most frequent one, of which the longest counts, are left out.
    """
    rows = usable(vectors).withColumn("d", F.size("embedding"))
    dimension = rows.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).first()
    d = dimension[0] if dimension else 0
    rows = rows.filter(F.col("d") == d).select("vec_id", "embedding", F.xxhash64("embedding").alias("h"))
    length = rows.agg(F.max(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))).first()[0] or 1.0
    first = W.partitionBy("h", "embedding").orderBy("vec_id")
    kept = rows.distinct().withColumn("k", F.row_number().over(first)).filter(F.col("k") <= copies)
    groups = kept.groupBy("h", "embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    groups = groups.select(F.col("ids")[0].alias("node"), "ids", "embedding")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, -1)
            squared = (x * x).sum(axis=1)
            short = squared / (np.sqrt(length) + np.sqrt(np.maximum(length - squared, 0)))  # M - sqrt(M^2 - |x|^2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), _bytes(x), _bytes(_encode(x, short)), pa.array(squared)],
                ["node", "ids", "vector", "code", "squared"],
            )

    return stored(
        spark, "ann-nodes", groups.mapInArrow(encode, "node long, ids array<long>, vector binary, code binary, squared double")
    )


def _encode(x: np.ndarray, short: np.ndarray) -> np.ndarray:
    """One byte a coordinate, behind the factor (4 bytes) that they are to be multiplied with and ``short`` (4 bytes)."""
    factor = (np.abs(x).max(axis=1) / 127).astype(np.float32)
    codes = np.clip(np.round(x / np.maximum(factor, 1e-30)[:, None]), -127, 127).astype(np.int8)
    head = np.stack([factor, short.astype(np.float32)], axis=1)
    return np.hstack([head.view(np.uint8), codes.view(np.uint8)])


def _decode(codes: np.ndarray) -> np.ndarray:
    """The coordinates, and after them how much the added one falls short."""
    head = np.ascontiguousarray(codes[:, :8]).view(np.float32)
    x = np.ascontiguousarray(codes[:, 8:]).view(np.int8).astype(np.float32) * head[:, :1]
    return np.hstack([x, head[:, 1:]])


def _alike(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of nodes with the added coordinate, less M^2: minus half the squared distances."""
    half_x, half_y = ((v[:, :-1] ** 2).sum(axis=1) / 2 for v in (x, y))
    apart = x[:, -1:] - y[:, -1]
    return x[:, :-1] @ y[:, :-1].T - half_x[:, None] - half_y - apart * apart / 2


def _start(nodes: DataFrame, n: int, degree: int) -> DataFrame:
    """First edges (node, other, score), from the cells of ``TABLES`` sets of random hyperplanes."""
    bits = max(0, int(np.ceil(np.log2(max(n, 1) / CELL))))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _decode(_matrix(batch.column(1), np.uint8))[:, :-1]
            for t in range(TABLES):
                planes = np.random.default_rng(t).normal(size=(x.shape[1], max(bits, 1)))
                cell = ((x @ planes > 0) @ (1 << np.arange(max(bits, 1)))) if bits else np.zeros(len(x), np.int64)
                table = pa.array(np.full(len(x), t, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [table, pa.array(cell.astype(np.int64)), batch.column(0), batch.column(1)],
                    ["t", "cell", "node", "code"],
                )

    placed = nodes.select("node", "code").mapInArrow(cells, "t int, cell long, node long, code binary")
    sizes = placed.groupBy("t", "cell").agg(F.ceil(F.count("*") / CELL).alias("parts"))
    salted = placed.join(broadcast_if_small(sizes), ["t", "cell"]).withColumn(
        "part", F.pmod(F.xxhash64("node", "t"), F.col("parts"))
    )

    def nearest(group: pa.Table) -> pa.Table:
        node, x = group.column("node").to_numpy(), _decode(_matrix(group.column("code"), np.uint8))
        found = []
        for i in range(0, len(x), 512):
            s = _alike(x[i : i + 512], x)
            s[np.arange(len(s)), i + np.arange(len(s))] = -np.inf
            k = min(degree, len(x) - 1)
            if k:
                at = np.argpartition(-s, k - 1, axis=1)[:, :k]
                found.append((np.repeat(node[i : i + 512], k), node[at.ravel()], np.take_along_axis(s, at, 1).ravel()))
        a, b, s = (np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 2 + (np.empty(0),)
        return pa.table({"node": pa.array(a), "other": pa.array(b), "score": pa.array(s, pa.float32())})

    return salted.groupBy("t", "cell", "part").applyInArrow(nearest, "node long, other long, score float")


def _best(edges: DataFrame, degree: int) -> DataFrame:
    """The ``degree`` best edges of each node, ties to the smaller id; an edge met twice counts as old if it once was."""
    edges = edges.groupBy("node", "other").agg(F.max("score").alias("score"), F.min("fresh").alias("fresh"))
    order = W.partitionBy("node").orderBy(F.desc("score"), "other")
    return edges.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= degree).drop("k")


def _proposals(nodes: DataFrame, edges: DataFrame, groups: int, reverse: int) -> DataFrame:
    """Edges found by comparing what lies around each node with one another; only those that would take a place."""
    last = edges.groupBy("node").agg(
        F.when(F.count("*") >= DEGREE, F.min("score")).otherwise(F.lit(-float("inf"))).cast("float").alias("bound")
    )
    order = W.partitionBy("centre").orderBy(F.desc("fresh"), F.xxhash64("member", "centre"))
    ahead = edges.select(F.col("node").alias("centre"), F.col("other").alias("member"), "fresh")
    behind = edges.select(F.col("other").alias("centre"), F.col("node").alias("member"), "fresh")
    behind = behind.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= reverse).drop("k")
    around = ahead.unionByName(behind).groupBy("centre", "member").agg(F.max("fresh").alias("fresh"))
    codes = nodes.select(F.col("node").alias("member"), "code").join(last.withColumnRenamed("node", "member"), "member", "left")
    around = around.join(codes, "member").withColumn("g", F.pmod(F.xxhash64("centre"), F.lit(groups)))

    def compare(group: pa.Table) -> pa.Table:
        centre, member = group.column("centre").to_numpy(), group.column("member").to_numpy()
        fresh = np.asarray(group.column("fresh"))
        bound = np.nan_to_num(group.column("bound").to_numpy(), nan=-np.inf, neginf=-np.inf)
        x = _decode(_matrix(group.column("code"), np.uint8))
        order = np.argsort(centre, kind="stable")
        found: list[tuple] = []
        for rows in np.split(order, np.flatnonzero(np.diff(centre[order])) + 1):
            if len(rows) < 2 or not fresh[rows].any():
                continue
            s = _alike(x[rows], x[rows])
            allowed = (fresh[rows][:, None] | fresh[rows][None, :]) & (s > bound[rows][:, None])
            np.fill_diagonal(allowed, False)
            s = np.where(allowed, s, -np.inf)
            if len(rows) > PROPOSED:
                at = np.argpartition(-s, PROPOSED - 1, axis=1)[:, :PROPOSED]
            else:
                at = np.broadcast_to(np.arange(len(rows)), s.shape)
            value = np.take_along_axis(s, at, 1)
            i, k = np.nonzero(value > -np.inf)
            found.append((member[rows[i]], member[rows[at[i, k]]], value[i, k]))
        a, b, v = (np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 2 + (np.empty(0),)
        return pa.table({"node": pa.array(a), "other": pa.array(b), "score": pa.array(v, pa.float32())})

    return around.groupBy("g").applyInArrow(compare, "node long, other long, score float")


def build_graph(spark: SparkSession, nodes: DataFrame, degree: int = DEGREE) -> DataFrame:
    """Edges (node, other, score) of the neighbour graph."""
    n = nodes.count()
    groups = 1 + n // GROUP_NODES
    edges = _start(nodes, n, degree).withColumn("fresh", F.lit(True))
    edges = stored(spark, "ann-edges", _best(edges, degree))
    for _ in range(ROUNDS):
        proposed = _proposals(nodes, edges, groups, REVERSE).withColumn("fresh", F.lit(True))
        merged = edges.withColumn("fresh", F.lit(False)).unionByName(proposed)
        edges = stored(spark, "ann-edges", _best(merged, degree))
        changed, total = edges.agg(F.count_if("fresh"), F.count("*")).first()
        if changed <= SETTLED * total:
            break
    return edges


def adjacency(spark: SparkSession, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Per node the nodes linked with it, either way, and their codes; a hub's links are spread over several rows."""
    both = edges.select("node", "other").unionByName(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
    both = stored(spark, "ann-links", both.distinct())
    hubs = both.groupBy("node").agg(F.ceil(F.count("*") / (4 * DEGREE)).alias("parts"))
    salted = both.join(hubs, "node").withColumn("part", F.pmod(F.xxhash64("other"), F.col("parts")))
    codes = nodes.select(F.col("node").alias("other"), "code")
    rows = salted.join(codes, "other").groupBy("node", "part").agg(F.collect_list(F.struct("other", "code")).alias("links"))
    return stored(spark, "ann-graph", rows.select("node", "links.other", "links.code"))


STATE = "q long, qcode binary, nodes array<long>, scores array<float>, opened array<boolean>"


def _lists(owner: np.ndarray, n: int, *columns: np.ndarray) -> list[pa.Array]:
    """Columns ordered by owner (0 to n - 1) as lists."""
    ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int32))
    return [pa.ListArray.from_arrays(ends, pa.array(c)) for c in columns]


def search(
    spark: SparkSession, nodes: DataFrame, graph: DataFrame, sought: DataFrame, beam: int = BEAM, opened: int = OPENED
) -> DataFrame:
    """For each node of ``sought`` (q) the nodes kept by greedy search: q, node, itself included."""
    drawn = nodes.orderBy(F.xxhash64("node"), "node").limit(ENTRIES).select("node", "code").collect()
    longest = nodes.orderBy(F.desc("squared"), "node").limit(ENTRIES).select("node", "code").collect()
    seeds = list({r[0]: r for r in [*drawn, *longest]}.values())  # entries for all
    seed_ids = np.array([r[0] for r in seeds], np.int64)
    seed_codes = np.frombuffer(b"".join(bytes(r[1]) for r in seeds), np.uint8).reshape(len(seeds), -1) if seeds else None

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            q, codes = batch.column(0).to_numpy(), _matrix(batch.column(1), np.uint8)
            x = _decode(codes)
            x[:, -1] = 0  # the added coordinate of a query
            s = np.hstack([np.full((len(q), 1), np.inf), x @ _decode(seed_codes).T]).astype(np.float32)
            ids = np.hstack([q[:, None], np.broadcast_to(seed_ids, (len(q), len(seed_ids)))])
            keep = np.ones(ids.shape, bool)
            keep[:, 1:] = ids[:, 1:] != q[:, None]
            owner = np.nonzero(keep)[0]
            lists = _lists(owner, len(q), ids[keep], s[keep], np.zeros(keep.sum(), bool))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], ["q", "qcode", "nodes", "scores", "opened"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_ids, out_scores = [], []
            codes = _decode(_matrix(batch.column(1), np.uint8)) if batch.num_rows else []
            for k in range(batch.num_rows):
                x = codes[k].copy()
                x[-1] = 0
                others = np.asarray(batch.column(2)[k].values)
                found = _decode(_matrix(batch.column(3)[k].values, np.uint8)) @ x
                if len(found) > beam:
                    best = np.argpartition(-found, beam - 1)[:beam]
                    others, found = others[best], found[best]
                out_ids.append(others)
                out_scores.append(found.astype(np.float32))
            ends = pa.array(np.cumsum([0, *map(len, out_ids)]).astype(np.int32))
            flat = lambda x, kind: pa.array(np.concatenate(x) if x else np.empty(0), kind)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.ListArray.from_arrays(ends, flat(out_ids, pa.int64())),
                    pa.ListArray.from_arrays(ends, flat(out_scores, pa.float32())),
                ],
                ["q", "nodes", "scores"],
            )

    def merge(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        q = group.column("q").to_numpy()
        lists = [group.column(c).combine_chunks() for c in ("nodes", "scores", "opened")]
        sizes = np.diff(np.asarray(lists[0].offsets))
        owner = np.repeat(q, sizes)
        node, value = np.asarray(lists[0].flatten()), np.asarray(lists[1].flatten())
        seen = np.zeros(len(node), bool)
        states = np.flatnonzero(np.asarray(lists[2].is_valid()))
        seen_parts = np.asarray(lists[2].flatten())
        is_state = np.zeros(len(q), bool)
        is_state[states] = True
        seen[np.repeat(is_state, sizes)] = seen_parts
        order = np.lexsort((~seen, -value, node, owner))  # of a node met again, the opened or infinite one
        owner, node, value, seen = owner[order], node[order], value[order], seen[order]
        first = np.ones(len(node), bool)
        first[1:] = (owner[1:] != owner[:-1]) | (node[1:] != node[:-1])
        was = np.logical_or.reduceat(seen, np.flatnonzero(first))
        owner, node, value, seen = owner[first], node[first], value[first], was
        order = np.lexsort((node, -value, owner))
        owner, node, value, seen = owner[order], node[order], value[order], seen[order]
        begins = np.searchsorted(owner, owner)
        keep = np.arange(len(owner)) - begins < beam + 1
        owner, node, value, seen = owner[keep], node[keep], value[keep], seen[keep]
        ids, which = np.unique(owner, return_inverse=True)
        codes = dict(zip(q[states].tolist(), group.column("qcode").take(pa.array(states)).to_pylist()))
        out = _lists(which, len(ids), node, value, seen)
        return pa.table([pa.array(ids), pa.array([codes[i] for i in ids.tolist()], pa.binary()), *out], names=["q", "qcode", "nodes", "scores", "opened"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best nodes that are not opened yet: q, qcode, node."""
        for batch in batches:
            q, codes, nodes_ = [], [], []
            for k in range(batch.num_rows):
                at = np.flatnonzero(~np.asarray(batch.column(4)[k].values))[:opened]
                nodes_ += np.asarray(batch.column(2)[k].values)[at].tolist()
                q += [batch.column(0)[k].as_py()] * len(at)
                codes += [batch.column(1)[k].as_py()] * len(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int64()), pa.array(codes, pa.binary()), pa.array(nodes_, pa.int64())], ["q", "qcode", "node"]
            )

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = []
            for k in range(batch.num_rows):
                flags = np.asarray(batch.column(4)[k].values).copy()
                flags[np.flatnonzero(~flags)[:opened]] = True
                done.append(flags)
            ends = pa.array(np.cumsum([0, *map(len, done)]).astype(np.int32))
            flat = pa.array(np.concatenate(done) if done else np.empty(0, bool), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in range(4)], pa.ListArray.from_arrays(ends, flat)],
                ["q", "qcode", "nodes", "scores", "opened"],
            )

    start = nodes.join(sought.select(F.col("q").alias("node")).distinct(), "node", "left_semi").select("node", "code")
    state = stored(spark, "ann-search", start.mapInArrow(begin, STATE))
    groups = 1 + state.count() // 500
    for _ in range(SEARCH_ROUNDS):
        frontier = stored(spark, "ann-frontier", state.mapInArrow(choose, "q long, qcode binary, node long"))
        if frontier.isEmpty():
            break
        met = graph.join(broadcast_if_small(frontier), "node").select("q", "qcode", "other", "code")
        met = met.mapInArrow(score, "q long, nodes array<long>, scores array<float>")
        both = state.mapInArrow(mark, STATE).unionByName(met, allowMissingColumns=True)
        merged = both.groupBy(F.pmod(F.xxhash64("q"), F.lit(groups))).applyInArrow(merge, STATE)
        state = stored(spark, "ann-search", merged)
    return state.select("q", F.explode(F.slice("nodes", 1, beam)).alias("node"))


def nearest(spark: SparkSession, vectors: DataFrame, queries: DataFrame, k: int = 20, beam: int = BEAM) -> DataFrame:
    """For each row of ``queries`` (vec_id) the ``k`` nearest rows found: query_id, rank, vec_id, score.

    Null, zero and non-finite vectors, and rows without an id, take no part. Scores are inner products of the original
    vectors in double precision; ties go to the smaller id; a row is no neighbour of its own. Fewer than ``k``
    others: all of them. Other columns are not read. Equal rows are one; no rows give no rows.
    """
    nodes = make_nodes(spark, vectors, k + 1)
    graph = adjacency(spark, nodes, build_graph(spark, nodes))
    wanted = queries.filter("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id")).distinct()
    own = usable(vectors).join(wanted, "vec_id", "left_semi").distinct()
    vector = nodes.select("node", "ids", "vector")
    held = stored(spark, "ann-queries", own.select("vec_id", F.xxhash64("embedding").alias("h"), "embedding"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [np.array(v.as_py()).tobytes() for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.binary())], ["query_id", "vector"])

    asked = held.select("vec_id", "embedding").mapInArrow(pack, "query_id long, vector binary")
    asked = stored(spark, "ann-asked", asked.join(nodes.select(F.col("node").alias("q"), "vector"), "vector"))
    found = search(spark, nodes, graph, asked.select("q"), beam)
    met = found.join(vector, "node").select("q", "ids", F.col("vector").alias("other"))
    rows = met.join(asked.select("q", F.col("vector").alias("mine")).dropDuplicates(["q"]), "q")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                s = np.einsum("ij,ij->i", _matrix(batch.column(2), np.float64), _matrix(batch.column(3), np.float64))
            else:
                s = np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s)], ["q", "ids", "score"])

    scored = rows.mapInArrow(exact, "q long, ids array<long>, score double")
    scored = scored.select("q", "score", F.explode("ids").alias("vec_id"))
    order = W.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    top = scored.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1).drop("r")  # one may be its own
    pairs = asked.select("query_id", "q").join(top, "q").filter("vec_id <> query_id")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)
