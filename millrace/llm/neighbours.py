"""Approximate nearest neighbours: an NN-descent graph, searched greedily.

The graph starts from cross-polytope buckets: vectors nearest to the same axis of a random rotation are
compared among themselves, under several rotations, and once in groups drawn at random, so that no vector
is left without a list. Then, round by round, each vector brings together
the vectors that list it and that it lists (neighbours of neighbours), and every one keeps the nearest
it has seen. A query starts from its own list and, hop by hop, looks at the lists of the nearest vectors
not yet looked at, until all in its beam have been. Both run on rows (vector, list), joined by id;
numpy works within chunks of vectors. Rounds and hops use vectors of two bytes per component, whose error
is below that of the single-precision cosines they give; the whole beam is ranked by the cosine of the
original vectors in double precision.

Equal vectors are put together first: one node with its smallest ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.vectors import matrix, unit, usable, usual_size
from millrace.llm.words import mix
from millrace.scratch import cut_lineage

NEIGHBOURS = 32  # of a node in the graph
ROTATIONS = 4
LEAF = 512  # vectors compared at a time
ROUNDS = 6
SETTLED = 0.01  # rounds end when fewer of all list entries change
MEETING = 20  # listed, and listing, vectors that one vector brings together
BEAM = 208
HOP = 26  # vectors looked at in a hop
REVERSE = 32
CHUNK = 3000
LISTS = "node long, ids array<long>, sims array<float>"


def _short(x: np.ndarray) -> np.ndarray:
    """Two bytes per component."""
    return np.rint(x * (32767 / np.abs(x).max(axis=1, keepdims=True))).astype("<i2")


def _long(column: pa.ChunkedArray) -> np.ndarray:
    """Unit vectors from two bytes per component."""
    x = np.frombuffer(b"".join(column.to_pylist()), "<i2").reshape(len(column), -1).astype(np.float64)
    return (x / np.sqrt((x * x).sum(axis=1, keepdims=True))).astype(np.float32)


def _lists(node: np.ndarray, ids: np.ndarray, sims: np.ndarray, size: int) -> pa.Table:
    """Per node its ``size`` nearest distinct ids, nearest first."""
    order = np.lexsort((ids, node))
    node, ids, sims = node[order], ids[order], sims[order]
    new = np.ones(len(node), dtype=bool)
    new[1:] = (node[1:] != node[:-1]) | (ids[1:] != ids[:-1])
    new &= node != ids
    node, ids, sims = node[new], ids[new], sims[new]
    order = np.lexsort((ids, -sims, node))
    node, ids, sims = node[order], ids[order], sims[order]
    first = np.searchsorted(node, node)
    near = np.arange(len(node)) - first < size
    node, ids, sims = node[near], ids[near], sims[near]
    heads = np.flatnonzero(np.concatenate((np.ones(min(1, len(node)), bool), node[1:] != node[:-1])))
    offsets = pa.array(np.append(heads, len(node)).astype(np.int32))
    return pa.table(
        {
            "node": pa.array(node[heads], pa.int64()),
            "ids": pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int64())),
            "sims": pa.ListArray.from_arrays(offsets, pa.array(sims, pa.float32())),
        }
    )


def _flat(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (node, id, similarity) of lists."""
    ids = table["ids"].combine_chunks()
    node = np.repeat(table["node"].to_numpy(), ids.value_lengths().to_numpy())
    return node, ids.flatten().to_numpy(), table["sims"].combine_chunks().flatten().to_numpy()


def _chunked(rows: DataFrame, by: str, chunks: int, column: str = "chunk") -> DataFrame:
    return rows.withColumn(column, F.pmod(F.xxhash64(by), F.lit(chunks)).cast("int"))


def _buckets(nodes: DataFrame, n: int, size: int) -> DataFrame:
    """(node, short, leaf): a leaf per rotation and one at random. Large buckets are cut at random into leaves."""
    depth = 0 if n <= LEAF else max(1, round(np.log(2 * n / LEAF) / np.log(2 * size)))
    turns = 1 if depth == 0 else ROTATIONS

    def run(batches):
        rng = np.random.default_rng(23)
        rotations = [[np.linalg.qr(rng.normal(size=(size, size)))[0] for _ in range(depth)] for _ in range(turns)]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _long(batch.column(1))
            drawn = mix(batch.column(0).to_numpy().view(np.uint64)) % np.uint64(-(-n // LEAF))
            for turn, parts in enumerate([*rotations, []] if depth else rotations):
                key = drawn.astype(np.int64) if turn == turns else np.full(len(x), turn, dtype=np.int64)
                for rotation in parts:
                    y = x @ rotation.astype(np.float32)
                    axis = np.abs(y).argmax(axis=1)
                    key = key * (2 * size) + 2 * axis + (y[np.arange(len(x)), axis] > 0)
                yield pa.record_batch(
                    [batch.column(0), batch.column(1), pa.array([turn] * len(x), pa.int32()), pa.array(key)],
                    names=["node", "short", "turn", "key"],
                )

    found = cut_lineage(
        nodes.select("node", "short").mapInArrow(run, "node long, short binary, turn int, key long"), "buckets"
    )
    held = found.groupBy("turn", "key").agg(F.count("*").alias("held"))
    part = F.pmod(F.xxhash64("node", "turn"), F.ceil(F.col("held") / LEAF))
    return found.join(held, ["turn", "key"]).select("node", "short", F.xxhash64("turn", "key", part).alias("leaf"))


def _leaf_lists(table: pa.Table) -> pa.Table:
    """Nearest vectors within each leaf of a chunk."""
    table = table.sort_by("leaf")
    leaf, node, x = table["leaf"].to_numpy(), table["node"].to_numpy(), _long(table["short"])
    edges = np.flatnonzero(np.concatenate(([True], leaf[1:] != leaf[:-1], [True])))
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))]
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        sims = x[low:high] @ x[low:high].T
        np.fill_diagonal(sims, -2)
        keep = min(NEIGHBOURS, high - low - 1)
        if keep:
            near = np.argpartition(-sims, keep - 1, axis=1)[:, :keep]
            rows = np.repeat(np.arange(high - low), keep)
            found.append((node[low + rows], node[low + near.ravel()], sims[rows, near.ravel()]))
    return _lists(*(np.concatenate(c) for c in zip(*found, strict=True)), NEIGHBOURS)


def _meet(table: pa.Table) -> pa.Table:
    """Pairs brought together by each hub of a chunk that improve the first one's list."""
    table = table.sort_by("hub")
    hub, member, x = table["hub"].to_numpy(), table["member"].to_numpy(), _long(table["short"])
    worst = table["worst"].to_numpy()
    edges = np.flatnonzero(np.concatenate(([True], hub[1:] != hub[:-1], [True])))
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))]
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        sims = x[low:high] @ x[low:high].T
        rows, columns = np.nonzero(sims > worst[low:high, None])
        other = member[low + rows] != member[low + columns]
        rows, columns = rows[other], columns[other]
        found.append((member[low + rows], member[low + columns], sims[rows, columns]))
    return _lists(*(np.concatenate(c) for c in zip(*found, strict=True)), NEIGHBOURS)


def _merge(left: pa.Table, right: pa.Table) -> pa.Table:
    """Old lists and new ones; ``changed``: entries that the old list had not."""
    a, b = _flat(left), _flat(right)
    table = _lists(*(np.concatenate(c) for c in zip(a, b, strict=True)), NEIGHBOURS)
    node, ids, _ = _flat(table)
    old = {*zip(a[0].tolist(), a[1].tolist(), strict=True)}
    fresh = np.array([p not in old for p in zip(node.tolist(), ids.tolist(), strict=True)], dtype=np.int64)
    lengths = table["ids"].combine_chunks().value_lengths().to_numpy()
    ends = np.cumsum(lengths)
    total = np.concatenate(([0], np.cumsum(fresh)))
    return table.append_column("changed", pa.array(total[ends] - total[ends - lengths], pa.int64()))


def _thinned(edges: DataFrame, by: str, keep: int, salt: str) -> DataFrame:
    """Edges with about ``keep`` per value of ``by`` chosen at random where there are more."""
    held = edges.groupBy(by).agg(F.count("*").alias("held")).where(F.col("held") > keep)
    draw = F.pmod(F.xxhash64(*edges.columns, F.lit(salt)), F.lit(1_000_000)) / 1_000_000
    return edges.join(held, by, "left").where(F.col("held").isNull() | (draw < keep / F.col("held"))).drop("held")


def graph(nodes: DataFrame, n: int, size: int) -> DataFrame:
    """Lists (node, ids, sims) of about the nearest nodes. ``nodes``: (node, short)."""
    chunks = max(8, -(-n // CHUNK))
    leaves = _chunked(_buckets(nodes, n, size), "leaf", chunks)
    parts = leaves.repartition(chunks, "chunk").groupBy("chunk").applyInArrow(_leaf_lists, LISTS)
    empty = nodes.select("node", F.array().cast("array<long>").alias("ids"), F.array().cast("array<float>").alias("sims"))

    def merged(old: DataFrame, new: DataFrame) -> DataFrame:
        left = _chunked(old, "node", chunks).repartition(chunks, "chunk").groupBy("chunk")
        right = _chunked(new, "node", chunks).repartition(chunks, "chunk").groupBy("chunk")
        return cut_lineage(left.cogroup(right).applyInArrow(_merge, LISTS + ", changed long"), "lists")

    lists = merged(empty, parts)
    for turn in range(ROUNDS if n > LEAF else 0):
        edges = lists.select("node", F.explode("ids").alias("id"))
        listed = _thinned(edges, "node", MEETING, f"listed {turn}").select(F.col("node").alias("hub"), F.col("id").alias("member"))
        listing = _thinned(edges, "id", MEETING, f"listing {turn}").select(F.col("id").alias("hub"), F.col("node").alias("member"))
        worst = F.when(F.size("sims") >= NEIGHBOURS, F.array_min("sims")).otherwise(F.lit(-2.0)).cast("float")
        known = nodes.join(lists.select("node", worst.alias("worst")), "node", "left").select(
            F.col("node").alias("member"), "short", F.coalesce("worst", F.lit(-2.0).cast("float")).alias("worst")
        )
        met = _chunked(listed.union(listing).join(known, "member"), "hub", chunks)
        pairs = met.repartition(chunks, "chunk").groupBy("chunk").applyInArrow(_meet, LISTS)
        lists = merged(lists.drop("changed"), pairs)
        if (lists.agg(F.sum("changed")).first()[0] or 0) < SETTLED * n * NEIGHBOURS:
            break
    return lists.drop("changed")


_STATE = "query long, short binary, ids array<long>, sims array<float>, done array<boolean>, next array<long>"


def _beam(left: pa.Table, right: pa.Table) -> pa.Table:
    """Each query's nearest so far, and which of them it looks at next."""
    queries = left["query"].to_numpy()
    x = _long(left["short"])
    order = np.argsort(queries)
    at = order[np.searchsorted(queries, right["query"].to_numpy(), sorter=order)] if right.num_rows else np.zeros(0, int)
    seen = right["cand"].to_numpy()
    sims = (x[at] * _long(right["vector"])).sum(axis=1) if right.num_rows else np.zeros(0, np.float32)
    edges = np.searchsorted(at[by := np.argsort(at, kind="stable")], np.arange(len(queries) + 1))
    rows = []
    for i, (ids, old, done) in enumerate(zip(left["ids"].to_pylist(), left["sims"].to_pylist(), left["done"].to_pylist(), strict=True)):
        own = by[edges[i] : edges[i + 1]]
        beam = dict(zip(seen[own].tolist(), zip(sims[own].tolist(), [False] * len(own), strict=True), strict=True))
        beam.update(zip(ids, zip(old, done, strict=True), strict=True))
        beam.pop(int(queries[i]), None)
        best = sorted(beam.items(), key=lambda e: (-e[1][0], e[0]))[:BEAM]
        following = [k for k, (_, d) in best if not d][:HOP]
        chosen = set(following)
        rows.append(([k for k, _ in best], [s for _, (s, _) in best], [d or k in chosen for k, (_, d) in best], following))
    kinds = (pa.list_(pa.int64()), pa.list_(pa.float32()), pa.list_(pa.bool_()), pa.list_(pa.int64()))
    columns = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.table([left["query"], left["short"], *columns], names=["query", "short", "ids", "sims", "done", "next"])


def search(nodes: DataFrame, lists: DataFrame, queries: DataFrame, n_queries: int) -> DataFrame:
    """(query, ids): the beam of each query (a node), nearest first, by greedy graph search."""
    edges = lists.select("node", F.explode("ids").alias("id"))
    back = _thinned(edges, "id", REVERSE, "reverse").select(F.col("id").alias("node"), F.col("node").alias("id"))
    linked = cut_lineage(edges.union(back).groupBy("node").agg(F.collect_set("id").alias("links")), "links")
    chunks = max(8, -(-n_queries // 200))
    vectors = nodes.select(F.col("node").alias("cand"), F.col("short").alias("vector"))
    none = nodes.sparkSession.createDataFrame([], "query long, cand long, vector binary, chunk int")

    def hop(state: DataFrame, found: DataFrame) -> DataFrame:
        left = _chunked(state, "query", chunks).repartition(chunks, "chunk").groupBy("chunk")
        return cut_lineage(left.cogroup(found.groupBy("chunk")).applyInArrow(_beam, _STATE), "beam")

    ids = F.coalesce("ids", F.array().cast("array<long>")).alias("ids")
    sims = F.coalesce("sims", F.array().cast("array<float>")).alias("sims")
    start = queries.join(nodes, "node").join(lists, "node", "left").select("node", "short", ids, sims).select(
        F.col("node").alias("query"), "short", "ids", "sims",
        F.transform("ids", lambda _: F.lit(False)).alias("done"),
    )
    state = hop(start, none)
    while not (open_ends := state.where(F.size("next") > 0)).isEmpty():
        looked = open_ends.select("query", F.explode("next").alias("node")).join(linked, "node")
        found = looked.select("query", F.explode("links").alias("cand")).distinct().join(vectors, "cand")
        found = found.select(F.col("query").alias("of"), "cand", "vector").withColumnRenamed("of", "query")
        found = _chunked(found, "query", chunks).repartition(chunks, "chunk")
        state = hop(state.drop("next"), found)
    return state.select("query", "ids")


def _ranked(k: int):
    """Each query row's nearest by the exact measure, over all ids of the vectors found."""

    def run(table: pa.Table) -> pa.Table:
        x, y = unit(matrix(table["query_vector"])), unit(matrix(table["vector"]))
        score = (x * y).sum(axis=1)
        lengths = table["vec_ids"].combine_chunks().value_lengths().to_numpy()
        query = np.repeat(table["query_id"].to_numpy(), lengths)
        score = np.repeat(score, lengths)
        found = table["vec_ids"].combine_chunks().flatten().to_numpy()
        other = query != found
        query, score, found = query[other], score[other], found[other]
        order = np.lexsort((found, -score, query))
        query, score, found = query[order], score[order], found[order]
        new = np.ones(len(query), dtype=bool)
        new[1:] = (query[1:] != query[:-1]) | (found[1:] != found[:-1]) | (score[1:] != score[:-1])
        query, score, found = query[new], score[new], found[new]
        rank = np.arange(len(query)) - np.searchsorted(query, query) + 1
        near = rank <= k
        return pa.table(
            {
                "query_id": pa.array(query[near], pa.int64()),
                "rank": pa.array(rank[near], pa.int32()),
                "vec_id": pa.array(found[near], pa.int64()),
                "score": pa.array(score[near], pa.float64()),
            }
        )

    return run


def nearest(
    rows: DataFrame, every: int = 50, k: int = 5, id_col: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row whose id divides by ``every``.

    All rows but the query's own are candidates; nearness is the cosine of the original vectors in
    double precision, ties go to the smaller id. Vectors that are null, zero or have null or
    non-finite components, vectors of another length than most, and rows with a null id take no part.
    Of equal vectors the ``k + 1`` smallest ids are kept, which is all that can be returned. Rows that
    repeat an id are one. Further columns are ignored; an empty table gives no rows. Graph, beams and
    counts are stored in the shared folder.
    """
    narrow = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).alias("embedding"))
    good = narrow.where(F.col("vec_id").isNotNull() & usable("embedding"))
    size = usual_size(good, "embedding")
    good = cut_lineage(good.where(F.size("embedding") == size), "vectors")
    salts = max(1, good.count() // 10_000)
    salt = F.pmod(F.xxhash64("vec_id", F.lit("salt")), F.lit(salts))
    some = good.groupBy("embedding", salt.alias("salt")).agg(F.slice(F.sort_array(F.collect_set("vec_id")), 1, k + 1).alias("ids"))
    merged = F.slice(F.array_distinct(F.sort_array(F.flatten(F.collect_list("ids")))), 1, k + 1)
    groups = some.groupBy("embedding").agg(merged.alias("vec_ids")).withColumn("node", F.col("vec_ids")[0])

    def shorten(batches):
        for batch in batches:
            x = matrix(batch.column(1))
            short = _short(unit(x)) if len(x) else np.zeros((0, 1), np.int16)
            yield pa.record_batch(
                [*batch.columns, pa.array([s.tobytes() for s in short], pa.binary())],
                names=["node", "embedding", "vec_ids", "short"],
            )

    inner = good.schema["embedding"].dataType.simpleString()
    schema = f"node long, embedding {inner}, vec_ids array<long>, short binary"
    nodes = cut_lineage(groups.select("node", "embedding", "vec_ids").mapInArrow(shorten, schema), "nodes")
    n = nodes.count()
    lists = graph(nodes.select("node", "short"), n, max(1, size))
    asked = good.where(F.col("vec_id") % every == 0).join(nodes.select("embedding", "node"), "embedding")
    asked = cut_lineage(asked.select("vec_id", "node", "embedding").distinct(), "queries")
    beams = search(nodes.select("node", "short"), lists, asked.select("node").distinct(), asked.count())
    best = beams.select(F.col("query").alias("node"), F.explode(F.concat(F.array("query"), "ids")).alias("cand"))
    found = nodes.select(F.col("node").alias("cand"), F.col("embedding").alias("vector"), "vec_ids")
    told = asked.withColumnsRenamed({"vec_id": "query_id", "embedding": "query_vector"})
    pairs = told.join(best, "node").join(found, "cand").select("query_id", "query_vector", "vector", "vec_ids")
    chunks = max(8, -(-asked.count() // 200))
    parts = _chunked(pairs, "query_id", chunks).repartition(chunks, "chunk").groupBy("chunk")
    return parts.applyInArrow(_ranked(k), "query_id long, rank int, vec_id long, score double")
