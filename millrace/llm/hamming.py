"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

A rotation learnt on a sample turns each vector into 64 bits that split the data evenly; vectors at a
small angle differ in few bits. The code's eight bytes give one table per choice of ``BYTES`` of them:
two codes meet in a table when they agree in its bytes. A pair is looked at once, in the first table in
which it meets, by the cosine of the original vectors in double precision.

Rows are vectors, never pairs: buckets are compared as matrices where they lie, and give back counts
of links and the links of a spanning forest. A bucket of more than ``BUCKET`` vectors is cut at random
into parts, and every two parts are compared as a unit of their own, so a hot bucket spreads over tasks.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.vectors import matrix, sampled, unit, usable, usual_size
from millrace.scratch import cut_lineage

BITS = 64
BYTES = 2
SAMPLE = 8192
TURNS = 40
COSINE = 0.98
BUCKET = 1024
CHUNK_ROWS = 20_000


def learn_rotation(x: np.ndarray, seed: int = 17) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection to 64 bits: principal axes, rotated so that signs lose least.

    Each turn takes the signs of the rotated sample and the rotation that best maps the sample onto
    them (an orthogonal Procrustes problem). Shorter vectors are first spread over 64 dimensions.
    """
    d = x.shape[1]
    rng = np.random.default_rng(seed)
    if not len(x):
        return np.zeros(d), rng.normal(size=(d, BITS))
    mean = x.mean(axis=0)
    if d >= BITS:
        _, _, axes = np.linalg.svd((x - mean).T @ (x - mean))
        base = axes[:BITS].T
    else:
        base = np.linalg.qr(rng.normal(size=(BITS, BITS)))[0][:d]
    v = (x - mean) @ base
    rotation = np.linalg.qr(rng.normal(size=(BITS, BITS)))[0]
    for _ in range(TURNS):
        signs = np.where(v @ rotation >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(v.T @ signs)
        rotation = left @ right
    return mean, base @ rotation


def codes(x: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Eight bytes per vector."""
    return np.packbits((x - mean) @ projection >= 0, axis=1)


def _of_length(vectors: pa.Array, length: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors have ``d`` components, and these as unit rows."""
    own = np.flatnonzero(length == d)
    return own, unit(matrix(vectors.take(pa.array(own))))


def _coded(groups: DataFrame, model) -> DataFrame:
    """Every group's code, as eight bytes.

    The rotation was learnt from vectors of the usual length. Others, which are compared among
    themselves alone, get one drawn at random for their length.
    """

    def run(batches):
        mean, projection = model.value
        drawn = {len(mean): (mean, projection)}
        for batch in batches:
            length = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
            found = np.zeros((batch.num_rows, 8), np.uint8)
            for d in np.unique(length).tolist():
                if d not in drawn:
                    drawn[d] = learn_rotation(np.zeros((0, d)))
                own, x = _of_length(batch.column(1), length, d)
                found[own] = codes(x, *drawn[d])
            yield pa.record_batch(
                [batch.column(0), batch.column(1), batch.column(2), batch.column(3),
                 pa.array([c.tobytes() for c in found], pa.binary())],
                names=["label", "embedding", "rep", "copies", "code"],
            )

    kind = groups.schema["label"].dataType.simpleString()
    inner = groups.schema["embedding"].dataType.simpleString()
    schema = f"label {kind}, embedding {inner}, rep long, copies long, code binary"
    return groups.select("label", "embedding", "rep", "copies").mapInArrow(run, schema)


def _bucket_links(
    x: np.ndarray, code: np.ndarray, part: np.ndarray, table: tuple[int, ...], cosine: float
) -> np.ndarray:
    """Which vectors of a unit are linked and met in no earlier table; between parts if it has two."""
    linked = x @ x.T >= cosine
    np.fill_diagonal(linked, False)
    if part[0] != part[-1]:
        linked &= part[:, None] != part[None, :]
    rows, columns = np.nonzero(linked)
    equal = code[rows] == code[columns]
    earlier = [b for b in range(table[-1]) if b not in table]
    met_before = equal[:, earlier].any(axis=1)
    linked[rows[met_before], columns[met_before]] = False
    return linked


def _forest(linked: np.ndarray) -> np.ndarray:
    """For each vector the least one it hangs together with."""
    name = np.arange(len(linked))
    rows, columns = np.nonzero(linked)
    while True:
        after = name.copy()
        np.minimum.at(after, rows, name[columns])
        after = after[after]
        if (after == name).all():
            return name
        name = after


def _compare(tables: list[tuple[int, ...]], cosine: float):
    """All units of a chunk: links counted per vector, and the links of spanning forests."""

    def run(chunk: pa.Table) -> pa.Table:
        chunk = chunk.sort_by([("unit", "ascending"), ("part", "ascending"), ("rep", "ascending")])
        unit_id, rep = chunk["unit"].to_numpy(), chunk["rep"].to_numpy()
        copies, part, table = (chunk[c].to_numpy() for c in ("copies", "part", "table"))
        code = np.frombuffer(b"".join(chunk["code"].to_pylist()), np.uint8).reshape(-1, 8)
        vectors = chunk["embedding"].combine_chunks()
        edges = np.flatnonzero(np.concatenate(([True], unit_id[1:] != unit_id[:-1], [True])))
        out_rep, out_n, out_a = [], [], []
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            own = slice(low, high)
            x = unit(matrix(vectors.slice(low, high - low)))  # a unit's vectors are of one length
            linked = _bucket_links(x, code[own], part[own], tables[table[low]], cosine)
            has = np.flatnonzero(linked.any(axis=1))
            if len(has):
                out_rep.append(rep[own][has])
                out_n.append((linked[has] * copies[own]).sum(axis=1))
                out_a.append(rep[own][_forest(linked)[has]])
        empty = [np.zeros(0, np.int64)]
        return pa.table({"rep": np.concatenate(out_rep or empty), "n": np.concatenate(out_n or empty).astype(np.int64), "a": np.concatenate(out_a or empty)})

    return run


def near_vectors(
    rows: DataFrame,
    cosine: float = COSINE,
    id_col: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    table_bytes: int = BYTES,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row: vectors of one label with at least that cosine.

    Found links are all at or above ``cosine``; of those there are, a share is missed that falls with
    the angle (measured in the README). Equal vectors are put together first and counted, not
    compared. Vectors link with those of their own length alone. Rows with a null label or id, with a
    vector that is null, zero or has null or non-finite components link with nothing: n_links 0, a
    component of their own. Rows that repeat an id count as copies. Further columns are ignored; an empty table
    gives no rows. ``table_bytes`` bytes of agreement make a bucket: 3 for labels of many millions.

    Starts jobs that count lengths and rows, fetch about ``SAMPLE`` vectors and store groups of equal
    vectors, bucket members, links and component names.
    """
    narrow = rows.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector).alias("embedding"), F.col(label).alias("label")
    )
    good = narrow.where(usable("embedding") & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    length = usual_size(good, "embedding")
    same = ["label", "embedding"]
    groups = cut_lineage(
        good.groupBy(*same).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "groups"
    )
    usual = groups.where(F.size("embedding") == length)
    n = usual.count()
    mean, projection = learn_rotation(unit(sampled(usual, "embedding", "rep", SAMPLE, n)) if n else np.zeros((0, max(1, length))))
    model = rows.sparkSession.sparkContext.broadcast((mean, projection))
    coded = cut_lineage(_coded(groups, model), "codes")
    tables = list(combinations(range(8), table_bytes))
    keys = F.array(
        *[
            F.struct(F.lit(i).alias("table"), F.concat(*[F.substring("code", b + 1, 1) for b in t]).alias("key"))
            for i, t in enumerate(tables)
        ]
    )
    narrow_rows = coded.select("label", F.size("embedding").alias("length"), "rep", F.inline(keys))
    bucket = ["label", "length", "table", "key"]
    full = cut_lineage(
        narrow_rows.groupBy(*bucket).agg(F.count("*").alias("held")).where("held > 1"), "held"
    )
    parts = F.ceil(F.col("held") / BUCKET).cast("int")
    own_part = F.pmod(F.xxhash64("rep", "table"), F.col("parts")).cast("int")
    members = narrow_rows.join(full, bucket).withColumn("parts", parts).withColumn("part", own_part)
    # A unit is two parts of a bucket, or one with itself; a part goes to every unit it is in.
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    members = members.select("rep", *bucket, "part", other).select(
        "rep", "table", "part",
        F.xxhash64(*bucket, F.least("part", "other"), F.greatest("part", "other")).alias("unit"),
    )
    members = cut_lineage(members.where("rep is not null"), "members")
    chunks = max(16, -(-members.count() // CHUNK_ROWS))
    carried = members.join(coded.select("rep", "embedding", "copies", "code"), "rep")
    carried = carried.withColumn("chunk", F.pmod("unit", F.lit(chunks)).cast("int"))
    compared = carried.repartition(chunks, "chunk").groupBy("chunk")
    found = cut_lineage(compared.applyInArrow(_compare(tables, cosine), "rep long, n long, a long"), "found")
    counted = found.groupBy("rep").agg(F.sum("n").alias("n"))
    named = components(found.where("a <> rep").select("a", F.col("rep").alias("b")))
    told = groups.join(counted, "rep", "left").join(named, F.col("rep") == F.col("node"), "left")
    told = told.select(
        F.col("label").alias("of_label"), F.col("embedding").alias("of"),
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("links"),
        F.coalesce("component", "rep").alias("component"),
    )
    fits = usable("embedding") & F.col("vec_id").isNotNull()
    linked = narrow.select("vec_id", F.when(fits, F.col("label")).alias("label"), "embedding").join(
        told, (F.col("label") == F.col("of_label")) & (F.col("embedding") == F.col("of")), "left"
    )
    component = F.coalesce("component", "vec_id")
    return linked.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
