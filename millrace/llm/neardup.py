"""Near-duplicate documents: improved consistent weighted sampling over TF-IDF shingles.

A shingle is a run of ``SHINGLE`` words. Its weight is its count in the document times the mean
inverse document frequency of its words, in sixteenths. (Words rather than shingles: a shingle's own
frequency would sink in just those shingles that a large group of near copies shares.) Document
frequencies count all documents.

Each of ``BANDS * ROWS`` samplings picks a shingle with a chance in proportion to its weight, alike in
all documents; two documents pick alike with a chance equal to their weighted Jaccard similarity.
Documents that agree in all rows of a band meet in a bucket. Every document is compared with the first
of each of its buckets; where a bucket still holds several classes after that, all its documents of
different classes are compared, part by part. Pairs are verified on their full weight vectors. Texts of
equal words are put together first and compared once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import blocks as B
from millrace.llm.components import components
from millrace.llm.words import Words, mix
from millrace.scratch import cut_lineage, discard

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 14, 3
PART = 512  # documents of a bucket compared with one another at a time
PART_BYTES = 4 << 20  # their packed vectors, about
CHUNK_BYTES = 8 << 20
STEPS = 16  # a weight's unit is one sixteenth
TABLE = 1 << 16
SENT_IDS = 500_000  # ids sent to every task at most, 8 bytes each
_SKETCH = "doc_id long, words_hash long, n_words long, bands array<long>, vector binary"


def _tables(seed: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    rate = rng.gamma(2.0, size=TABLE).astype(np.float32)
    log_c = np.log(rng.gamma(2.0, size=TABLE)).astype(np.float32)
    multipliers = rng.integers(1 << 62, 1 << 63, size=BANDS * ROWS, dtype=np.uint64) * 2 + 1
    return np.maximum(rate, 1e-3), log_c, multipliers


def samples(shingle: np.ndarray, weight: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """The samplings of each document (rows). ``heads``: where each document's shingles start.

    Improved consistent weighted sampling: per shingle and sampling, r and c follow a Gamma(2, 1)
    law and b is even on [0, 1), all drawn by hash; t = floor(ln w / r + b) and the shingle with the
    least ln a = ln c - r (t - b + 1) is picked, together with t.
    """
    rate, log_c, multipliers = _tables()
    log_w = np.log(weight).astype(np.float32)
    out = np.empty((len(heads), len(multipliers)), dtype=np.uint64)
    sizes = np.diff(np.append(heads, len(shingle)))
    for k, multiplier in enumerate(multipliers):
        x = shingle * multiplier
        x ^= x >> np.uint64(31)
        x *= multipliers[k - 1]
        r = rate[(x >> np.uint64(48)).astype(np.int32)]
        b = ((x >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.float32) / np.float32(TABLE)
        t = np.floor(log_w / r + b)
        a = log_c[((x >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.int32)] - r * (t - b + 1)
        least = np.minimum.reduceat(a, heads)
        hit = np.flatnonzero(a == np.repeat(least, sizes))
        document = np.searchsorted(heads, hit, side="right") - 1
        first = np.ones(len(hit), dtype=bool)
        first[1:] = document[1:] != document[:-1]
        hit = hit[first]
        out[:, k] = mix(shingle[hit] + t[hit].astype(np.int64).astype(np.uint64) * multiplier)
    return out


def _word_frequencies(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words of a block (48-bit hashes, sorted) and in how many of its texts each stands."""
    words = Words(table["text"])
    hashes = words.hashes() >> np.uint64(16)
    order = np.lexsort((words.text_of, hashes))
    hashes, text = hashes[order], words.text_of[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return np.unique(hashes[new], return_counts=True)


def _pack_vector(shingle: np.ndarray, weight: np.ndarray) -> bytes:
    """Shingles' upper 32 bits, sorted, as differences, and weights; byte columns, compressed."""
    short = (shingle >> np.uint64(32)).astype(np.uint32)
    short[1:] -= short[:-1].copy()
    raw = short.view(np.uint8).reshape(-1, 4).T.tobytes() + weight.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(short).to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack_vector(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:4], "little")
    raw = np.frombuffer(pa.decompress(data[4:], 8 * n, codec="zstd", asbytes=True), np.uint8)
    parts = np.ascontiguousarray(raw.reshape(2, 4, n).transpose(0, 2, 1)).view("<u4")
    return np.cumsum(parts[0].ravel(), dtype=np.uint32), parts[1].ravel().astype(np.int64)


def similarity(one: bytes, other: bytes) -> float:
    """Weighted Jaccard similarity of two packed vectors."""
    (a, wa), (b, wb) = _unpack_vector(one), _unpack_vector(other)
    _, i, j = np.intersect1d(a, b, assume_unique=False, return_indices=True)
    shared = np.minimum(wa[i], wb[j]).sum()
    return float(shared / (wa.sum() + wb.sum() - shared))


def _sketches(left: pa.Table, right: pa.Table, n_docs: int) -> pa.Table:
    words = Words(left["text"])
    hashes = words.hashes()
    keys = B.distinct(hashes >> np.uint64(16))
    df = B.answers_of(right)
    place = np.searchsorted(keys, hashes >> np.uint64(16))
    idf = (np.log((1 + n_docs) / (1 + df)) + 1)[place] if len(df) else np.zeros(0)
    n_words = np.diff(words.first)
    where, shingle = words.runs(SHINGLE, hashes)
    summed = np.concatenate(([0], np.cumsum(idf)))
    mean = (summed[where + SHINGLE] - summed[where]) / SHINGLE
    text = words.text_of[where]
    # A text of fewer words is one shingle.
    short = np.flatnonzero((n_words > 0) & (n_words < SHINGLE))
    if len(short):
        total = np.array(
            [mix(np.array([_sequence(hashes[words.first[i] : words.first[i + 1]])]))[0] for i in short], np.uint64
        )
        shingle = np.concatenate((shingle, total))
        text = np.concatenate((text, short))
        mean = np.concatenate((mean, [idf[words.first[i] : words.first[i + 1]].mean() for i in short]))
    order = np.lexsort((shingle, text))
    shingle, text, mean = shingle[order], text[order], mean[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (text[1:] != text[:-1])
    heads = np.flatnonzero(new)
    count = np.diff(np.append(heads, len(text)))
    shingle, text = shingle[heads], text[heads]
    weight = np.maximum(1, np.rint(mean[heads] * STEPS).astype(np.int64)) * count
    first = B.group_heads(text) if len(text) else np.zeros(0, np.int64)
    picked = samples(shingle, weight, first) if len(first) else np.zeros((0, BANDS * ROWS), np.uint64)
    bands = np.zeros((len(picked), BANDS), dtype=np.uint64)
    for r in range(ROWS):
        bands = mix(bands * np.uint64(0x9E3779B97F4A7C15) + picked[:, r::ROWS])
    last = np.append(first[1:], len(text))
    sequence = [int(_sequence(hashes[words.first[t] : words.first[t + 1]]).view(np.int64)) for t in text[first]]
    return pa.table(
        {
            "doc_id": left["doc_id"].take(pa.array(text[first])).cast(pa.int64()),
            "words_hash": pa.array(sequence, pa.int64()),
            "n_words": pa.array(n_words[text[first]], pa.int64()),
            "bands": pa.array(list(bands.view(np.int64)), pa.list_(pa.int64())),
            "vector": pa.array([_pack_vector(shingle[a:b], weight[a:b]) for a, b in zip(first, last, strict=True)], pa.binary()),
        }
    )


def _sequence(hashes: np.ndarray) -> np.uint64:
    """One hash of a text's words in order."""
    place = np.arange(1, len(hashes) + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix(mix(hashes + place).sum(dtype=np.uint64, keepdims=True))[0]


def sketches(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored sketches of all documents with an id and a word: bands and full weight vectors."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    narrow = narrow.where("doc_id is not null and text is not null")
    size = narrow.agg(F.sum(F.octet_length("text").cast("long")).alias("total"), F.count("*").alias("n")).first()
    total, n_docs = size["total"] or 0, size["n"]
    blocks = B.dealt(narrow, total, "doc_id", "text")
    frequencies = B.ask(blocks, total, _word_frequencies, B.sum_by_key, drop_bits=16)
    found = blocks.groupBy("block").cogroup(frequencies.groupBy("block"))
    return cut_lineage(found.applyInArrow(lambda a, b: _sketches(a, b, n_docs), _SKETCH), "sketches")


def among(rows: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows whose doc_id is (``left_semi``) or is not (``left_anti``) among stored ids.

    Up to ``SENT_IDS`` ids, which are counted, go to every task, so that the rows need no shuffle.
    """
    return rows.join(F.broadcast(ids) if ids.count() <= SENT_IDS else ids, "doc_id", how)


def _verified(pairs: DataFrame, sketch: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose vectors are at least so similar, stored."""
    pairs = cut_lineage(pairs, "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    vectors = among(sketch.select("doc_id", "vector"), cut_lineage(ids, "compared"))
    one = vectors.select(F.col("doc_id").alias("a"), F.col("vector").alias("one"))
    other = vectors.select(F.col("doc_id").alias("b"), F.col("vector").alias("other"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(2), batch.column(3), strict=True)
            alike = [similarity(x.as_py(), y.as_py()) >= threshold for x, y in pairs]
            yield batch.select([0, 1]).filter(pa.array(alike, pa.bool_()))

    joined = pairs.join(one, "a").join(other, "b").select("a", "b", "one", "other")
    return cut_lineage(joined.mapInArrow(check, "a long, b long"), "links")


def _unit_links(
    doc: np.ndarray, name: np.ndarray, part: np.ndarray, bands: np.ndarray, vectors: list[bytes], band: int, threshold: float
) -> list[tuple[int, int]]:
    """Links that join the classes of a unit, of which every two documents are compared.

    Left out are pairs of one class, also by the links found so far, pairs that met in an earlier
    band, pairs whose weights alone rule a link out and, if the unit has two parts, pairs within one.
    """
    unpacked = [_unpack_vector(v) for v in vectors]
    first = np.concatenate(([0], np.cumsum([len(s) for s, _ in unpacked])))
    keys, place = np.unique(np.concatenate([s for s, _ in unpacked]), return_inverse=True)
    weight = np.concatenate([w for _, w in unpacked])
    total = np.add.reduceat(weight, first[:-1])
    own = np.zeros(len(keys), np.int64)
    root = np.unique(name, return_inverse=True)[1]
    between = (part != part[0]).any()
    links = []
    for i in range(len(doc) - 1):
        meet = root != root[i]
        meet[: i + 1] = False
        if between:
            meet &= part != part[i]
        meet &= np.minimum(total, total[i]) >= threshold * np.maximum(total, total[i])
        meet &= ~(bands[:, :band] == bands[i, :band]).any(axis=1)
        at = np.flatnonzero(meet)
        if not len(at):
            continue
        lengths = first[at + 1] - first[at]
        heads = np.cumsum(lengths) - lengths
        entry = np.arange(lengths.sum()) + np.repeat(first[at] - heads, lengths)
        mine = slice(first[i], first[i + 1])
        own[place[mine]] = weight[mine]
        shared = np.add.reduceat(np.minimum(weight[entry], own[place[entry]]), heads)
        own[place[mine]] = 0
        for j in at[shared / (total[at] + total[i] - shared) >= threshold]:
            if root[j] != root[i]:
                links.append((int(min(doc[i], doc[j])), int(max(doc[i], doc[j]))))
                root[root == root[j]] = root[i]
    return links


def _all_met(threshold: float):
    """The links of every unit of a chunk."""

    def run(chunk: pa.Table) -> pa.Table:
        chunk = chunk.sort_by([("unit", "ascending"), ("doc_id", "ascending")])
        unit, doc, name, part, band = (chunk[c].to_numpy() for c in ("unit", "doc_id", "name", "part", "band"))
        bands = chunk["bands"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        edges = np.flatnonzero(np.concatenate(([True], unit[1:] != unit[:-1], [True])))
        links = []
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            at = slice(low, high)
            vectors = chunk["vector"].slice(low, high - low).to_pylist()
            links += _unit_links(doc[at], name[at], part[at], bands[at], vectors, int(band[low]), threshold)
        a, b = zip(*links, strict=True) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _between_classes(held: DataFrame, sketch: DataFrame, threshold: float) -> DataFrame:
    """Links between documents of one bucket and different classes; every such pair is verified.

    ``held``: (band, key, doc_id, size, name), stored. A class that fills ``PART`` documents or
    ``PART_BYTES`` of vectors in a bucket is cut into parts of its own, the other classes into shared
    ones. A unit is two parts of a bucket, or a shared one with itself; parts of one class never meet.
    """
    bucket = ["band", "key"]
    n, size = F.col("n"), F.col("bytes")

    def parts_of(documents, weight):
        return F.greatest(F.ceil(documents / PART), F.ceil(weight / PART_BYTES)).cast("int")

    by_class = held.groupBy(*bucket, "name").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    by_class = cut_lineage(by_class.withColumn("cuts", parts_of(n, size)), "shares")
    small = F.col("cuts") == 1
    mixed = by_class.groupBy(*bucket).agg(
        F.count("*").alias("classes"), parts_of(F.sum(F.when(small, n)), F.sum(F.when(small, size))).alias("shared")
    )
    mixed = cut_lineage(mixed.where("classes > 1").drop("classes"), "mixed")
    own = F.when(~small, F.col("name")).alias("own")
    cuts = by_class.join(mixed, bucket).select(*bucket, "name", own, F.when(small, F.col("shared")).otherwise(F.col("cuts")).alias("cuts"))
    part = F.xxhash64("own", F.pmod(F.xxhash64("doc_id", F.lit("part")), "cuts")).alias("part")
    members = held.join(cut_lineage(cuts, "cuts"), [*bucket, "name"]).select(*bucket, "doc_id", "name", "own", "size", part)
    members = cut_lineage(members, "members")
    parts = cut_lineage(members.groupBy(*bucket, "part", "own").agg(F.sum("size").alias("bytes")), "parts")
    others = parts.select(*bucket, F.col("part").alias("other"), F.col("own").alias("other_own"))
    pairs = parts.join(others, bucket).where(
        "part <= other and (own is null or other_own is null or own <> other_own)"
    )
    unit = F.xxhash64(*bucket, "part", "other").alias("unit")
    units = cut_lineage(pairs.select(*bucket, F.explode(F.array_distinct(F.array("part", "other"))).alias("part"), unit), "units")
    sent = units.join(parts, [*bucket, "part"]).agg(F.sum("bytes")).first()[0] or 0
    chunks = max(16, -(-sent // CHUNK_BYTES))
    placed = cut_lineage(members.join(units, [*bucket, "part"]).select("unit", "band", "doc_id", "name", "part"), "placed")
    carried = placed.join(sketch.select("doc_id", "bands", "vector"), "doc_id")
    carried = carried.withColumn("chunk", F.pmod("unit", F.lit(chunks)).cast("int"))
    compared = carried.repartition(chunks, "chunk").groupBy("chunk")
    return cut_lineage(compared.applyInArrow(_all_met(threshold), "a long, b long").distinct(), "links")


def classes(
    docs: DataFrame, threshold: float = SIMILARITY, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, class_id, kept) for each document: its class's smallest id, and whether it is that.

    Documents are of one class when links join them: equal words, or a verified similarity of
    ``threshold`` or more. A null text or one without words is a class of its own; so is a document
    with a null id (class_id null, kept true). Rows that share an id are one document. An empty
    table gives no rows. Further input columns are ignored. Sketches, links and class names are
    stored in the shared folder.
    """
    sketch = sketches(docs, id_col, text)
    equal = ["words_hash", "n_words"]
    firsts = cut_lineage(sketch.groupBy(*equal).agg(F.min("doc_id").alias("first")), "firsts")
    members = cut_lineage(
        sketch.select("doc_id", *equal).join(firsts, equal).select("doc_id", "first").distinct(), "members"
    )
    unique = sketch.join(members.where("doc_id = first").select("doc_id").distinct(), "doc_id", "left_semi")
    size = F.octet_length("vector").cast("long").alias("size")
    rows = cut_lineage(unique.select("doc_id", size, F.posexplode("bands").alias("band", "key")), "bands")
    buckets = rows.groupBy("band", "key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
    full = cut_lineage(buckets.where("a < last"), "buckets")
    met = rows.join(full, ["band", "key"])
    stars = met.where("doc_id > a").select("a", F.col("doc_id").alias("b")).distinct()
    links = _verified(stars, sketch, threshold)
    named = components(links)
    # Buckets that still hold several classes: every two documents of different ones are compared.
    held = rows.join(full.where("n > 2"), ["band", "key"]).join(named, F.col("doc_id") == F.col("node"), "left")
    held = held.select("band", "key", "doc_id", "size", F.coalesce("component", "doc_id").alias("name"))
    more = _between_classes(cut_lineage(held, "held"), unique, threshold)
    discard(sketch)  # all that is still needed of it is stored
    if not more.isEmpty():
        named = components(links.union(more))
    named = named.select(F.col("node").alias("first"), "component")
    of = members.join(named, "first", "left").select(
        F.col("doc_id").alias("member"), F.coalesce("component", "first").alias("found")
    )
    of = of.groupBy("member").agg(F.min("found").alias("found"))
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    told = ids.join(of, F.col("doc_id") == F.col("member"), "left")
    class_id = F.coalesce("found", "doc_id")
    return told.select("doc_id", class_id.alias("class_id"), F.coalesce(class_id == F.col("doc_id"), F.lit(True)).alias("kept"))
