"""Ask something of all documents about each distinct key of a block of documents.

Documents are dealt into blocks of a few megabytes. Each block lists its distinct keys (hashes) once,
sorted, with a number each, cut into pieces by key range: a key that stands in every document leaves a
block once, so no key can grow hot. A bucket gathers the pieces of one key range from all blocks,
combines the numbers of equal keys and answers every piece with one number per key, in the piece's
order. The answers go back to the blocks, which read them beside their documents.

A block is cut into ``FAN`` ranges at most. Where more buckets are needed, ``FAN`` blocks' pieces of
one range are merged into a node, as large as a block, which is cut further, and so on; answers go
back through the nodes. So the pieces of one level grow as the bytes do, not as their square, and a
level more is needed for ``FAN`` times the bytes.

Sorted keys are stored as differences, byte by byte in columns, compressed: the more keys a piece
has, the fewer bytes each takes. Numbers are an array with one entry a key, or ``width`` such arrays.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.workers import give_back

BLOCK_BYTES = 2 << 20
BUCKET_KEYS = 1_500_000
FAN = 256
PIECE = "block int, bucket int, n int, keys binary, numbers binary"
ANSWER = "block int, bucket int, n int, answers binary"
_PIECE_SCHEMA = pa.schema(
    [("block", pa.int32()), ("bucket", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()),
     ("numbers", pa.binary())]
)
_ANSWER_SCHEMA = pa.schema(
    [("block", pa.int32()), ("bucket", pa.int32()), ("n", pa.int32()), ("answers", pa.binary())]
)
Keys = Callable[..., tuple[np.ndarray, np.ndarray]]
Combine = Callable[[np.ndarray, np.ndarray], np.ndarray]


def pack(values: np.ndarray) -> bytes:
    """64-bit values as compressed byte columns."""
    columns = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T
    return pa.Codec("zstd", compression_level=5).compress(np.ascontiguousarray(columns), asbytes=True)


def unpack(data: bytes, n: int, dtype: type = np.int64, width: int = 1) -> np.ndarray:
    raw = pa.decompress(data, decompressed_size=8 * n * width, codec="zstd", asbytes=True)
    values = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n * width).T).view(dtype).ravel()
    return values if width == 1 else values.reshape(width, n)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts: one number for the driver."""
    return docs.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0


def dealt(docs: DataFrame, total: int, id_col: str, text: str) -> DataFrame:
    """The documents with a column ``block``, each block in one partition.

    Copies of a whole row, id included, spread as far as they come from several partitions.
    """
    n = max(1, -(-total // BLOCK_BYTES))
    block = F.pmod(F.xxhash64(F.col(id_col), F.col(text), F.spark_partition_id()), F.lit(n)).cast("int")
    return docs.withColumn("block", block).repartition(n, "block")


def grouped_min(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the least value of each."""
    order = np.lexsort((values, keys))
    keys, values = keys[order], values[order]
    head = np.ones(len(keys), dtype=bool)
    head[1:] = keys[1:] != keys[:-1]
    return keys[head], values[head]


def ask(
    blocks: DataFrame,
    total: int,
    keys: Keys,
    combine: Combine,
    drop_bits: int = 0,
    width: int = 1,
    beside: DataFrame | None = None,
) -> DataFrame:
    """The answers for each block, as ``ANSWER``; see ``pieces_of`` and ``answered``."""
    return answered(pieces_of(blocks, total, keys, drop_bits, width, beside), total, combine, width)


def ranges(total: int) -> list[int]:
    """Into how many ranges all keys are cut at each level; the last number is that of the buckets."""
    buckets = max(16, total // 5 // BUCKET_KEYS)
    levels = [1]
    while levels[-1] * FAN < buckets:
        levels.append(levels[-1] * FAN)
    return [*levels[1:], levels[-1] * -(-buckets // levels[-1])]


def pieces_of(
    blocks: DataFrame,
    total: int,
    keys: Keys,
    drop_bits: int = 0,
    width: int = 1,
    beside: DataFrame | None = None,
    keep: Callable[[DataFrame], DataFrame] = lambda pieces: pieces,
) -> list[DataFrame]:
    """Each block's keys, cut by key range into pieces, as ``PIECE``: a frame for each level.

    ``keys`` gives a block's distinct unsigned keys of ``64 - drop_bits`` bits, sorted, and ``width``
    numbers each; it is given the block's documents and, if ``beside`` is, the rows of that frame with
    the same ``block``. ``total``, the bytes of all texts, sizes the buckets. ``keep`` may store a
    level. In a level but the first ``block`` is a node's number.
    """
    every = ranges(total)
    unit = (1 << (64 - drop_bits)) // every[-1]

    def cut(block: int, parent: int, fan: int, step: int, found: np.ndarray, numbers: np.ndarray) -> pa.Table:
        bounds = np.array([step * (parent * fan + i) for i in range(1, fan)], dtype=np.uint64)
        edges = np.concatenate(([0], np.searchsorted(found, bounds), [len(found)]))
        rows = []
        for i, (low, high) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if high > low:
                part = found[low:high].copy()
                part[1:] -= found[low : high - 1]
                rows.append((block, parent * fan + i, high - low, pack(part), pack(numbers[..., low:high])))
        columns = zip(*rows, strict=True) if rows else [[] for _ in _PIECE_SCHEMA]
        return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, _PIECE_SCHEMA, strict=True)], _PIECE_SCHEMA)

    def of_block(*tables: pa.Table) -> pa.Table:
        give_back()
        return cut(tables[0]["block"][0].as_py(), 0, every[0], unit * (every[-1] // every[0]), *keys(*tables))

    grouped = blocks.groupBy("block")
    if beside is None:
        level = grouped.applyInArrow(lambda table: of_block(table), PIECE)
    else:
        level = grouped.cogroup(beside.groupBy("block")).applyInArrow(lambda docs, more: of_block(docs, more), PIECE)
    levels = []
    for above, here in zip(every[:-1], every[1:], strict=True):
        levels.append(keep(_to_nodes(level, above, total)))
        level = levels[-1].groupBy("node").applyInArrow(_node_cut(cut, above, here, unit * (every[-1] // here), width), PIECE)
    return [*levels, keep(level.repartition(every[-1], "bucket"))]


def _to_nodes(level: DataFrame, n_ranges: int, total: int) -> DataFrame:
    """The pieces of a level with a column ``node``: ``FAN`` blocks (or nodes) of one range, merged next."""
    group = F.floor(F.col("block") / F.lit(n_ranges)).cast("int")
    node = (group * F.lit(n_ranges) + F.col("bucket")).cast("int").alias("node")
    return level.select("*", node).repartition(max(1, -(-total // BLOCK_BYTES)), "node")


def _node_cut(cut: Callable[..., pa.Table], above: int, here: int, step: int, width: int):
    def of_node(table: pa.Table) -> pa.Table:
        give_back()
        found, numbers, _ = opened(table.sort_by("block"), width)
        order = np.argsort(found, kind="stable")
        node = table["node"][0].as_py()
        return cut(node, node % above, here // above, step, found[order], numbers[..., order])

    return of_node


def opened(table: pa.Table, width: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All keys and numbers of a bucket's pieces, one piece after the other, and where each starts."""
    edges = np.concatenate(([0], np.cumsum(table["n"].to_numpy())))
    every = np.empty(edges[-1], dtype=np.uint64)
    numbers = np.empty(edges[-1] if width == 1 else (width, edges[-1]), dtype=np.int64)
    for packed, values, low, high in zip(table["keys"], table["numbers"], edges[:-1], edges[1:], strict=True):
        np.cumsum(unpack(packed.as_py(), high - low, np.uint64), out=every[low:high])
        numbers[..., low:high] = unpack(values.as_py(), high - low, width=width)
    return every, numbers, edges


def answered(levels: list[DataFrame], total: int, combine: Combine, width: int = 1) -> DataFrame:
    """The answers to all pieces of ``pieces_of``, dealt like the blocks.

    ``combine`` takes all keys of a bucket in key order with their numbers, and gives an answer for
    each row.
    """

    def told(table: pa.Table, replies: np.ndarray, edges: np.ndarray) -> pa.Table:
        packed = [pack(replies[..., a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        columns = [table["block"], table["bucket"], table["n"], pa.array(packed, pa.binary())]
        return pa.table([c.cast(f.type) for c, f in zip(columns, _ANSWER_SCHEMA, strict=True)], _ANSWER_SCHEMA)

    def answer(table: pa.Table) -> pa.Table:
        give_back()
        every, numbers, edges = opened(table, width)
        order = np.argsort(every, kind="stable")
        replies = np.empty_like(numbers)
        replies[..., order] = combine(every[order], numbers[..., order])
        return told(table, replies, edges)

    def hand_back(pieces: pa.Table, answers: pa.Table) -> pa.Table:
        give_back()
        pieces = pieces.sort_by("block")
        every, numbers, edges = opened(pieces, width)
        replies = np.empty_like(numbers)
        replies[..., np.argsort(every, kind="stable")] = answers_of(answers, width)
        return told(pieces, replies, edges)

    n_blocks = max(1, -(-total // BLOCK_BYTES))
    replies = levels[-1].groupBy("bucket").applyInArrow(answer, ANSWER).repartition(n_blocks, "block")
    for level in reversed(levels[:-1]):
        back = level.groupBy("node").cogroup(replies.groupBy("block")).applyInArrow(hand_back, ANSWER)
        replies = back.repartition(n_blocks, "block")
    return replies


def answers_of(table: pa.Table, width: int = 1) -> np.ndarray:
    """All answers for one block, in the order of its sorted keys."""
    table = table.sort_by("bucket")
    parts = [unpack(a.as_py(), n.as_py(), width=width) for a, n in zip(table["answers"], table["n"], strict=True)]
    none = np.zeros(0 if width == 1 else (width, 0), np.int64)
    return np.concatenate(parts, axis=-1) if parts else none


def group_heads(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal sorted keys starts."""
    head = np.ones(len(keys), dtype=bool)
    head[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(head)


def distinct(keys: np.ndarray) -> np.ndarray:
    """Distinct keys, sorted. ``np.unique`` gives the same through a hash table, at many times a sort's cost."""
    keys = np.sort(keys)
    return keys[group_heads(keys)]


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the number of each row's key among them."""
    order = np.argsort(keys)
    found = keys[order]
    heads = group_heads(found)
    number = np.empty(len(keys), np.int64)
    number[order] = spread(np.arange(len(heads)), heads, len(keys))
    return found[heads], number


def spread(per_group: np.ndarray, heads: np.ndarray, n: int) -> np.ndarray:
    """A value per group, repeated for each of its rows."""
    return np.repeat(per_group, np.diff(np.append(heads, n)))


def sum_by_key(keys: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """For each row of sorted keys, the sum over its key."""
    heads = group_heads(keys)
    return spread(np.add.reduceat(numbers, heads), heads, len(keys)) if len(keys) else numbers
