"""Mixture-controlled packing: deficit round-robin over one token queue per source.

Every source's documents form a queue of tokens. Time runs in tokens drawn from all queues together;
a queue's share of each stretch is its target proportion, and when one runs dry the others go on in
their mutual proportions. ``Mixture`` states how many tokens of each queue are due at any time, so
any task can work out its part alone: the stream is cut into spans, and a span takes what became due
of each queue since the span before, rounded down. The fraction left is the deficit with which the
next span starts. Inside a span, every window of the sequence length adds each queue's share to its
deficit, draws the whole tokens of it, and gives the odd ones to the largest deficits.

Windows lie on the global stream without gaps: only the last sequence can be short.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.tokens import public_path, word_ids
from millrace.llm.workers import give_back
from millrace.scratch import cut_lineage

END_ID = 1
SEQUENCE = 2048
SPAN = 256  # sequences
QUEUES = 256
BROADCAST_ROWS = 200_000  # one per chunk of input and queue, 24 bytes each
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long,"
    " source string"
)


@dataclass
class Mixture:
    """``due[q]`` tokens of queue q are due at ``time``; both rise from 0, piece by piece straight."""

    time: np.ndarray
    due: np.ndarray
    step: int

    @property
    def spans(self) -> int:
        return int(-(-self.time[-1] // self.step))

    def taken(self, queue: int, span: np.ndarray) -> np.ndarray:
        """Tokens of a queue that all spans before ``span`` take."""
        return np.floor(self.exact(queue, span)).astype(np.int64)

    def exact(self, queue: int, span: np.ndarray) -> np.ndarray:
        return self.at(queue, np.asarray(span) * float(self.step))

    def at(self, queue: int, time: np.ndarray) -> np.ndarray:
        return np.interp(time, self.time, self.due[queue])

    def span_of(self, queue: int, position: np.ndarray) -> np.ndarray:
        """The span that takes a queue's token: the last whose start is at or before it."""
        line = self.due[queue]
        rises = np.concatenate(([True], np.diff(line) > 0))
        at = np.interp(position, line[rises], self.time[rises]) // self.step
        span = np.clip(at.astype(np.int64) + 1, 0, self.spans - 1)
        for _ in range(3):
            span = np.where((self.taken(queue, span) > position) & (span > 0), span - 1, span)
        return span


def mixture(totals: list[int], weights: list[float], step: int) -> Mixture:
    """The schedule that draws queues in proportion to ``weights`` until each runs dry.

    Queues of weight 0 follow when all others are dry, in proportion to what they hold.
    """
    left = np.array(totals, dtype=float)
    weight = np.array(weights, dtype=float)
    time, due = [0.0], [np.zeros(len(left))]
    while (left > 0).any():
        active = (left > 0) & (weight > 0)
        share = np.where(active, weight, 0) if active.any() else left
        share = share / share.sum()
        with np.errstate(divide="ignore", invalid="ignore"):
            lasts = np.where(share > 0, left / share, np.inf)
        length = lasts.min()
        drawn = np.where(lasts <= length * (1 + 1e-12), left, share * length)
        left = left - drawn
        time.append(time[-1] + drawn.sum())
        due.append(due[-1] + drawn)
    last = np.array(totals, dtype=float)
    due[-1] = last
    time[-1] = last.sum()
    return Mixture(np.array(time), np.array(due).T, step)


def quotas(sizes: np.ndarray, due: np.ndarray, amounts: np.ndarray, deficit: np.ndarray) -> np.ndarray:
    """Tokens of each queue (columns) in each window (rows), by deficit round-robin.

    ``due`` is what each window adds to the deficits. A window of ``sizes[w]`` tokens takes just that
    many; all windows take just ``amounts``.
    """
    out = np.zeros((len(sizes), len(amounts)), dtype=np.int64)
    left = amounts.astype(np.int64)
    deficit = deficit.astype(float)
    for w, size in enumerate(sizes):
        deficit += due[w]
        take = np.minimum(np.maximum(np.floor(deficit + 1e-9), 0).astype(np.int64), left)
        over = int(take.sum() - size)
        order = np.argsort(-(deficit - take), kind="stable")
        for q in order[::-1] if over > 0 else ():
            cut = min(over, take[q])
            take[q] -= cut
            over -= cut
        while over < 0:
            for q in order:
                if over < 0 and left[q] > take[q]:
                    take[q] += 1
                    over += 1
        out[w] = take
        left -= take
        deficit -= take
    return out


def tokenized(docs: DataFrame, path: str, names: list[str | None], end_id: int) -> DataFrame:
    """Stored rows (doc_id, queue, chunk, at, n, ids): ``at`` tokens of the queue precede in the chunk."""
    number = {name: i for i, name in enumerate(names)}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        encoder, chunk = word_ids(path), TaskContext.get().partitionId()
        drawn = [0] * (len(names) + 1)
        last = np.array([end_id], dtype="<u2").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [x + last for x in encoder.encode(part.column(1).to_pylist())]
                queue = [number.get(s, len(names)) for s in part.column(2).to_pylist()]
                before = []
                for q, x in zip(queue, ids, strict=True):
                    before.append(drawn[q])
                    drawn[q] += len(x) // 2
                yield pa.record_batch(
                    [
                        part.column(0).cast(pa.int64()),
                        pa.array(queue, pa.int32()),
                        pa.array([chunk] * len(ids), pa.int32()),
                        pa.array(before, pa.int64()),
                        pa.array([len(x) // 2 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["doc_id", "queue", "chunk", "at", "n", "ids"],
                )

    schema = "doc_id long, queue int, chunk int, at long, n long, ids binary"
    return cut_lineage(docs.mapInArrow(encode, schema), "tokens")


def pack(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    path: str | None = None,
    sequence: int = SEQUENCE,
    end_id: int = END_ID,
    max_queues: int = QUEUES,
    with_ids: bool = False,
) -> DataFrame:
    """Every document's tokens, with ``end_id`` after them, cut into the pieces of full sequences.

    One row per piece (``PIECES``; ``with_ids`` adds the ids as an array): the document, the tokens
    before the piece, its length and checksum, the document's tokens, and the piece's sequence and
    place there. ``weights`` gives target proportions by source; by default each source's share of
    all tokens, so that all queues end together. The ``max_queues`` sources with most text and all
    that have a weight have a queue each; the others share one, which has the sum of their shares, or
    with ``weights`` none. A null source is a source.

    A null text counts as empty: its document is the end id alone. Null and repeated ids pass
    through. Further input columns are ignored. An empty table gives no rows. Starts jobs that sum
    text sizes by source, store the token ids in the shared folder, and sum them by queue.
    """
    path = path or public_path("word_bpe_49k.json")
    narrow = docs.select("doc_id", "text", F.col("source").cast("string").alias("source"))
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1)
    most = narrow.groupBy("source").agg(size.alias("bytes")).orderBy(F.desc("bytes"), "source")
    names = [row["source"] for row in most.limit(max_queues).collect()]
    names += [name for name in weights or () if name not in names]
    tokens = tokenized(narrow, path, names, end_id)
    sums = tokens.groupBy("queue", "chunk").agg(F.sum("n").alias("drawn"))
    before = Window.partitionBy("queue").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = cut_lineage(
        sums.select("queue", "chunk", F.coalesce(F.sum("drawn").over(before), F.lit(0)).alias("base")),
        "bases",
    )
    if bases.count() <= BROADCAST_ROWS:  # else a shuffled join
        bases = F.broadcast(bases)
    totals = [0] * (len(names) + 1)
    for row in tokens.groupBy("queue").agg(F.sum("n").alias("n")).collect():
        totals[row["queue"]] = row["n"]
    if weights is None:
        target = [float(t) for t in totals]
    else:
        target = [float(weights.get(name, 0.0)) for name in names] + [0.0]
    plan = mixture(totals, target, SPAN * sequence)
    placed = tokens.join(bases, ["queue", "chunk"]).select(
        "doc_id", "queue", (F.col("base") + F.col("at")).alias("position"), "n", "ids"
    )
    cut = placed.mapInArrow(
        _cutter(plan), "span int, queue int, position long, doc_id long, n long, start long, ids binary"
    )
    schema = PIECES + (", ids array<int>" if with_ids else "")
    spans = cut.repartition(max(1, plan.spans), "span")
    return spans.groupBy("span").applyInArrow(_layout(plan, names, sequence, with_ids), schema)


def _cutter(plan: Mixture):
    """Cut documents where one span ends and the next begins."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            queue, at, n = (batch.column(i).to_numpy() for i in (1, 2, 3))
            first, last = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            for q in np.unique(queue):
                own = queue == q
                first[own] = plan.span_of(q, at[own])
                last[own] = plan.span_of(q, at[own] + n[own] - 1)
            rows = []
            ids = batch.column(4)
            for i in range(batch.num_rows):
                data, done = ids[i].as_py(), 0
                for span in range(first[i], last[i] + 1):
                    end = n[i] if span == last[i] else int(plan.taken(queue[i], span + 1)) - at[i]
                    if end > done:
                        rows.append((span, i, at[i] + done, done, data[2 * done : 2 * end]))
                    done = max(done, end)
            if not rows:
                continue
            span, row, position, start, data = zip(*rows, strict=True)
            row = pa.array(row, pa.int64())
            yield pa.record_batch(
                [
                    pa.array(span, pa.int32()),
                    batch.column(1).take(row),
                    pa.array(position, pa.int64()),
                    batch.column(0).take(row),
                    batch.column(3).take(row),
                    pa.array(start, pa.int64()),
                    pa.array(data, pa.binary()),
                ],
                names=["span", "queue", "position", "doc_id", "n", "start", "ids"],
            )

    return cut


def _layout(plan: Mixture, names: list[str | None], sequence: int, with_ids: bool):
    """Place a span's pieces into its windows."""

    def place(table: pa.Table) -> pa.Table:
        give_back()
        table = table.sort_by([("queue", "ascending"), ("position", "ascending")]).combine_chunks()
        span = table["span"][0].as_py()
        queues = np.arange(len(plan.due))
        begun = np.array([plan.taken(q, span) for q in queues], dtype=np.int64)
        amounts = np.array([plan.taken(q, span + 1) for q in queues], dtype=np.int64) - begun
        deficit = np.array([float(plan.exact(q, span)) for q in queues]) - begun
        origin, size = int(begun.sum()), int(amounts.sum())
        inner = np.arange(origin // sequence + 1, -(-(origin + size) // sequence)) * sequence
        edges = np.unique(np.concatenate(([origin], inner, [origin + size])))
        time = np.clip(edges, span * plan.step, (span + 1) * plan.step)
        time[0], time[-1] = span * plan.step, (span + 1) * plan.step
        due = np.diff(np.array([plan.at(q, time) for q in queues]), axis=1).T
        share = quotas(np.diff(edges), due, amounts, deficit)
        ahead = np.cumsum(share, axis=1) - share
        drawn = np.vstack((np.zeros_like(amounts), np.cumsum(share, axis=0)))
        queue, position = table["queue"].to_numpy(), table["position"].to_numpy()
        found = []
        for q in np.unique(queue):
            low, high = np.searchsorted(queue, [q, q + 1])
            starts = position[low:high] - begun[q]
            cuts = np.union1d(starts, drawn[:, q])
            cuts = cuts[cuts < amounts[q]]
            window = np.searchsorted(drawn[:, q], cuts, side="right") - 1
            row = np.searchsorted(starts, cuts, side="right") - 1
            place_of = edges[window] + ahead[window, q] + cuts - drawn[window, q]
            found.append((low + row, cuts - starts[row], np.diff(np.append(cuts, amounts[q])), place_of))
        row, skip, length, at = (np.concatenate(x) for x in zip(*found, strict=True))
        ids = table["ids"].to_pylist()
        pieces = [ids[r][2 * s : 2 * (s + m)] for r, s, m in zip(row, skip, length, strict=True)]
        wide = [np.frombuffer(p, "<u2").astype("<u4") for p in pieces]
        taken = table.select(["doc_id", "n", "start"]).take(pa.array(row))
        columns = {
            "doc_id": taken["doc_id"],
            "start": pa.array(taken["start"].to_numpy() + skip, pa.int64()),
            "length": pa.array(length, pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(w.tobytes()) for w in wide], pa.int64()),
            "doc_tokens": taken["n"],
            "sequence_id": pa.array(at // sequence, pa.int64()),
            "offset": pa.array(at % sequence, pa.int64()),
            "source": pa.array([(*names, None)[q] for q in queue[row]], pa.string()),
        }
        if with_ids:
            columns["ids"] = pa.array([w.astype(np.int32) for w in wide], pa.list_(pa.int32()))
        return pa.table(columns)

    return place
