"""Language-model scores: a gated recurrent network beside smoothed word counts.

Word counts cover all training documents and are summed through the block exchange. The network
knows the ``VOCABULARY`` most frequent words; any other word is first predicted as "other", then by its
smoothed share among the others' counts, so the model is a distribution over the same tokens as the
counts. The softmax is factored into classes of words of like frequency. Output biases start at the
word frequencies; the network learns from every training document once, by backpropagation truncated to
windows. Documents are dealt to rounds, and in a round to trainers, as many as its bytes ask for: they
learn apart from the same weights, each on all of its documents, and their weights are averaged.

A document is scored whole: windows follow one another with the state carried over.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import blocks as B
from millrace.llm.words import Words
from millrace.scratch import cut_lineage

VOCABULARY = 4096
CLASS = 64  # words per class
HIDDEN = 16
ROUNDS = 3
TRAINER_BYTES = 16 << 20  # of texts for a trainer in a round, about
FAN = 16  # weights averaged at a time
LANES, WINDOW = 256, 32  # lanes at most
UPDATES = 100  # a short stream has fewer lanes, for as many updates
RATE = 0.012
SCORED = 40_000  # tokens scored at a time, about
ADD = 0.1
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
Params = dict[str, np.ndarray]


def learnt_fold(id_col: str = "doc_id") -> Column:
    """Nine tenths of the documents, by their id."""
    return F.crc32(F.col(id_col).cast("string")) % 10 != 0


class Lexicon:
    """The network's words by falling count. Ids: words, then "other", then the end."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, ends: int, total: int, distinct: int):
        self.size = len(hashes)
        order = np.argsort(hashes)
        self.sorted, self.ids = hashes[order], order.astype(np.int32)
        self.other, self.end = self.size, self.size + 1
        self.total, self.distinct = total, distinct
        known = int(counts.sum()) + ends
        rest = self.size + (ends > 0)
        self.other_total, self.other_distinct = total - known, max(0, distinct - rest)
        self.classes = -(-self.size // CLASS)
        self.mass = np.concatenate((counts, [max(1, self.other_total), max(1, ends)])).astype(float)

    def look_up(self, hashes: np.ndarray) -> np.ndarray:
        if not self.size:
            return np.full(len(hashes), self.other, dtype=np.int32)
        at = np.minimum(np.searchsorted(self.sorted, hashes), self.size - 1)
        return np.where(self.sorted[at] == hashes, self.ids[at], self.other).astype(np.int32)

    def class_of(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids >= self.size, self.classes + ids - self.size, ids // CLASS)


def initial(lexicon: Lexicon, seed: int = 3) -> Params:
    rng = np.random.default_rng(seed)
    groups, size = lexicon.classes, lexicon.size
    mass = np.zeros(groups * CLASS)
    mass[:size] = lexicon.mass[:size]
    inner = mass.reshape(groups, CLASS)
    with np.errstate(divide="ignore"):
        word_bias = np.where(inner > 0, np.log(inner / np.maximum(1, inner.sum(axis=1, keepdims=True))), -1e9)
    class_mass = np.concatenate((inner.sum(axis=1), lexicon.mass[size:]))
    normal = lambda *shape: rng.normal(0, 0.15, shape)
    params = {
        "input": normal(size + 2, 3 * HIDDEN),
        "state": normal(HIDDEN, 3 * HIDDEN),
        "gate": np.zeros(3 * HIDDEN),
        "class": normal(HIDDEN, groups + 2) * 0.1,
        "class_bias": np.log(class_mass / class_mass.sum()),
        "word": normal(groups, HIDDEN, CLASS) * 0.1,
        "word_bias": word_bias,
    }
    return {k: v.astype(np.float32) for k, v in params.items()}


def _gates(table: np.ndarray) -> np.ndarray:
    """The columns of the update gate, the reset gate and the candidate as arrays of their own, the gates' negative."""
    parts = np.stack([table[:, k * HIDDEN : (k + 1) * HIDDEN] for k in range(3)])
    np.negative(parts[:2], parts[:2])
    return parts


def _open(gates: np.ndarray, x: np.ndarray) -> None:
    """Update and reset gates out of the state's and the token's part, in place."""
    gates += x
    np.exp(gates, gates)
    gates += 1
    np.reciprocal(gates, gates)


def _next_state(weights: np.ndarray, x: np.ndarray, h: np.ndarray, room: np.ndarray, out: np.ndarray) -> np.ndarray:
    """The state one token on, written to ``out``; ``weights`` and ``x``, the tokens' inputs with bias, as of ``_gates``."""
    np.matmul(h, weights, out=room)
    _open(room[:2], x[:2])
    c = room[2]
    c *= room[1]
    c += x[2]
    np.tanh(c, c)
    np.subtract(h, c, out)
    out *= room[0]
    out += c
    return out


def _exponentials(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exponentials over each row's common factor, their sums, and the log of sum times factor."""
    ones = np.ones(logits.shape[1], logits.dtype)
    with np.errstate(over="ignore"):
        shares = np.exp(logits)
        total = shares @ ones
    if not len(total) or (total.min() > 1e-30 and total.max() < 1e30):  # far from a float's bounds
        return shares, total, np.log(total)
    top = logits.max(axis=1, keepdims=True)
    shares = np.exp(logits - top)
    total = shares @ ones
    return shares, total, np.log(total) + top[:, 0]


def _log_total(logits: np.ndarray) -> np.ndarray:
    """Log of each row's sum of exponentials."""
    return _exponentials(logits)[2]


def _slopes(logits: np.ndarray, own: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, float]:
    """Gradients of the logits of the log loss, each row times its scale, and the loss; ``own`` are the targets."""
    shares, total, _ = _exponentials(logits)
    rows = np.arange(len(own))
    loss = -(scale * np.log(np.maximum(shares[rows, own] / total, 1e-30))).sum()
    shares *= (scale / total)[:, None]
    shares[rows, own] -= scale
    return shares, float(loss)


def _by_class(classes: np.ndarray, n: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Rows of word classes in class order, and where those of each class that has any stand."""
    order = np.argsort(classes, kind="stable")
    edges = np.searchsorted(classes[order], np.arange(n + 1)).tolist()
    return order[: edges[-1]], [(k, edges[k], edges[k + 1]) for k in range(n) if edges[k + 1] > edges[k]]


def log_shares(p: Params, lexicon: Lexicon, h: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural log of each target's probability after state ``h``."""
    classes = lexicon.class_of(target)
    out = np.empty(len(h))
    for at in range(0, len(h), 4096):  # what fits a core's cache
        part = slice(at, at + 4096)
        logits = h[part] @ p["class"]
        logits += p["class_bias"]
        out[part] = logits[np.arange(len(logits)), classes[part]] - _log_total(logits)
    at, edges = _by_class(classes, lexicon.classes)
    own, place = h[at], target[at] % CLASS
    for c, low, high in edges:
        logits = own[low:high] @ p["word"][c]
        logits += p["word_bias"][c]
        out[at[low:high]] += logits[np.arange(high - low), place[low:high]] - _log_total(logits)
    return out


def gradients(
    p: Params, lexicon: Lexicon, tokens: np.ndarray, target: np.ndarray, h: np.ndarray, real: np.ndarray | None = None
) -> tuple[Params, np.ndarray, float]:
    """Of the mean log loss of a window (time x lanes); the state after it; the loss.

    ``real`` tells which targets count, by default all.
    """
    n, steps, lanes = HIDDEN, *tokens.shape
    kind, groups = p["state"].dtype, lexicon.classes
    keep = (tokens != lexicon.end).astype(kind)[:, :, None]  # a document starts from an empty state
    tables, weights = _gates(p["input"] + p["gate"]), _gates(p["state"])
    x = np.stack([table[tokens] for table in tables], axis=1)
    gates = np.empty((steps, 2, lanes, n), kind)
    before, opened, c, apart, after = (np.empty((steps, lanes, n), kind) for _ in range(5))
    for t in range(steps):
        np.multiply(h, keep[t], before[t])
        np.matmul(before[t], weights[:2], out=gates[t])
        _open(gates[t], x[t, :2])
        np.matmul(before[t], weights[2], out=opened[t])
        opened[t] *= gates[t, 1]
        np.add(opened[t], x[t, 2], c[t])
        np.tanh(c[t], c[t])
        np.subtract(before[t], c[t], apart[t])
        np.multiply(apart[t], gates[t, 0], after[t])
        after[t] += c[t]
        h = after[t]
    z, r = gates[:, 0], gates[:, 1]
    flat = target.ravel()
    every = np.ones((len(flat), n + 1), kind)  # the last column takes the bias
    every[:, :n] = after.reshape(-1, n)
    counted = np.ones(len(flat), kind) if real is None else real.ravel().astype(kind)
    classes, scale = lexicon.class_of(flat), counted / counted.sum()
    d = {}
    share, loss = _slopes(every @ np.vstack((p["class"], p["class_bias"])), classes, scale)
    both = every.T @ share
    d["class"], d["class_bias"] = both[:n], both[n]
    d_state = share @ p["class"].T
    at, edges = _by_class(classes, groups)
    own, mine = every[at], np.empty((len(at), CLASS), kind)
    words = np.concatenate((p["word"], p["word_bias"][:, None]), axis=1)
    for k, low, high in edges:
        np.matmul(own[low:high], words[k], out=mine[low:high])
    share, more = _slopes(mine, flat[at] % CLASS, scale[at])
    d_words, d_own = np.zeros_like(words), np.empty((len(at), n), kind)
    for k, low, high in edges:
        np.matmul(own[low:high].T, share[low:high], out=d_words[k])
        np.matmul(share[low:high], p["word"][k].T, out=d_own[low:high])
    d["word"], d["word_bias"] = np.ascontiguousarray(d_words[:, :n]), np.ascontiguousarray(d_words[:, n])
    d_state[at] += d_own
    d_state = d_state.reshape(steps, lanes, n)
    to_c = (1 - z) * (1 - c * c)
    to_z = apart * z * (1 - z)
    to_r = opened * (1 - r)
    later, back = np.zeros((lanes, n), kind), np.ascontiguousarray(p["state"].T)
    d_g, d_c = np.empty((steps, lanes, 3 * n), kind), np.empty((steps, lanes, n), kind)
    for t in range(steps - 1, -1, -1):
        dh = d_state[t]
        dh += later
        np.multiply(dh, to_c[t], d_c[t])
        np.multiply(dh, to_z[t], d_g[t, :, :n])
        np.multiply(d_c[t], to_r[t], d_g[t, :, n : 2 * n])
        np.multiply(d_c[t], r[t], d_g[t, :, 2 * n :])
        np.matmul(d_g[t], back, out=later)
        dh *= z[t]
        later += dh
        later *= keep[t]
    flat_inputs = d_g.reshape(-1, 3 * n)
    d["state"] = before.reshape(-1, n).T @ flat_inputs
    d_g[:, :, 2 * n :] = d_c
    d["gate"] = np.ones(len(flat), kind) @ flat_inputs
    order = np.argsort(tokens, axis=None, kind="stable")
    met = tokens.ravel()[order]
    heads = B.group_heads(met)
    d["input"] = np.zeros_like(p["input"])
    d["input"][met[heads]] = np.add.reduceat(flat_inputs[order], heads, axis=0)
    return d, h, loss + more


def learn(p: Params, lexicon: Lexicon, stream: np.ndarray, rate: float) -> Params:
    """One pass of Adam over a whole stream of documents, each followed by the end, in parallel lanes."""
    p = {k: v.copy() for k, v in p.items()}
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    spare = {k: np.empty_like(v) for k, v in p.items()}
    n = len(stream) - 1
    if n < 1:
        return p
    lanes = min(LANES, max(1, n // (WINDOW * UPDATES)))
    length = -(-n // lanes)
    filled = np.concatenate((stream, np.full(lanes * length - n, lexicon.end, stream.dtype)))
    tokens = filled[:-1].reshape(lanes, length).T
    target = filled[1:].reshape(lanes, length).T
    real = (np.arange(lanes * length) < n).reshape(lanes, length).T
    h = np.zeros((lanes, HIDDEN), np.float32)
    for update, at in enumerate(range(0, length, WINDOW), 1):
        part = slice(at, at + WINDOW)
        d, h, _ = gradients(p, lexicon, tokens[part], target[part], h, real[part])
        norm = np.sqrt(sum(float(np.vdot(v, v)) for v in d.values()))
        shrink, even = min(1.0, 5.0 / (norm + 1e-9)), (1 - 0.99**update) ** -0.5
        for k, v in d.items():
            room = spare[k]
            v *= shrink
            np.subtract(v, first[k], room)
            room *= 0.1
            first[k] += room
            v *= v
            v -= second[k]
            v *= 0.01
            second[k] += v
            np.sqrt(second[k], room)
            room *= even
            room += 1e-8
            np.divide(first[k], room, room)
            room *= rate / (1 - 0.9**update)
            p[k] -= room
    return p


def score_texts(p: Params, lexicon: Lexicon, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Natural log probability of each text; ``ids`` of all texts, each closed by the end."""
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    begin, length = first[:-1][order], length[order]
    total = np.zeros(len(order))
    h = np.zeros((len(order), HIDDEN), np.float32)
    tables, weights = _gates(p["input"] + p["gate"]), _gates(p["state"])
    room = np.empty((3, *h.shape), np.float32)
    steps = int(length[0]) if len(length) else 0
    live = len(order) - np.searchsorted(length[::-1], np.arange(steps), side="right")
    edges = np.concatenate(([0], np.cumsum(live)))  # all first tokens, all second ones, and so on
    at = 0
    while at < steps:
        to = max(at + 1, int(np.searchsorted(edges, edges[at] + SCORED, side="right")) - 1)
        near = edges[at : to + 1] - edges[at]
        step = np.repeat(np.arange(at, to), live[at:to])
        row = np.arange(near[-1]) - np.repeat(near[:-1], live[at:to])
        place = begin[row] + step
        before = np.where(step > 0, ids[place - 1], lexicon.end)
        x = np.take(tables, before, axis=1)
        states = np.empty((len(place), HIDDEN), np.float32)
        bounds = near.tolist()
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            n = high - low
            h = _next_state(weights, x[:, low:high], h[:n], room[:, :n], states[low:high])
        total += np.bincount(row, weights=log_shares(p, lexicon, states, ids[place]), minlength=len(total))
        at = to
    out = np.empty(len(order))
    out[order] = total
    return out


def _token_ids(lexicon: Lexicon, words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Network ids of all texts with the end after each, and where each text starts."""
    first = words.first + np.arange(len(words.first))
    ids = np.full(first[-1], lexicon.end, dtype=np.int32)
    ids[np.arange(len(hashes)) + words.text_of] = lexicon.look_up(hashes)
    return ids, first


def _train_counts(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words of a block, sorted, and how often its training texts have each."""
    words = Words(table["text"], lower=True)
    learnt = table["learnt"].to_numpy()[words.text_of].astype(np.int64)
    hashes = words.hashes()
    keys, place = B.numbered(hashes)
    return keys, np.bincount(place, weights=learnt, minlength=len(keys)).astype(np.int64)


def _frequent(table: pa.Table) -> pa.Table:
    """A bucket's most frequent words, then one row with its tokens and distinct words."""
    keys, numbers, _ = B.opened(table)
    order = np.argsort(keys, kind="stable")
    keys, numbers = keys[order], numbers[order]
    heads = B.group_heads(keys)
    sums = np.add.reduceat(numbers, heads) if len(keys) else numbers
    keys = keys[heads]
    top = np.lexsort((keys, -sums))[:VOCABULARY]
    top = top[sums[top] > 0]
    return pa.table(
        {
            "word": pa.array([*keys[top].view(np.int64).tolist(), None], pa.int64()),
            "n": pa.array([*sums[top].tolist(), int(sums.sum())], pa.int64()),
            "seen": pa.array([None] * len(top) + [int((sums > 0).sum())], pa.int64()),
        }
    )


def _trainer(sent: Broadcast, rate: float) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        lexicon, weights = sent.value
        words = Words(table.sort_by([("draw", "ascending"), ("text", "ascending")])["text"], lower=True)
        ids, _ = _token_ids(lexicon, words, words.hashes())
        after = learn(weights, lexicon, np.concatenate(([lexicon.end], ids)), rate)
        return _told(table["trainer"][0].as_py(), 1, after)

    return run


def _told(trainer: int, n: int, weights: Params) -> pa.Table:
    return pa.table(
        {
            "trainer": pa.array([trainer], pa.int64()),
            "n": pa.array([n], pa.int64()),
            "weights": pa.array([pickle.dumps(weights)], pa.binary()),
        }
    )


def _mean(counts: list[int], found: list[bytes]) -> Params:
    """The mean of weights that are means of so many trainers' each."""
    summed: Params = {}
    for n, packed in zip(counts, found, strict=True):
        for k, v in pickle.loads(packed).items():
            summed[k] = summed.get(k, 0) + v.astype(np.float64) * n
    return {k: (v / sum(counts)).astype(np.float32) for k, v in summed.items()}


def _averaged(table: pa.Table) -> pa.Table:
    """The weights of a group of trainers as one row."""
    counts = table["n"].to_pylist()
    return _told(table["trainer"][0].as_py(), sum(counts), _mean(counts, table["weights"].to_pylist()))


def _trained(lexicon: Lexicon, fold: DataFrame, trainers: int) -> Params:
    """Rounds of learning apart and averaging, each on its own part of ``fold``. Weights (about 2 MB) go out and come back.

    They are averaged by ``FAN`` at a time in the executors until so many are left for the driver.
    """
    context = fold.sparkSession.sparkContext
    params = initial(lexicon)
    for turn in range(ROUNDS):
        sent = context.broadcast((lexicon, params))
        run = _trainer(sent, RATE * 0.5**turn)
        schema = "trainer long, n long, weights binary"
        part = fold.where(F.col("round") == turn).drop("round").repartition(trainers, "trainer")
        told, groups = part.groupBy("trainer").applyInArrow(run, schema), trainers
        while groups > FAN:
            groups = -(-groups // FAN)
            told = told.withColumn("trainer", F.pmod("trainer", F.lit(groups)))
            told = told.groupBy("trainer").applyInArrow(_averaged, schema)
        found = told.collect()
        if found:
            params = _mean([row["n"] for row in found], [row["weights"] for row in found])
        sent.unpersist()
    return params


def scores(docs: DataFrame, learnt: Column | None = None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row (``SCORES``): tokens, those known from training, and two log10 probabilities.

    Tokens are a text's words, A to Z lower-cased, then the end. ``learnt`` marks training rows (by
    default ``learnt_fold``); held_out is its opposite; where it is null the row is neither.
    base_score adds ``ADD`` to every count; score is the network's. A null text counts as empty: the
    end alone. Null and repeated ids pass through, further columns are ignored, and an empty table
    gives no rows. Without training rows nothing is known and every base_score is 0.

    Jobs before the result: text sizes are summed, word counts stored in the shared folder, the most
    frequent words collected (at most ``VOCABULARY``), and ``ROUNDS`` rounds of training run, each on its
    share of all training documents.
    """
    fold = learnt_fold(id_col) if learnt is None else learnt
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text).alias("text"),
        F.coalesce(~fold, F.lit(False)).alias("held_out"),
        F.coalesce(fold, F.lit(False)).alias("learnt"),
    )
    size = narrow.agg(
        F.sum(F.octet_length("text").cast("long")).alias("total"),
        F.sum(F.col("learnt").cast("long")).alias("ends"),
        F.sum(F.when(F.col("learnt"), F.octet_length("text").cast("long"))).alias("learnt"),
    ).first()
    total, ends = size["total"] or 0, size["ends"] or 0
    blocks = B.dealt(narrow, total, "doc_id", "text")
    pieces = B.pieces_of(blocks, total, _train_counts, keep=lambda level: cut_lineage(level, "word-counts"))
    frequent = cut_lineage(
        pieces[-1].groupBy("bucket").applyInArrow(_frequent, "word long, n long, seen long"), "frequent"
    )
    summed = frequent.where("word is null").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen")).first()
    n_words, seen = summed["n"] or 0, summed["seen"] or 0
    top = frequent.where("word is not null").orderBy(F.desc("n"), "word").limit(VOCABULARY).collect()
    lexicon = Lexicon(
        np.array([r["word"] for r in top], dtype=np.int64).view(np.uint64),
        np.array([r["n"] for r in top], dtype=np.int64),
        ends,
        n_words + ends,
        seen + (ends > 0),
    )
    trainers = max(1, -(-(size["learnt"] or 0) // (ROUNDS * TRAINER_BYTES)))
    draw = F.xxhash64("doc_id", "text", F.lit("deal"))
    dealt = narrow.where("learnt").select(
        "text",
        draw.alias("draw"),
        F.pmod(draw, F.lit(ROUNDS)).alias("round"),
        F.pmod(F.xxhash64(draw, F.spark_partition_id()), F.lit(trainers)).alias("trainer"),
    )
    params = _trained(lexicon, dealt, trainers)
    sent = docs.sparkSession.sparkContext.broadcast((lexicon, params))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        known, weights = sent.value
        words = Words(left["text"], lower=True)
        hashes = words.hashes()
        counts = B.answers_of(right)[B.numbered(hashes)[1]] if len(hashes) else np.zeros(0)
        base = known.total + ADD * (known.distinct + 1)
        edges = words.first

        def by_text(values: np.ndarray) -> np.ndarray:
            return np.diff(np.concatenate(([0.0], np.cumsum(values)))[edges])

        ids, first = _token_ids(known, words, hashes)
        other = known.other_total + ADD * (known.other_distinct + 1)
        outside = ids[np.arange(len(hashes)) + words.text_of] == known.other
        rare = np.where(outside, np.log10(np.where(outside, counts, 0) + ADD) - np.log10(other), 0)
        table = {
            "doc_id": left["doc_id"],
            "held_out": left["held_out"],
            "n_tokens": pa.array(np.diff(edges) + 1, pa.int64()),
            "n_known": pa.array(by_text(counts > 0).astype(np.int64) + (ends > 0), pa.int64()),
            "train_tokens": pa.array([known.total] * left.num_rows, pa.int64()),
            "base_score": pa.array(
                by_text(np.log10(counts + ADD) - np.log10(base)) + np.log10(ends + ADD) - np.log10(base), pa.float64()
            ),
            "score": pa.array(score_texts(weights, known, ids, first) / np.log(10) + by_text(rare), pa.float64()),
        }
        return pa.table(table)

    answers = B.answered(pieces, total, B.sum_by_key)
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, SCORES)
