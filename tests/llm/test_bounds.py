"""No caps: many labels, many weighted sources, vectors of mixed lengths, texts full of tokens; whole queries."""

import collections
import hashlib
import os
import random
import re
import struct
import subprocess
import sys
import time

import numpy as np
from conftest import prose

from millrace.llm import blocks, catalog, hamming, language, packing, recurrent, secrets, substrings
from millrace.llm.tokens import WordIds, public_path

FOLDER = "/root/testdata/sf0.001"


def test_three_hundred_languages_are_all_learnt(spark):
    draw = random.Random(1)
    stems = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3)) for _ in range(300)]
    rows = []
    for n, stem in enumerate(stems):
        for _ in range(12):
            text = " ".join(stem + draw.choice("aeiou") + draw.choice(stem) for _ in range(40))
            rows.append((len(rows), text, f"lang{n}"))
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")
    told = language.predict(docs).collect()
    held = [r for r in told if r.held_out]
    assert len(held) > 600 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95
    assert len({r.lang_pred for r in told}) > 290
    code = language.codewords(300)
    assert code.shape[1] > language.RANDOM_BITS and len(np.unique(code, axis=0)) == 300


def test_every_weighted_source_keeps_its_weight(spark):
    rows = [(i, prose(i, 40 if i % 300 else 4000), f"s{i % 300}") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING")
    weights = {f"s{i}": 1.0 for i in range(300)} | {"s299": 20.0, "absent": 1.0}
    made = packing.pack(docs, weights=weights, max_queues=16).collect()
    first = collections.Counter()
    for r in made:
        if r.sequence_id < 4:
            first[r.source] += r.length
    plain = np.median([n for s, n in first.items() if s != "s299"])
    assert len(first) == 300 and first["s299"] > 8 * plain
    assert sum(r.length for r in made) == sum({r.doc_id: r.doc_tokens for r in made}.values())


def test_vectors_link_within_every_length(spark):
    rng = np.random.default_rng(3)
    rows = []
    for size, n in ((3, 60), (2, 40), (70, 50), (1, 5)):
        x = rng.normal(size=(n, size))
        x[n // 2 :] = x[: n - n // 2] * 3 + rng.normal(0, 0.01, (n - n // 2, size))
        rows += [(len(rows) + i, v.tolist(), "a") for i, v in enumerate(x)]
    rows += [(1000, [1.0, 2.0], "b"), (1001, [1.0, 2.0], "b"), (1002, [1.0, 2.0, 0.0], "b")]
    frame = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>, label STRING")
    found = {r.vec_id: r for r in hamming.near_vectors(frame).collect()}
    near = collections.Counter()
    for i, v, label in rows:
        for j, w, other in rows:
            if i != j and label == other and len(v) == len(w):
                near[i] += np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w) >= 0.98
    missed = sum(near[i] - found[i].n_links for i, *_ in rows)
    assert all(found[i].n_links <= near[i] for i, *_ in rows) and missed <= 0.03 * sum(near.values())
    assert found[1001].component_id == 1000 and found[1002].n_links == 0


def test_a_long_text_of_tokens_takes_linear_time(spark):
    line = hashlib.sha256(b"x").hexdigest().upper()[:40]
    table = np.full(secrets.SYMBOLS**2, 2.0)
    took = []
    for n in (10_000, 40_000):
        text = " ".join([line] * n) + " é " + line
        began = time.perf_counter()
        spans = secrets.token_spans([text], table)[0]
        kept = secrets.outside(spans, [(s, 2, e) for s, e in spans[::2]])
        took.append(time.perf_counter() - began)
        assert len(spans) == n + 1 and text[slice(*spans[-1])] == line and len(kept) == (n + 1) // 2
    assert took[1] < 12 * took[0] + 1


def test_a_token_around_a_pattern_span_is_kept_whole():
    inner = "0123456789abcdef01234567"
    assert secrets.outside([(0, 40)], [(6, 2, 30)]) == [(0, 40)]
    assert secrets.outside([(6, 30), (50, 70)], [(0, 0, 30), (40, 0, 60)]) == [(50, 70)]
    text = f"Zq9xW{inner}Kp7RtYu2"
    assert secrets.masked(text, [(0, 3, len(text)), (5, 2, 29)]) == "<secret>"


def test_secret_query_equals_brute_force(spark):
    kinds = (
        ("assign", re.compile("(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A), lambda m: len(m[2]) >= 6),
        ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
        ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
    )
    folder = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in catalog.QUERIES["op2_secret_scan"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(rows) == len(docs)
    seen = 0
    for d in docs:
        found = sorted(
            (m.start(), k, m.end()) for k, (_, pattern, ok) in enumerate(kinds) for m in pattern.finditer(d.text or "") if ok(m)
        )
        told = ",".join(f"{kinds[k][0]}:{a}:{b}" for a, k, b in found)
        r = rows[d.doc_id]
        counts = [sum(k == kind for _, k, _ in found) for kind in range(3)]
        assert [r.n_assign, r.n_access, r.n_hex] == counts
        assert r.base_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert set(filter(None, told.split(","))) <= set(r.spans.split(","))
        seen += len(found)
    assert seen > 0


def test_bpe_query_equals_the_library(spark):
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(public_path("byte_bpe_50k.json"))
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for r in catalog.QUERIES["op3_bpe"](spark, FOLDER).collect():
        ids = tool.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        back = tool.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def least_time(run, times=5):
    def once():
        began = time.process_time()
        run()
        return time.process_time() - began

    return min(once() for _ in range(times))


def test_a_block_lists_its_distinct_runs_at_the_cost_of_a_sort():
    hashes = np.random.default_rng(4).integers(0, 1 << 63, 500_000).astype(np.uint64)
    hashes[::7] = hashes[3]
    keys = np.sort(hashes)
    keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))]
    drop = np.uint64(20)
    short, place = np.unique(keys >> drop, return_inverse=True)
    answers = np.arange(len(short)) % 3
    assert (substrings._asked(keys, drop, answers) == (answers > 1)[place]).all()
    assert least_time(lambda: substrings._asked(keys, drop, answers)) < 2 * least_time(lambda: np.sort(hashes))


def test_first_places_are_those_of_the_smallest_document():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 4000):
        keys, docs = rng.integers(0, 900, n).astype(np.uint64), rng.integers(0, 5, n)
        places = np.stack((docs, np.arange(n)))
        found, first, number = substrings._first_places(keys, places)
        least = {}
        for key, doc, at in zip(keys.tolist(), *places.tolist(), strict=True):
            least[key] = min(least.get(key, (doc, at)), (doc, at))
        assert found.tolist() == sorted(least)
        assert first.T.tolist() == [list(least[k]) for k in sorted(least)]
        assert (found[number] == keys).all()


def test_a_worker_holds_a_bounded_store_of_pieces():
    tool = WordIds(public_path("word_bpe_49k.json"))
    words = ["".join(chr(97 + n // 26**k % 26) for k in range(4)) for n in range(250_000)]
    texts = [" the ".join(words[at : at + 5000]) for at in range(0, len(words), 5000)]
    made = tool.encode(texts)
    assert 100_000 <= len(tool.known) <= 200_000 + 1 and "the" in tool.known
    assert made[:2] == tool.encode(texts[:2]) == [tool.whole(t) for t in texts[:2]]


MEMORY = """
import re, sys
import numpy as np, pyarrow as pa
from millrace.llm import blocks, language, packing, secrets, substrings  # what a worker has loaded
from millrace.llm.words import Words

def held():
    text = open("/proc/self/smaps_rollup").read()
    return sum(map(int, re.findall(r"\\nPss_(?:Anon|Shmem):\\s+(\\d+)", text))) / 1024

def block(n):
    texts = pa.array([" ".join(f"w{n * 700 + i}x{j}" for j in range(450)) for i in range(700)])
    table = pa.table({"doc_id": pa.array(range(700), pa.int64()), "text": texts})
    words, _, hashes, places = substrings._runs(table, "doc_id", "text", 13)
    substrings._first_places(hashes, places)
    kept = substrings._kept(words, np.zeros(len(words.start), bool))
    return pa.array([k.decode() for k in kept])

before = held()
for n in range(3):
    block(n)
after = held()
if hasattr(blocks, "give_back"):
    blocks.give_back()
print(before, after, held())
"""


def test_a_worker_gives_back_what_a_block_used():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    told = subprocess.run([sys.executable, "-c", MEMORY], cwd=root, capture_output=True, text=True, check=True).stdout
    before, after, left = map(float, told.split())
    assert left - before < 0.75 * (after - before)


def test_a_block_numbers_its_words_at_the_cost_of_a_few_sorts():
    keys = np.random.default_rng(6).integers(0, 1 << 63, 400_000).astype(np.uint64)
    keys[::3] = keys[5]
    found, number = blocks.numbered(keys)
    plain, place = np.unique(keys, return_inverse=True)
    assert (found == plain).all() and (number == place).all()
    assert least_time(lambda: blocks.numbered(keys)) < 15 * least_time(lambda: np.sort(keys))


def test_updates_are_adams_and_take_no_fresh_arrays(monkeypatch):
    lexicon = recurrent.Lexicon(np.arange(1, 4001, dtype=np.uint64), np.arange(4000, 0, -1), 200, 9_000_000, 13_000)
    p, rng = recurrent.initial(lexicon), np.random.default_rng(7)
    given = [{k: rng.normal(0, 1e-3, v.shape).astype(np.float32) for k, v in p.items()} for _ in range(2)]
    given[1]["state"][:] = 1  # beyond the bound of the norm
    stream = np.full(recurrent.WINDOW * 40 + 1, 5)
    asked = []

    def gradients(p, lexicon, tokens, target, h, real):
        asked.append(len(asked) % 2)
        return {k: v.copy() for k, v in given[asked[-1]].items()}, h, 0.0

    def plain():
        q = {k: v.copy() for k, v in p.items()}
        first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
        for update in range(1, 41):
            d, _, _ = gradients(q, lexicon, None, None, None, None)
            norm = np.sqrt(sum(float((v * v).sum()) for v in d.values()))
            for k, v in d.items():
                v = v * np.float32(min(1.0, 5.0 / norm))
                first[k] = first[k] + np.float32(0.1) * (v - first[k])
                second[k] = second[k] + np.float32(0.01) * (v * v - second[k])
                m, s = first[k] / (1 - 0.9**update), second[k] / (1 - 0.99**update)
                q[k] = q[k] - np.float32(0.01) * (m / (np.sqrt(s) + np.float32(1e-8)))
        return q

    monkeypatch.setattr(recurrent, "gradients", gradients)
    mine, other = recurrent.learn(p, lexicon, stream, 0.01), plain()
    assert len(asked) == 80
    assert all(np.allclose(mine[k], other[k], rtol=1e-4, atol=1e-5) for k in p)
    assert least_time(lambda: recurrent.learn(p, lexicon, stream, 0.01)) < 0.8 * least_time(plain)


def test_shares_far_from_a_floats_bounds():
    for low, high in ((-1, 1), (-200, -150), (150, 200), (-300, 300)):
        logits = np.random.default_rng(8).uniform(low, high, (50, 66)).astype(np.float32)
        exact = np.logaddexp.reduce(logits.astype(np.float64), axis=1)
        shares, total, log_total = recurrent._exponentials(logits)
        assert np.allclose(log_total, exact, rtol=1e-5)
        assert np.allclose(shares / total[:, None], np.exp(logits - exact[:, None]), atol=1e-4)
