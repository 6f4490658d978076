"""Operators on texts: brute force, round trips, and odd tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from conftest import prose

from millrace.llm import blocks, bpe, language, neardup, packing, recurrent, secrets, sharding, substrings
from millrace.llm.tokens import library, public_path, word_ids

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, texts, **columns):
    rows = [(i, t, columns.get("lang", {}).get(i), columns.get("source", {}).get(i, "s")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING")


def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


# Substring dedup


def removed_by_brute_force(docs, window=13):
    words = {d: WORD.findall(t or "") for d, t in docs}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][i : i + window]), d)
    out = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[d] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def test_substrings_equal_brute_force(spark):
    passage = prose(9, 20)
    texts = [prose(i, 60) + " " + passage * (i % 2) + "\n" + prose(i // 3, 30) for i in range(60)]
    texts += [prose(100, 12), prose(100, 12), prose(101, 13), prose(101, 13), "a " * 40, "a\ta\x0ba " * 15]
    docs = table(spark, texts)
    results = ("n_words", "n_removed", "kept_sha256", "kept_text", "factors")
    found = {r.doc_id: r for r in substrings.remove_repeats(docs, results=results).collect()}
    for d, wanted in removed_by_brute_force(list(enumerate(texts))).items():
        r = found[d]
        assert (r.n_words, r.n_removed, r.kept_sha256) == wanted
        covered = set()
        for f in r.factors:
            assert f.length >= 13 and f.source < d
            covered |= set(range(f.start, f.start + f.length))
            source = WORD.findall(texts[f.source])[f.source_start : f.source_start + f.length]
            assert source == WORD.findall(texts[d])[f.start : f.start + f.length]
        assert len(covered) == r.n_removed
        if not r.n_removed:
            assert r.kept_text == texts[d]


def test_substrings_over_many_blocks_and_levels_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 1_500)
    monkeypatch.setattr(blocks, "FAN", 6)
    shared = [prose(900 + i, 18) for i in range(4)]
    texts = [f"{prose(i, 40)} {shared[i % 4]} {prose(i % 11, 25)} {shared[i % 3]}" for i in range(50)]
    results = ("n_words", "n_removed", "kept_sha256")
    rows = substrings.remove_repeats(table(spark, texts).repartition(4), results=results).collect()
    assert {r.doc_id: tuple(r[c] for c in results) for r in rows} == removed_by_brute_force(list(enumerate(texts)))


def test_factors_are_copies_of_their_sources(spark):
    w = [f"w{i}" for i in range(14)]
    texts = [
        " ".join([*w[:13], "X", *w[1:]]),  # both runs of the last text, not next to each other
        " ".join(["in", "front", *(f"v{i}" for i in range(40))]),
        " ".join(f"v{i}" for i in range(20)) + " between " + " ".join(f"v{i}" for i in range(20, 40)),
        " ".join(w),
    ]
    rows = substrings.remove_repeats(table(spark, texts)).orderBy("doc_id").collect()
    assert [[tuple(f) for f in r.factors] for r in rows] == [
        [],
        [],
        [(0, 20, 1, 2), (21, 20, 1, 22)],
        [(0, 13, 0, 0), (1, 13, 0, 14)],
    ]
    assert [r.kept_text for r in rows[2:]] == ["between", ""]


def test_copies_of_one_row_are_dealt_into_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 2_000)
    docs = spark.createDataFrame([(1, "the very same row")] * 4_000, "doc_id BIGINT, text STRING").repartition(8)
    dealt = blocks.dealt(docs, blocks.text_bytes(docs), "doc_id", "text")
    assert dealt.count() == 4_000 and dealt.select("block").distinct().count() >= 5


def test_substrings_of_odd_tables(odd_documents, no_documents):
    rows = substrings.remove_repeats(odd_documents).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert len(rows) == odd_documents.count()
    assert [r.n_removed for r in by[5]] == [80, 80] and by[1][0].n_removed == 0
    assert by[None][0].n_removed == 80 and by[None][0].kept_text == ""
    assert by[6][0].kept_text == "extra" and by[2][0].kept_text is None and by[3][0].kept_text == ""
    assert by[4][0].n_words == 60_002 and "score" in rows[0] and "block" not in rows[0]
    assert substrings.remove_repeats(no_documents).count() == 0


# Secrets


def test_pattern_spans():
    text = 'x PassWord = "abc123" token:ab AKIA' + "A" * 16 + " api_key=" + "0" * 24 + " secret=secret=longer"
    spans = [(secrets.KINDS[k], text[s:e]) for s, k, e, *_ in secrets.base_spans(text)]
    assert spans == [
        ("assign", 'PassWord = "abc123'),
        ("access", "AKIA" + "A" * 16),
        ("assign", "api_key=" + "0" * 24),
        ("hex", "0" * 24),
        ("assign", "secret=secret=longer"),
    ]


def test_random_tokens_are_told_from_words(spark):
    draw = random.Random(4)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    secret = lambda n: "".join(draw.choice(letters) for _ in range(n))
    plain = [r.text for r in documents(spark).select("text").collect()]
    learnt = [p + f" token = {secret(32)}" for p in plain]
    names = [f"get_the_{w}_of_item{i}" for i, w in enumerate("value length number address customer".split() * 8)]
    held_out = [("seen " + secret(32) + " there", True) for _ in range(12)] + [(n, False) for n in names]
    docs = table(spark, learnt + [t for t, _ in held_out])
    rows = {r.doc_id: r for r in secrets.scan(docs, mask=True).collect()}
    right = sum(("markov" in rows[len(learnt) + i].spans) == is_secret for i, (_, is_secret) in enumerate(held_out))
    assert right >= 0.95 * len(held_out)
    first = rows[len(learnt)]
    assert first.spans == "markov:5:37" and first.masked == "seen <secret> there"


def test_secrets_of_odd_tables(odd_documents, no_documents):
    rows = secrets.scan(odd_documents, mask=True).collect()
    assert len(rows) == odd_documents.count()
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r.base_sha256 == empty and r.n_spans == 0 for r in rows)
    assert {r.doc_id: r.masked for r in rows}[2] is None
    assert secrets.scan(no_documents).count() == 0


# Byte-pair encoding


def test_bpe_equals_the_library_and_returns():
    path = public_path("byte_bpe_50k.json")
    tool, known = bpe.encoder(path), library(path)
    draw = random.Random(6)
    signs = [chr(c) for c in range(0x250)] + list("漢😀　́") + list(" \n'stLl<|>aaeethe--==") * 12
    texts = ["".join(draw.choice(signs) for _ in range(draw.choice((1, 30, 200)))) for _ in range(1500)]
    texts += ["", "a" * 50_000, "x<|endoftext|>y", "ab" * 9000 + " " * 3000]
    for text in texts:
        ids = known.encode(text, add_special_tokens=False).ids
        data = tool.encode(text)
        assert np.frombuffer(data, "<u4").tolist() == ids
        assert tool.decode([data])[0].decode() == known.decode(ids, skip_special_tokens=False) == text


def test_bpe_of_odd_tables(odd_documents, no_documents):
    rows = bpe.encoded(odd_documents, texts=True).collect()
    texts = collections.Counter(r.text or "" for r in odd_documents.select("text").collect())
    assert collections.Counter(r.decoded for r in rows) == texts
    assert all(r.n_tokens == len(r.ids) for r in rows)
    assert bpe.encoded(no_documents).count() == 0


def test_words_equal_the_library():
    path = public_path("word_bpe_49k.json")
    tool, known = word_ids(path), library(path)
    draw = random.Random(8)
    signs = [chr(c) for c in range(0x250)] + list("Σςİ漢 ") + list(" \n'sTlL<|>aethe") * 20
    texts = ["".join(draw.choice(signs) for _ in range(60)) for _ in range(1500)] + ["a<|endoftext|>b", ""]
    for text, data in zip(texts, tool.encode(texts), strict=True):
        assert np.frombuffer(data, "<u2").tolist() == known.encode(text, add_special_tokens=False).ids


# Packing


def check_packing(docs, rows):
    known = library(public_path("word_bpe_49k.json"))
    wanted = collections.Counter()
    for d, text in docs:
        ids = known.encode(text or "", add_special_tokens=False).ids + [1]
        wanted[d, len(ids)] += len(ids)
    got = collections.Counter()
    for r in rows:
        got[r.doc_id, r.doc_tokens] += r.length
    assert got == wanted
    fill = collections.defaultdict(list)
    for r in rows:
        fill[r.sequence_id].append((r.offset, r.length))
    sizes = {}
    for s, parts in fill.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        sizes[s] = at
    assert sorted(sizes) == list(range(len(sizes)))
    assert all(n == 2048 for s, n in sizes.items() if s != len(sizes) - 1)


def test_packing_keeps_every_token_and_the_mixture(spark):
    docs = documents(spark)
    rows = packing.pack(docs, with_ids=True).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    check_packing(list(texts.items()), rows)
    known = library(public_path("word_bpe_49k.json"))
    for r in rows:
        ids = np.array(known.encode(texts[r.doc_id], add_special_tokens=False).ids + [1], dtype="<u4")
        part = ids[r.start : r.start + r.length]
        assert r.ids == part.tolist() and r.ids_crc32 == zlib.crc32(part.tobytes())
    total, share = collections.Counter(), collections.Counter()
    for r in rows:
        total[r.source] += r.length
        share[r.sequence_id, r.source] += r.length
    whole = sum(total.values())
    for (s, source), n in share.items():
        if s < whole // 2048:
            assert abs(n - 2048 * total[source] / whole) <= 2


def test_packing_to_given_weights(spark):
    docs = table(spark, [prose(i, 300) for i in range(120)], source={i: "ab"[i % 2] for i in range(120)})
    rows = packing.pack(docs, weights={"a": 3, "b": 1}).collect()
    check_packing([(i, prose(i, 300)) for i in range(120)], rows)
    early = collections.Counter()
    for r in rows:
        if r.sequence_id < 15:
            early[r.source] += r.length
    assert abs(early["a"] / sum(early.values()) - 0.75) < 0.01


def test_quotas_meet_amounts():
    for seed in range(50):
        rng = np.random.default_rng(seed)
        sizes = rng.integers(1, 60, 9)
        cut = np.sort(rng.integers(0, sizes.sum() + 1, 4))
        amounts = np.diff(np.concatenate(([0], cut, [sizes.sum()])))
        due = np.outer(sizes / sizes.sum(), amounts)
        found = packing.quotas(sizes, due, amounts, rng.random(5))
        assert (found >= 0).all() and (found.sum(axis=0) == amounts).all() and (found.sum(axis=1) == sizes).all()


def test_packing_of_odd_tables(odd_documents, no_documents):
    rows = packing.pack(odd_documents, max_queues=1).collect()
    check_packing([(r.doc_id, r.text) for r in odd_documents.collect()], rows)
    assert packing.pack(no_documents).count() == 0


# Sharding


def check_shards(rows, n):
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    sizes = [len(slots[s]) for s in range(16)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_sharding_keeps_copies_together_and_sizes_even(spark):
    texts = [prose(i, 20) for i in range(600)] + [prose(i, 20) for i in range(0, 600, 4)] + [prose(3, 20)] * 15
    rows = sharding.by_equal_texts(table(spark, texts)).collect()
    check_shards(rows, len(texts))
    shards = collections.defaultdict(set)
    for r in rows:
        assert r.size == len(texts[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
        shards[texts[r.doc_id]].add(r.shard)
    groups = [s for t, s in shards.items() if texts.count(t) > 1]
    assert sum(len(s) == 1 for s in groups) >= 0.9 * len(groups)


def test_sharding_splits_a_group_that_fits_no_shard(spark):
    texts = ["same"] * 400 + [prose(i, 9) for i in range(600)]
    check_shards(sharding.by_equal_texts(table(spark, texts)).collect(), len(texts))


def test_sharding_of_odd_tables(odd_documents, no_documents):
    rows = sharding.by_equal_texts(odd_documents).collect()
    check_shards(rows, odd_documents.count())
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id == 2} == {(1, 0)}
    assert sharding.by_equal_texts(no_documents).count() == 0


# Language-model scores


def test_gradients_are_those_of_the_loss():
    lexicon = recurrent.Lexicon(np.arange(1, 101, dtype=np.uint64), np.arange(100, 0, -1), 20, 6000, 130)
    rng = np.random.default_rng(1)
    p = {k: v.astype(np.float64) for k, v in recurrent.initial(lexicon).items()}
    tokens, target = rng.integers(0, 102, (6, 3)), rng.integers(0, 102, (6, 3))
    h = rng.normal(0, 0.1, (3, recurrent.HIDDEN))
    d, _, _ = recurrent.gradients(p, lexicon, tokens, target, h)
    for name, place in (("input", (int(tokens[1, 0]), 4)), ("state", (3, 40)), ("class", (2, 1)), ("word_bias", (0, 5)), ("gate", (20,))):
        losses = []
        for step in (1e-5, -1e-5):
            q = {k: v.copy() for k, v in p.items()}
            q[name][place] += step
            losses.append(recurrent.gradients(q, lexicon, tokens, target, h)[2])
        assert abs((losses[0] - losses[1]) / 2e-5 - d[name][place]) < 1e-3 * max(1e-2, abs(d[name][place]))


def test_shares_sum_to_one():
    lexicon = recurrent.Lexicon(np.arange(1, 101, dtype=np.uint64), np.arange(100, 0, -1), 20, 6000, 130)
    p = recurrent.initial(lexicon)
    h = np.repeat(np.random.default_rng(2).normal(size=(1, recurrent.HIDDEN)), 102, axis=0).astype(np.float32)
    assert abs(np.exp(recurrent.log_shares(p, lexicon, h, np.arange(102))).sum() - 1) < 1e-4


def test_scores_equal_counts_and_beat_them(spark):
    docs = documents(spark).select("doc_id", "text")
    rows = recurrent.scores(docs).collect()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {r.doc_id: [*WORD.findall(r.text.translate(lower)), None] for r in docs.collect()}
    learnt = [d for d in tokens if zlib.crc32(str(d).encode()) % 10]
    counts = collections.Counter(w for d in learnt for w in tokens[d])
    total, base = sum(counts.values()), sum(counts.values()) + 0.1 * (len(counts) + 1)
    for r in rows:
        own = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), total)
        assert r.held_out == (r.doc_id not in set(learnt))
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 0.1) / base) for w in own), rel_tol=1e-9)
    assert sum(r.score for r in rows if r.held_out) > sum(r.base_score for r in rows if r.held_out)


def test_score_of_a_text_is_the_same_alone_and_in_a_block():
    lexicon = recurrent.Lexicon(np.arange(1, 101, dtype=np.uint64), np.arange(100, 0, -1), 20, 6000, 130)
    p, rng = recurrent.initial(lexicon), np.random.default_rng(3)
    texts = [np.append(rng.integers(0, 101, n), lexicon.end) for n in (5, 0, 70, 33)]
    first = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    together = recurrent.score_texts(p, lexicon, np.concatenate(texts), first)
    alone = [recurrent.score_texts(p, lexicon, t, np.array([0, len(t)]))[0] for t in texts]
    assert np.allclose(together, alone, rtol=1e-4)


def test_the_network_learns_from_the_whole_fold(spark, monkeypatch):
    monkeypatch.setattr(recurrent, "TRAINER_BYTES", 20_000)
    dealt, trained = [], recurrent._trained

    def recorded(lexicon, fold, trainers):
        dealt.append((fold.select("text", "round", "trainer").collect(), trainers))
        return trained(lexicon, fold, trainers)

    monkeypatch.setattr(recurrent, "_trained", recorded)
    texts = [prose(i, 80) for i in range(4000)] + [None, ""]
    rows = recurrent.scores(table(spark, texts)).collect()
    assert len(rows) == 4002 and all(math.isfinite(r.score) for r in rows)
    read, trainers = dealt[0]
    learnt = {r.doc_id for r in rows if not r.held_out}
    assert collections.Counter(r.text for r in read) == collections.Counter(texts[d] for d in learnt)
    assert trainers > recurrent.FAN and {r.trainer for r in read} == set(range(trainers))
    assert {r.round for r in read} == set(range(recurrent.ROUNDS))


@pytest.mark.parametrize("tokens", [1, 2, 255, 5000, 70_001])
def test_a_trainer_reads_every_token_once(monkeypatch, tokens):
    lexicon = recurrent.Lexicon(np.arange(1, 101, dtype=np.uint64), np.arange(100, 0, -1), 20, 6000, 130)
    p = recurrent.initial(lexicon)
    stream = np.concatenate(([lexicon.end], np.random.default_rng(1).integers(0, 100, tokens)))
    asked, gradients = collections.Counter(), recurrent.gradients

    def recorded(p, lexicon, given, target, h, real):
        asked.update(zip(given[real].tolist(), target[real].tolist(), strict=True))
        return gradients(p, lexicon, given, target, h, real)

    monkeypatch.setattr(recurrent, "gradients", recorded)
    after = recurrent.learn(p, lexicon, stream, 0.01)
    assert asked == collections.Counter(zip(stream[:-1].tolist(), stream[1:].tolist(), strict=True))
    assert (after["input"][stream[-2]] != p["input"][stream[-2]]).any()


def test_scores_of_odd_tables(odd_documents, no_documents):
    rows = recurrent.scores(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    by = {r.doc_id: r for r in rows}
    assert by[2].n_tokens == by[3].n_tokens == by[7].n_tokens == 1 and by[None].held_out is False
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert recurrent.scores(no_documents).count() == 0


# Near-duplicates


def classes_by_brute_force(docs):
    docs = [(d, t.split()) for d, t in docs]
    df = collections.Counter(w for _, t in docs for w in set(t))
    idf = {w: math.log((1 + len(docs)) / (1 + c)) + 1 for w, c in df.items()}
    vectors = {}
    for d, t in docs:
        shingles = [tuple(t[i : i + 5]) for i in range(len(t) - 4)] or ([tuple(t)] if t else [])
        count = collections.Counter(shingles)
        vectors[d] = {s: max(1, round(sum(idf[w] for w in s) / len(s) * 16)) * n for s, n in count.items()}
    name = {d: d for d, _ in docs}

    def find(d):
        while name[d] != d:
            d = name[d]
        return d

    for a in vectors:
        for b in vectors:
            if a < b and (shared := vectors[a].keys() & vectors[b].keys()):
                least = sum(min(vectors[a][s], vectors[b][s]) for s in shared)
                alike = least / (sum(vectors[a].values()) + sum(vectors[b].values()) - least)
                if alike >= 0.8:
                    x, y = find(a), find(b)
                    name[max(x, y)] = min(x, y)
    return {d: find(d) for d, _ in docs}


def test_near_duplicates_equal_brute_force(spark):
    draw = random.Random(5)
    texts = [prose(i, 90, 3000) for i in range(80)]
    for i in range(60):
        words = texts[i % 40].split()
        for _ in range(draw.choice((0, 1, 2, 6))):
            words[draw.randrange(len(words))] = f"new{draw.random()}"
        texts.append(" ".join(words))
    texts += ["two words", "two  words", "two other"]
    rows = neardup.classes(table(spark, texts)).collect()
    wanted = classes_by_brute_force(list(enumerate(texts)))
    assert {r.doc_id: r.class_id for r in rows} == wanted
    assert all(r.kept == (r.class_id == r.doc_id) for r in rows)


def test_near_duplicates_in_a_large_group(spark):
    words = prose(1, 150, 10**6).split()
    texts = [prose(i + 50, 40, 10**6) for i in range(300)]
    for i in range(300):
        copy = list(words)
        copy[i % 150] = f"edit{i}"
        texts.append(" ".join(copy))
    rows = neardup.classes(table(spark, texts)).collect()
    assert {r.class_id for r in rows if r.doc_id >= 300} == {300}
    assert all(r.kept for r in rows if r.doc_id < 300)


def test_near_duplicates_among_pages_of_one_template(spark):
    """Pages of some sections of one manual: pairs of like pages in buckets of hundreds of unlike ones."""
    draw = random.Random(9)
    sections = [prose(i + 900, 14, 10**6) for i in range(24)]
    pages = set()
    while len(pages) < 400:
        pages.add(tuple(sorted(draw.sample(range(24), 17))))
    texts = [" ".join(sections[i] for i in page) for page in sorted(pages)]
    draw.shuffle(texts)
    rows = neardup.classes(table(spark, texts)).collect()
    assert {r.doc_id: r.class_id for r in rows} == classes_by_brute_force(list(enumerate(texts)))


def test_near_duplicates_of_odd_tables(odd_documents, no_documents):
    rows = neardup.classes(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    found = collections.defaultdict(set)
    for r in rows:
        found[r.doc_id].add((r.class_id, r.kept))
    assert found[1] == {(1, True)} and found[5] == found[6] == {(1, False)}
    assert found[None] == {(None, True)} and found[2] == {(2, True)} and found[3] == {(3, True)} and found[7] == {(7, True)}
    assert neardup.classes(no_documents).count() == 0


# Language


def test_languages_held_out(spark):
    rows = language.predict(documents(spark)).collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 20 and all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.held_out for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


@pytest.mark.parametrize("n", [2, 3, 5, 7, 12, 40])
def test_codewords_differ(n):
    code = language.codewords(n)
    apart = [int((code[i] != code[j]).sum()) for i in range(n) for j in range(i)]
    assert min(apart) >= (2 ** (n - 2) if n <= 7 else 12) and (abs(code.sum(axis=0)) < n).all()


def test_languages_of_odd_tables(odd_documents, no_documents):
    rows = language.predict(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    by = {r.doc_id: r for r in rows}
    assert {by[d].lang_pred for d in (2, 3, 7, 9)} == {"und"} and by[2].score == 0
    assert by[8].lang_pred in ("en", "fr") and by[None].held_out is False
    assert language.predict(no_documents).count() == 0
    unlabelled = odd_documents.withColumn("lang", odd_documents["lang"].substr(1, 0)).replace("", None, ["lang"])
    assert {r.lang_pred for r in language.predict(unlabelled).collect()} == {"und"}
