"""Token alignment: brute force over whole tables, odd tables, the skipping itself."""

import bisect
import collections
import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import alignment, catalog
from millrace.llm.tokens import byte_letters, public_path

NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)))
def test_cuts_are_the_common_ends(one, other):
    one, other = sorted(one | {61}), sorted(other | {61})
    a, b = alignment.cuts(one, other)
    common = sorted(set(one) & set(other))
    assert [one[i] for i in a] == common == [other[j] for j in b]


def test_cuts_jump_long_stretches_around_irregular_ones():
    one = [*range(1, 5000), *range(5010, 9000)]
    other = [*range(1, 700), *range(703, 9000)]
    a, b = alignment.cuts(one, other)
    assert [one[i] for i in a] == sorted(set(one) & set(other)) == [other[j] for j in b]
    assert [len(x) for x in alignment.cuts([], [])] == [0, 0]


def by_brute_force(texts):
    """Both tokenizers' own libraries, one text at a time; ends by position, counts by dictionary."""
    import sentencepiece
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(public_path("byte_bpe_50k.json"))
    tool.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_path("piece_bpe_32k.model"))
    raw = {c: bytes([b]) for b, c in enumerate(byte_letters())}
    rows, counts = [], collections.Counter()
    for text in texts:
        side_a, side_b = [], []
        if text:
            ids = tool.encode(" " + text, add_special_tokens=False).ids
            side_a = [(i, b"".join(raw[c] for c in tool.id_to_token(i))) for i in ids]
            for i in pieces.encode(text):
                p = pieces.id_to_piece(i)
                token = bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()
                side_b.append((i, token))
            if b"".join(t for _, t in side_a) != (" " + text).encode():
                side_a, side_b = [], []
            if b"".join(t for _, t in side_b) != (" " + text).encode():
                side_a, side_b = [], []
        ends = []
        for side in (side_a, side_b):
            at, found = 0, {}
            for i, t in side:
                at += len(t)
                found[at] = i
            ends.append(found)
        common = sorted(set(ends[0]) & set(ends[1]))
        held = [collections.defaultdict(list), collections.defaultdict(list)]
        for side, e in zip(held, ends, strict=True):
            for x in e:
                side[common[bisect.bisect_left(common, x)]].append(str(e[x]))
        groups = ["|".join(",".join(side[x]) for side in held) for x in common]
        links = [(ends[0][x], ends[1][x]) for x in common]
        counts.update(links)
        rows.append((len(side_a), len(side_b), ";".join(groups), links))
    best = collections.defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    for n_a, n_b, groups, links in rows:
        yield (
            n_a, n_b, len(links), len(links), sum(counts[x] == best[x[1]] for x in links),
            sum(counts[x] for x in links), groups and hashlib.sha256(groups.encode()).hexdigest(),
        )


def test_alignment_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    given_rows = docs.select("doc_id", "text").collect()
    stock = ["the", " ", "  ", "\n", "漢字", "é", "▁", "<s>", "<|endoftext|>", "<0x41>", "ﬁ", "don't", "١٢", "1234567", "\x00", "🙂", "word", "�"]
    draw = random.Random(5)
    more = ["".join(draw.choice(stock) for _ in range(draw.randrange(12))) for _ in range(150)]
    rows = [(r.doc_id, r.text) for r in given_rows] + [(10**9 + i, t) for i, t in enumerate(more)]
    table = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    found = {r.doc_id: r for r in alignment.aligned(table, (*NAMES, "groups")).collect()}
    for (doc_id, _), wanted in zip(rows, by_brute_force([t for _, t in rows]), strict=True):
        assert tuple(found[doc_id][c] for c in NAMES) == wanted
        assert found[doc_id].groups.count(";") == max(0, found[doc_id].n_groups - 1)


def test_alignment_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    wanted = dict(zip([r.doc_id for r in rows], by_brute_force([r.text for r in rows]), strict=True))
    found = catalog.QUERIES["op12_token_alignment"](spark, folder).collect()
    assert {r.doc_id: tuple(r[c] for c in NAMES) for r in found} == wanted


def test_alignment_of_odd_tables(odd_documents, no_documents):
    rows = alignment.aligned(odd_documents, (*NAMES, "groups")).collect()
    assert len(rows) == odd_documents.count()
    by = {r.doc_id: r for r in rows}
    assert [by[2][c] for c in NAMES] == [0, 0, 0, 0, 0, 0, ""] == [by[3][c] for c in NAMES]
    assert by[4].n_a > 60_000 and by[4].n_links > 60_000
    assert len([r for r in rows if r.doc_id == 5]) == 2 and by[5].count_sum == by[None].count_sum == by[1].count_sum
    assert "kept" in rows[0] and "n_words" in rows[0]
    assert alignment.aligned(no_documents).count() == 0
    clash = odd_documents.selectExpr("doc_id", "text", "1 AS pairs", "2 AS links", "3 AS batch", "4 AS aligned", "5 AS n_a", "6 AS at")
    found = alignment.aligned(clash)
    assert found.columns[:7] == ["doc_id", "text", "pairs", "links", "batch", "aligned", "at"] and found.count() == len(rows)
    plain = alignment.aligned(clash, ("n_a", "groups"), carry=("doc_id",))
    assert plain.columns == ["doc_id", "n_a", "groups"] and plain.count() == len(rows)
