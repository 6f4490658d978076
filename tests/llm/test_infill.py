"""Fill-in-middle over seekable frames: brute force, round trips, odd tables."""

import hashlib
import random
import re

import pytest

from millrace.llm import catalog, frames, infill
from millrace.llm.frames import Frames

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def drawn_text(draw):
    stock = ["a", "é", "漢", "𝄞", " ", "\n", "\x0b", "<P>", "bc ", "<", "S>"]
    return "".join(draw.choice(stock) for _ in range(draw.randrange(60)))


@pytest.mark.parametrize("size", [4, 5, 7, 64])
def test_frames_find_every_unit(size):
    draw = random.Random(size)
    for _ in range(300):
        text = drawn_text(draw)
        held = Frames.of([text[:9].encode(), text[9:].encode()], size=size)
        units = UNIT.findall(text)
        assert b"".join(held.stretch()).decode() == text
        assert (held.n_units, held.n_chars, held.n_bytes) == (len(units), len(text), len(text.encode()))
        for i in range(len(units) + 1):
            before = "".join(units[:i])
            assert held.place(i) == (len(before.encode()), len(before))
        low, high = sorted((draw.randrange(len(text) + 1), draw.randrange(len(text) + 1)))
        low, high = len(text[:low].encode()), len(text[:high].encode())
        assert b"".join(held.stretch(low, high)) == text.encode()[low:high]
        assert held.find(b"<P>", low) == text.encode().find(b"<P>", low)


def by_hand(doc_id, text):
    text = text or ""
    told = hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()
    h = [int(told[i : i + 8], 16) for i in (0, 8, 16, 24)]
    units = UNIT.findall(text)
    n = len(units)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    parts = ["".join(u) for u in (units[:low], units[low:high], units[high:])]
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    form = "spm" if h[3] % 100 < 80 else "psm"
    prefix, middle, suffix = parts
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return n, form, len(prefix), len(middle), out


def test_infill_equals_a_plain_one_on_short_and_long_texts(spark):
    draw = random.Random(3)
    texts = [drawn_text(draw) for _ in range(300)]
    texts += [" ".join(f"wörd{draw.randrange(99)}" for _ in range(40_000)), "x" * 200_000 + " y", "\n" * 70_000]
    texts += [t + "<" for t in texts[:50]]
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    results = ("n", "form", "prefix_chars", "middle_chars", "output", "output_text", "output_sha256", "restored_sha256")
    forms = set()
    for r in infill.infilled(frames.framed(docs), results).collect():
        text = texts[r.doc_id]
        *facts, output = by_hand(r.doc_id, text)
        assert [r.n, r.form, r.prefix_chars, r.middle_chars] == facts and r.output_text == output
        assert r.output_sha256 == hashlib.sha256(output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(text.encode()).hexdigest()
        written = Frames(f.asDict() for f in r.output)
        assert b"".join(written.stretch()).decode() == output
        assert b"".join(infill.restored(written, r.form)).decode() == text
        forms.add(r.form)
    assert forms == {"plain", "spm", "psm"}


def test_infill_of_odd_tables(spark, odd_documents, no_documents):
    rows = infill.infilled(frames.framed(odd_documents)).collect()
    assert len(rows) == odd_documents.count()
    by = {r.doc_id: r for r in rows}
    assert (by[2].n, by[2].form, by[2].output) == (0, "plain", []) == (by[3].n, by[3].form, by[3].output)
    assert len(by[4].output) > 1 and by[7].n == 1
    assert len([r for r in rows if r.doc_id == 5]) == 2 and "kept" in rows[0] and "text" not in rows[0]
    assert by[None].n == by[1].n
    clash = odd_documents.selectExpr("doc_id", "text", "1 AS n", "'f' AS form", "2 AS frames", "3 AS read", "4 AS drawn")
    found = infill.infilled(frames.framed(clash))
    assert found.columns == ["doc_id", "read", "drawn", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert found.count() == len(rows)
    assert infill.infilled(frames.framed(no_documents)).count() == 0


def test_infill_query_equals_its_sql(spark):
    from oracle import connect, spark_rows, sql_rows

    folder = "/root/testdata/sf0.001"
    name = "op13_fill_in_middle"
    assert spark_rows(catalog.QUERIES[name](spark, folder)) == sql_rows(connect(folder), catalog.SQL[name])
