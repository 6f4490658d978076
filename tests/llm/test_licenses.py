"""License scans: brute force over drawn texts, precedence, odd tables, a plan without Python."""

import random
import re

from millrace.llm import catalog, licenses
from millrace.llm.license_rules import CONFIDENCE, all_rules

SIGNS = """Released under the MIT License.|Licensed under the Apache License, Version 2.0.|GNU General Public License, version 3
CC BY-NC 4.0|SPDX-License-Identifier: GPL-2.0-only|GNU Lesser General Public License version 2.1 or later
BSD 3-Clause|not under the MIT License but|driver's license|Mozilla Public License 2.0|all rights reserved|GPLv3
https://www.gnu.org/licenses/gpl-3.0.html|Copyright (c) 2031|Permission is hereby granted, free of charge, to any person
to use, copy, modify, merge, publish, distribute, sublicense|Creative Commons Attribution-ShareAlike 4.0|the Unlicense|public domain
Apache License server|under the mit license|apache license version 2|cc by nc|under the mit licence plate|mit|license|größe|GNU"""


def drawn(seed, n):
    draw = random.Random(seed)
    stock = SIGNS.replace("\n", "|").split("|")
    return draw.choice([" ", ", ", "\n"]).join(draw.choice(stock) for _ in range(draw.randrange(n)))


def by_hand(text):
    """Every rule over every text whose words it needs; all pairs of matches compared."""
    rules = all_rules()
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    padded = f" {'  '.join(words)} "
    found = []
    for r in rules:
        if all(set(need) & set(words) for need in r["needs"]):
            for m in re.finditer(licenses.pattern(r["regex"]), padded):
                start = len(padded[: m.start()].split())
                found.append((start, start + len(m[1].split()), r["level"], r["rule"], r["label"]))
    base = [f for f in found if f[2] == 0]

    def beaten(a):
        return any(
            b[0] <= a[0] and b[1] >= a[1] and b != a
            and (b[2] < a[2] or (b[2] == a[2] and (b[1] - b[0] > a[1] - a[0] or (b[1] - b[0] == a[1] - a[0] and b[3] < a[3]))))
            for b in found
        )

    kept = [a for a in found if a[4] and not beaten(a)]
    shown = base + kept
    return {
        "n_words": len(words),
        "n_base": len(base),
        "first_word": min((b[0] for b in base), default=None),
        "last_word": max((b[0] for b in base), default=None),
        "base_labels": ",".join(sorted({b[4] for b in base})),
        "labels": ",".join(sorted({b[4] for b in shown})),
        "score": max((CONFIDENCE[b[2]] for b in shown), default=0.0),
        "detections": sorted((a[0], a[1] - a[0], a[3], a[4]) for a in kept),
    }


def test_scan_equals_brute_force(spark):
    texts = [drawn(i, 14) for i in range(250)] + [drawn(999, 400), "", None, "\x00\x01 MIT", "a" * 100]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    labels = set()
    for r in licenses.scan(docs).collect():
        wanted = by_hand(texts[r.doc_id])
        found = {c: r[c] for c in wanted}
        found["detections"] = sorted((d.first_word, d.n_words, d.rule, d.label) for d in r.detections)
        assert found == wanted, texts[r.doc_id]
        labels |= set(r.labels.split(","))
    assert {"mit", "apache-2", "cc-by-nc", "gpl-2", "gpl-3", "lgpl-2.1", "mpl-2", "unlicense", "proprietary"} <= labels


def test_longer_and_earlier_rules_win(spark):
    told = {
        "GNU Lesser General Public License version 2.1": "lgpl-2.1",
        "see SPDX-License-Identifier: Apache-2.0 here": "apache-2",
        "a driver's license": "",
        "not only under the MIT license but others": "mit",
        "license: CC-BY-ND 4.0": "cc-by-nd",
        "license: CC-BY-NC-SA 4.0": "cc-by-nc,cc-by-nc-sa",  # the phrase stays
    }
    docs = spark.createDataFrame([(t,) for t in told], "text STRING")
    assert {r.text: r.labels for r in licenses.scan(docs).collect()} == told


def test_rules_are_hundreds_and_bounded():
    rules = all_rules()
    assert len(rules) > 300 and len({r["label"] for r in rules}) > 100
    for r in rules:
        assert not re.search(r"[^\\\]]\*|\)\+|\\S\*|\{\d+,\}|\(\?[=!<]", r["regex"]), r["regex"]
        assert all(w == w.lower() and w.isalnum() for need in r["needs"] for w in need)


def test_scan_of_odd_tables(spark, odd_documents, no_documents):
    rows = licenses.scan(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    by = {r.doc_id: r for r in rows}
    assert (by[2].n_words, by[2].labels, by[2].score) == (0, "", 0.0) == (by[3].n_words, by[3].labels, by[3].score)
    assert by[4].n_words == 60_002 and len([r for r in rows if r.doc_id == 5]) == 2 and by[5].kept == odd_documents.where("doc_id=5").first().kept
    assert licenses.scan(no_documents).count() == 0
    clash = odd_documents.selectExpr("doc_id", "text", "1 AS words", "2 AS keys", "3 AS found", "4 AS kept", "5 AS labels")
    out = licenses.scan(clash)
    assert out.columns == ["doc_id", "text", "words", "keys", "found", "kept", *licenses.RESULTS] and out.count() == len(rows)


def test_many_matches_in_one_long_text_stay_linear(spark):
    text = "Under the MIT License, GPLv3. " * 10_000
    docs = spark.createDataFrame([(1, text)], "doc_id BIGINT, text STRING")
    r = licenses.scan(docs).first()
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.labels) == (50_000, 10_000, 0, 49_995, "gpl-3,mit")
    assert len(r.detections) == 20_000


def test_plan_has_no_python_and_no_shuffle(spark):
    plan = catalog.QUERIES["op11_license_scan"](spark, "/root/testdata/sf0.001")
    told = plan._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange|from_json", told)


def test_license_query_equals_its_sql(spark):
    from oracle import connect, spark_rows, sql_rows

    folder, name = "/root/testdata/sf0.001", "op11_license_scan"
    assert spark_rows(catalog.QUERIES[name](spark, folder)) == sql_rows(connect(folder), catalog.SQL[name])
