"""License scans: ordered signature rules over words, gated by keywords, overlaps resolved by precedence.

All of it is Spark's own expressions over one row, so a scan has no shuffle and no Python. A text is
read as lower-case words. Its keywords decide which rules are tried at all: each rule hangs on its
rarest needed word, and the others must stand in the text too. A rule's matches are marked in the
text, whose words then tell where they begin and end. Of overlapping matches, one that another of the
same or a lower level contains is dropped.
"""

from __future__ import annotations

import collections
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.columns import free
from millrace.llm.license_rules import BASE, CONFIDENCE, all_rules

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OPEN, CLOSE = "\x01", "\x02"
RESULTS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections")
_RULE = "array<struct<rule:int, label:string, level:int, needs:array<array<string>>, pattern:string>>"


def pattern(regex: str) -> str:
    """A rule's regex for texts in which every word has a space of its own on both sides."""
    spaced = regex.replace(" ?", "\0").replace(" ", "  ").replace("\0", "(?:  )?")
    return f" ((?:{spaced})) "


def anchors(rules: list[dict]) -> dict[str, list[int]]:
    """The rules to try for a word: each rule under those of its needs that fewest rules share."""
    shared = collections.Counter(w for r in rules for need in r["needs"] for w in need)
    out: dict[str, list[int]] = {}
    for r in rules:
        for word in min(r["needs"], key=lambda need: (any(w.isdigit() for w in need), sum(shared[w] for w in need))):
            out.setdefault(word, []).append(r["rule"])
    return out


def normalised(text: Column) -> Column:
    """The words of a text, A to Z lower-cased, joined by two spaces; a null text has none."""
    plain = F.octet_length(text) == F.char_length(text)
    lower = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.coalesce(F.trim(F.regexp_replace(lower, SEPARATORS, "  ")), F.lit(""))


def _let(value: Column, use) -> Column:
    """``use`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _places(words: Column, mark: Column) -> Column:
    """Where marked words stand, from 0."""
    at = F.transform(words, lambda w, i: F.when(F.contains(w, mark), i))
    return F.filter(at, lambda i: i.isNotNull())


def _matches(padded: Column, rule: Column) -> Column:
    """A rule's matches in order, as (start, level, -end, rule, label)."""
    marked = F.regexp_replace(padded, rule["pattern"], F.lit(f" {OPEN}$1{CLOSE} "))
    return _let(
        F.split(F.trim(marked), "  "),
        lambda words: F.zip_with(
            _places(words, F.lit(OPEN)),
            _places(words, F.lit(CLOSE)),
            lambda first, last: F.struct(
                first.cast("long").alias("start"), rule["level"].alias("level"),
                (-(last + 1)).cast("long").alias("minus_end"), rule["rule"].alias("rule"), rule["label"].alias("label"),
            ),
        ),
    )


def _kept(found: Column, levels: int) -> Column:
    """Those of sorted matches that no other contains with precedence.

    First, of all that share start and level the first: the longest, of equal ones the lower rule. What
    can contain one of the rest starts fewer words before it than the longest match has, and there are
    at most ``levels`` per word, so all of them stand near it in the list.
    """

    def leads(match: Column, i: Column) -> Column:
        before = F.get(found, i - 1)
        return (i == 0) | (before["start"] != match["start"]) | (before["level"] != match["level"])

    def held(match: Column, other: Column) -> Column:
        outside = (match["start"] <= other["start"]) & (match["minus_end"] <= other["minus_end"])
        same = (match["level"] == other["level"]) & (match["start"] != other["start"])
        return outside & ((match["level"] < other["level"]) | same)

    def among(leaders: Column) -> Column:
        longest = F.array_max(F.transform(leaders, lambda m: -m["minus_end"] - m["start"]))

        def within(reach: Column) -> Column:
            def stays(match: Column, i: Column) -> Column:
                near = F.sequence(F.greatest(F.lit(0), i - reach), F.least(F.size(leaders) - 1, i + levels))
                return ~F.exists(near, lambda k: held(F.get(leaders, k), match))

            return F.filter(leaders, stays)

        return _let((longest * levels).cast("int"), within)

    return _let(F.filter(found, leads), among)


def scan(
    docs: DataFrame,
    rules: list[dict] | None = None,
    results: tuple[str, ...] = RESULTS,
    text: str = "text",
    carry: tuple[str, ...] | None = None,
) -> DataFrame:
    """Per row: the columns of ``carry`` (by default all), then ``results`` out of ``RESULTS``.

    ``detections``: kept matches by place (label, rule, level, first_word, n_words, confidence), words
    counted from 0; ``n_base``, ``first_word``, ``last_word``, ``base_labels``: of all matches of the
    phrases at level 0, kept or not; ``labels``: those and the labels of kept matches, distinct, sorted;
    ``score``: the highest confidence among them, 0 without any.

    A null or empty text has no words and no match. Repeated rows and nulls elsewhere pass; an input
    column named like a result is left out; an empty table gives an empty one. A text and the copies of
    it that a match takes must fit a task.
    """
    rules = all_rules() if rules is None else rules
    levels = 1 + max(r["level"] for r in rules)
    names = [c for c in docs.columns if (carry is None or c in carry) and c not in results]
    taken = [*names, *results]
    words, keys, found = (free(c, taken) for c in ("words", "keys", "found"))
    told = [{**{k: r[k] for k in ("rule", "label", "level", "needs")}, "pattern": pattern(r["regex"])} for r in rules]
    rule_list = F.from_json(F.lit(json.dumps(told)), _RULE)
    hung = anchors(rules)
    numbers = F.from_json(F.lit(json.dumps([*hung.values()])), "array<array<int>>")
    keywords = F.lit(sorted({w for r in rules for need in r["needs"] for w in need}))

    own = [F.col(f"`{c}`") for c in names]
    read = docs.select(*own, normalised(F.col(f"`{text}`")).alias(words))
    read = read.withColumn(keys, F.array_intersect(F.split(words, "  "), keywords))
    padded = F.concat(F.lit(" "), F.col(words), F.lit(" "))
    hooks = F.array_intersect(F.col(keys), F.lit([*hung]))
    tried = F.array_distinct(F.flatten(F.transform(hooks, lambda h: F.element_at(numbers, F.array_position(F.lit([*hung]), h).cast("int")))))

    def fits(rule: Column, in_words: Column) -> Column:
        needed = F.forall(rule["needs"], lambda need: F.exists(need, lambda w: F.array_contains(F.col(keys), w)))
        return needed & F.rlike(in_words, rule["pattern"])

    def matches(in_words: Column) -> Column:
        chosen = F.transform(tried, lambda i: F.get(rule_list, i))
        fitting = F.filter(chosen, lambda r: fits(r, in_words))
        return F.array_sort(F.flatten(F.transform(fitting, lambda r: _matches(in_words, r))))

    none = F.array().cast("array<struct<start:bigint,level:int,minus_end:bigint,rule:int,label:string>>")
    read = read.withColumn(found, F.when(F.size(hooks) == 0, none).otherwise(_let(padded, matches)))

    every, kept = F.col(found), free("kept", taken)
    read = read.withColumn(kept, F.when(F.size(every) == 0, none).otherwise(_let(every, lambda d: _kept(d, levels))))
    base = F.filter(every, lambda m: m["level"] == BASE)
    base_labels = F.transform(base, lambda m: m["label"])
    shown = F.filter(F.col(kept), lambda m: m["label"] != "")
    confidence = F.lit([CONFIDENCE[i] for i in range(levels)])
    sure = lambda m: F.get(confidence, m["level"])
    joined = lambda labels: F.array_join(F.sort_array(F.array_distinct(labels)), ",")
    gaps = F.char_length(words) - F.char_length(F.replace(F.col(words), F.lit("  "), F.lit("")))
    out = {
        "n_words": F.when(F.col(words) == "", 0).otherwise((gaps / 2).cast("long") + 1).cast("long"),
        "n_base": F.size(base).cast("long"),
        "first_word": F.array_min(F.transform(base, lambda m: m["start"])),
        "last_word": F.array_max(F.transform(base, lambda m: m["start"])),
        "base_labels": joined(base_labels),
        "labels": joined(F.concat(base_labels, F.transform(shown, lambda m: m["label"]))),
        "score": F.coalesce(F.array_max(F.transform(F.concat(base, shown), sure)), F.lit(0.0)),
        "detections": F.transform(
            shown,
            lambda m: F.struct(
                m["label"].alias("label"), m["rule"].alias("rule"), m["level"].alias("level"), m["start"].alias("first_word"),
                (-m["minus_end"] - m["start"]).alias("n_words"), sure(m).alias("confidence"),
            ),
        ),
    }
    return read.select(*own, *[out[c].alias(c) for c in results])
