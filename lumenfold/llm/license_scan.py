"""License scan: ordered signature rules behind a keyword automaton.

Keywords and patterns see a text in which every line break (with the comment sign that
the next line may begin with) and every other run of white space is one blank, so that
a signature may be wrapped and indented; places are those of the text itself.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from lumenfold.llm import words as W
from lumenfold.llm.common import documents
from lumenfold.llm.license_rules import RULES

Detection = tuple[int, int, int]  # start, end, number of the rule

GAP = re.compile(r"\s*\n\s*(?:(?:[*#;>%]+|//+|--+)(?=\s)\s*)?|\s{2,}|[^\S ]")


@cache
def _compiled() -> tuple[list[re.Pattern], ahocorasick.Automaton]:
    """Once per worker process."""
    by_keyword: dict[str, list[int]] = {}
    for i, r in enumerate(RULES):
        by_keyword.setdefault(r.keyword, []).append(i)
    automaton = ahocorasick.Automaton()
    for k, rules in by_keyword.items():
        automaton.add_word(k, (k, rules))
    automaton.make_automaton()
    return [re.compile(r.pattern, re.I | re.A) for r in RULES], automaton


def squeezed(text: str) -> tuple[str, list[int], list[int]]:
    """The text with one blank for each gap; where pieces begin in it, and how far they were moved."""
    out, begin, move, at, size = [], [0], [0], 0, 0
    for m in GAP.finditer(text):
        out += (text[at : m.start()], " ")
        size += m.start() - at + 1
        at = m.end()
        begin.append(size)
        move.append(at - size)
    return "".join((*out, text[at:])), begin, move


def candidates(short: str) -> list[int]:
    """Rules whose keyword the squeezed text contains, in order."""
    _, automaton = _compiled()
    found: dict[str, list[int]] = dict(value for _, value in automaton.iter(short.lower()))
    return sorted(i for rules in found.values() for i in rules)


def resolve(found: list[Detection]) -> list[Detection]:
    """Without the detections that lie inside one of higher rank (priority, then length, then rule order)."""
    kept: list[Detection] = []
    starts: list[int] = []  # of the kept intervals that lie in no other, with growing ends
    ends: list[int] = []
    for d in sorted(set(found), key=lambda d: (-RULES[d[2]].priority, d[0] - d[1], d[2], d[0])):
        before = bisect_right(starts, d[0])
        if before and ends[before - 1] >= d[1]:
            continue
        kept.append(d)
        lo, hi = bisect_left(starts, d[0]), bisect_right(ends, d[1])
        starts[lo : max(lo, hi)], ends[lo : max(lo, hi)] = [d[0]], [d[1]]
    return sorted(kept)


def scan(text: str, rules: list[int] | None = None) -> list[Detection]:
    """Detections of a text; ``rules`` are those to try, by default those that the keywords let through."""
    patterns, _ = _compiled()
    short, begin, move = squeezed(text)
    if rules is None:
        rules = candidates(short)
    place = lambda k: k + move[bisect_right(begin, k) - 1]
    return resolve([(place(m.start()), place(m.end() - 1) + 1, i) for i in rules for m in patterns[i].finditer(short)])


def license_of(rule: int, matched: str) -> str:
    """The license that a rule tells of; of an SPDX expression, the expression."""
    return RULES[rule].license or " ".join(matched.partition(":")[2].split())


def scan_licenses(docs: DataFrame) -> DataFrame:
    """``doc_id, rule_id, license, start, end, matched``: a row per detection in a row of ``docs``.

    ``start`` and ``end`` count characters.  A detection inside the interval of another
    one of higher priority (of the same priority: a longer one, or an earlier rule) is
    suppressed; detections that overlap in part both stay.  NULL and empty texts have
    no detection, repeated rows and rows with a NULL ``doc_id`` have theirs each; a text
    of any length is scanned as a whole, at a cost of its length and of ``n log n`` in its
    detections."""
    names = ["doc_id", "rule_id", "license", "start", "end", "matched"]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ids, rows = batch.column("doc_id").to_pylist(), []
            _, offsets, _ = W.buffers(batch.column("text"))
            for a, b in W.groups(offsets):
                for i, text in enumerate(batch.column("text").slice(a, b - a).to_pylist(), a):
                    if text:
                        rows += [(ids[i], RULES[k].rule_id, license_of(k, text[s:e]), s, e, text[s:e]) for s, e, k in scan(text)]
            cols = list(zip(*rows)) or [()] * 6
            types = (pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    return documents(docs).mapInArrow(run, "doc_id long, rule_id string, license string, start int, end int, matched string")
