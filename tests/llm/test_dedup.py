"""Near dedup, fingerprints, substrings and lines against brute force."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lumenfold.llm import common, lines, simhash, substring


def corpus(seed=0, n=60):
    """Random texts with exact copies, near copies, shared passages and repeated lines."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aeioustrnlm") for _ in range(rng.randrange(2, 8)))
    passage = [word() for _ in range(70)]
    block = [" ".join(word() for _ in range(5)) for _ in range(4)]
    texts = []
    for i in range(n):
        w = [word() for _ in range(rng.randrange(3, 160))]
        if i % 7 == 3:
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage
        text = "".join(x + ("\n" if rng.random() < 0.15 else " ") for x in w)
        if i % 9 == 4:
            text = "\n".join(block) + "\n" + text
        texts.append(text)
    for i in range(0, n, 6):
        texts.append(texts[i])
        w = texts[i + 1].split(" ")
        w[rng.randrange(len(w))] = word()
        texts.append(" ".join(w))
    return list(enumerate(texts))


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("masks,radius", [(simhash.block_masks(6, 3), 3), (simhash.covering_masks(3), 3), (simhash.covering_masks(7), 7)])
def test_every_pair_within_the_radius_meets(masks, radius):
    rng = np.random.default_rng(1)
    for k in range(1, radius + 1):
        for _ in range(300):
            d = np.uint64(sum(1 << int(b) for b in rng.choice(64, k, replace=False)))
            assert ((masks & d) == 0).any()


@pytest.mark.parametrize("long", [4096, 4])
def test_all_links_are_counted_once(spark, long):
    """All pairs of short runs; look-ups of differences in long ones."""
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    x = np.concatenate([base, *[base ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, k, replace=False))) for k in (1, 1, 2, 2, 3, 4)]])
    x = np.unique(x).view(np.int64).tolist()
    got = simhash.links(spark.createDataFrame([(v,) for v in x], "fp long"), simhash.block_masks(6, 3), 3, long).collect()
    pairs = [(a, b) for a, b in combinations(x, 2) if bin((a ^ b) & (2**64 - 1)).count("1") <= 3]
    count = Counter()
    for r in got:
        count[r["fp"]] += r["n"]
    assert +count == Counter(v for p in pairs for v in p)
    group = lambda edges: {min(c): c for c in _components(edges)}
    assert group([(r["fp"], r["o"]) for r in got if r["o"] is not None]) == group(pairs)


def _components(edges):
    found = []
    for e in edges:
        met = [c for c in found if c & set(e)]
        found = [c for c in found if not c & set(e)] + [set(e).union(*met)]
    return found


def test_a_long_run_costs_no_square():
    """100,000 fingerprints that agree on a mask."""
    rng = np.random.default_rng(4)
    mask = simhash.block_masks(6, 3)[0]
    x = np.unique(rng.integers(0, 1 << 63, 100_000, dtype=np.uint64) & ~mask)
    n = sum(len(p) for p, _ in simhash.pairs_in(x, np.array([0, len(x)]), mask, 1, 4096))
    some = set(x.tolist())
    assert n == sum(v ^ 1 << b in some for v in x.tolist() for b in range(64) if not int(mask) >> b & 1) // 2


def _sketches(rows):
    one, two, some = simhash._fingerprints(pa.array([None if t is None else t.lower() for _, t in rows], pa.string()), True)
    return [(int(a), int(b)) if s else (0, 0) for a, b, s in zip(one, two, some)]


def test_near_duplicates_are_the_components(spark):
    rows = corpus()
    got = {r["doc_id"]: (r["group_id"], r["keep"]) for r in simhash.near_duplicates(frame(spark, rows)).collect()}
    s = _sketches(rows)
    group = {i: i for i, _ in rows}
    for i, j in combinations(range(len(rows)), 2):
        if bin(s[i][0] ^ s[j][0]).count("1") <= 7 and bin(s[i][1] ^ s[j][1]).count("1") <= 14 and group[i] != group[j]:
            a, b = sorted((group[i], group[j]))
            group = {k: a if g == b else g for k, g in group.items()}
    assert got == {i: (group[i], group[i] == i) for i, _ in rows}
    copies = [i for i, t in rows[60:] if any(t == u for _, u in rows[:i])]
    assert copies and not any(got[i][1] for i in copies)


def test_long_runs_need_no_all_pairs():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, 2, dtype=np.uint64)
    x = np.stack([np.repeat(base[0], 300) ^ (np.uint64(1) << rng.integers(0, 60, 300).astype(np.uint64)), np.repeat(base[1], 300)], axis=1)
    a, b = simhash._linked(x, np.array([0, 300]), 7, 14)
    nodes, roots = simhash._forest(a, b)
    assert len(nodes) == 299 and set(roots.tolist()) == {0}


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {100 + k: 100 for k in range(1, 30)}


def brute_windows(rows, size):
    """Windows of tokens by content, in order of document and place."""
    found = {}
    for i, t in rows:
        w = t.split()
        for k in range(len(w) - size + 1):
            found.setdefault(tuple(w[k : k + size]), []).append((i, k))
    return found


def brute_intervals(rows, size):
    starts = {}
    for at in brute_windows(rows, size).values():
        if len(at) > 1:
            for n, (i, k) in enumerate(sorted(at)):
                starts.setdefault((i, n > 0), []).append(k)
    out = set()
    for (i, removed), ks in starts.items():
        part = []
        for k in sorted(ks) + [10**9]:
            if part and k > part[-1] + size:
                out.add((i, part[0], part[-1] + size, removed))
                part = []
            part.append(k)
    return out


@pytest.mark.parametrize("size", [8, 50])
@pytest.mark.parametrize("hot,broadcast", [(substring.HOT, substring.BROADCAST), (3, substring.BROADCAST), (3, 0), (0, 10)])
def test_repeated_substrings(spark, size, hot, broadcast):
    """Whether anchors count as hot (more than 3 runs; all) or not, and whether their windows are broadcast or shuffled."""
    rows = corpus(5)
    got = substring.repeated_substrings(frame(spark, rows + rows[7:9]), window=size, hot=hot, broadcast=broadcast).collect()
    assert {(r["doc_id"], r["start_word"], r["end_word"], r["removed"]) for r in got} == brute_intervals(rows, size) and len(got) == len(brute_intervals(rows, size)) > 0


def test_an_anchor_in_many_documents_is_no_group(spark):
    """A passage that nearly all documents share; its runs don't meet in one place."""
    passage = " ".join(f"p{k}" for k in range(60))
    docs = spark.range(20_000).selectExpr("id AS doc_id", f"concat('a', id, ' {passage} z', id % 7) AS text").repartition(8)
    found = substring.repeated_substrings(docs, hot=1000)
    assert found.where("removed").count() == 19_999
    (first,) = found.where("NOT removed AND doc_id = 0").collect()
    assert (first["start_word"], first["end_word"]) == (1, 62) or (first["start_word"], first["end_word"]) == (1, 61)
    left = substring.remove_substrings(docs, hot=1000).where("doc_id > 6").selectExpr("max(length(text)) AS n").first()["n"]
    assert left <= len("a19999 z0")


def test_removed_substrings_leave_each_passage_once(spark):
    rows = corpus(6)
    left = substring.remove_substrings(frame(spark, rows).selectExpr("doc_id", "text", "0L AS n_chars"), window=20).collect()
    gone = brute_intervals(rows, 20)
    for r in left:
        words = dict(rows)[r["doc_id"]].split()
        cut = {k for i, a, b, removed in gone if i == r["doc_id"] and removed for k in range(a, b)}
        assert r["text"].split() == [w for k, w in enumerate(words) if k not in cut] and r["n_chars"] == len(r["text"])


def test_line_dedup(spark):
    rows = corpus(7)
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in lines.dedup_lines(frame(spark, rows)).collect()}
    seen, want = set(), {}
    for i, t in rows:
        own = [k for k, line in enumerate(t.split("\n")) if line]
        split, gone = t.split("\n"), set()
        for a in range(len(own) - 2):
            key = tuple(split[k] for k in own[a : a + 3])
            if key in seen:
                gone |= set(own[a : a + 3])
            seen.add(key)
        want[i] = ("\n".join(line for k, line in enumerate(split) if k not in gone), len(gone))
    assert got == want and any(n for _, n in want.values())


def awkward_names(spark, rows):
    """Columns named like those that operators use inside, twice or in other case."""
    names = ["id", "tid", "lines", "spans", "slot", "keep", "c0", "c1", "C1", "removed", "row", "n_removed", "count", "_lf_id", "_lf_tid", "_lf_removed", "h", "pos", "first", "bucket", "part", "n_chars"]
    docs = frame(spark, rows)
    return docs.select(*[F.lit(k).cast("long").alias(c) for k, c in enumerate(names)], "doc_id", "text"), names


@pytest.mark.parametrize("slots", [1 << 20, 2])
def test_columns_may_have_any_name(spark, tmp_path, monkeypatch, slots):
    """And the filter of slots decides nothing, whether it is full or not."""
    monkeypatch.setattr(common.parted, "__defaults__", (slots,))
    monkeypatch.setattr(common.rewritten, "__defaults__", (slots,))
    rows = corpus(8) + [(None, "no id"), (None, "no id"), (900, None), (901, "")]
    rows += rows[:5]
    docs, names = awkward_names(spark, rows)
    plain = frame(spark, rows)
    extra = [c for c in names if c not in ("n_removed", "n_chars")]

    def same(got, want):
        key = lambda r: (str(r[0]), str(r[1]))
        left = got.select("doc_id", "text", *[F.col(f"`{c}`") for c in extra if c.lower() != "c1"]).collect()
        assert all(tuple(r)[2:] == tuple(names.index(c) for c in extra if c.lower() != "c1") for r in left)
        assert sorted(map(key, left)) == sorted(map(key, want.select("doc_id", "text").collect()))

    got = lines.dedup_lines(docs)
    assert got.columns == [c for c in docs.columns if c != "n_removed"] + ["n_removed"]
    same(got, lines.dedup_lines(plain))
    same(substring.remove_substrings(docs, window=20), substring.remove_substrings(plain, window=20))
    for stage in (corpus_pipeline.dedup_lines, corpus_pipeline.dedup_near):
        got = stage(spark, docs, "")
        assert got.columns == docs.columns
        same(got, stage(spark, plain, ""))
    near = [(r["doc_id"], r["text"]) for r in corpus_pipeline.dedup_near(spark, plain, "").collect()]
    told = simhash.near_duplicates(plain.where("text IS NOT NULL")).collect()
    texts = dict(rows)
    assert sorted(near, key=str) == sorted([(r["doc_id"], texts[r["doc_id"]]) for r in told if r["keep"]] + [(None, "no id"), (None, "no id"), (900, None)], key=str)
