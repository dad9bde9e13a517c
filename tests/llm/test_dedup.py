"""Exact, near and byte-string dedup against brute force on awkward tables."""

import hashlib
import re

import pytest

from rillmark.llm.exact_dedup import drop_copies, exact_dedup
from rillmark.llm.minhash import rows_per_band, shingle_set, super_minhash
from rillmark.llm.near_dedup import drop_near_copies, near_dedup
from rillmark.llm.suffix_dedup import suffix_dedup
from tests.llm.cases import awkward, documents, prose


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("digest_all", [True, False])
def test_exact_dedup(spark, digest_all):
    rows = awkward()
    got = exact_dedup(documents(spark, rows), digest_all=digest_all).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(plain(t), []).append(i)
    want = []
    for i, t in rows:
        ids = groups[plain(t)]
        keep = min((x for x in ids if x is not None), default=None)
        want.append((i, keep, len(ids), i == keep, hashlib.sha256(plain(t).encode()).hexdigest()))
    if digest_all:
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    else:
        assert sorted(repr(tuple(r)[:4]) for r in got) == sorted(repr(w[:4]) for w in want)
        assert all(r.text_sha256 is not None for r in got if r.group_size > 1)


def test_exact_dedup_prefix_and_length_do_not_decide(spark):
    head = "x" * 300
    rows = [(1, head + "a"), (2, head + "b"), (3, head + "a"), (4, "y" * 301)]
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup(documents(spark, rows)).collect()}
    assert got == {1: (1, 2), 2: (2, 1), 3: (1, 2), 4: (4, 1)}


def test_drop_copies_keeps_columns_and_empty_table(spark):
    docs = documents(spark, awkward())
    left = drop_copies(docs)
    assert left.columns == docs.columns
    kept = sorted((r.doc_id for r in left.collect() if r.doc_id is not None))
    assert kept == [2, 3, 7, 9, 11, 12, 12, 13, 14, 15]
    assert drop_copies(docs.limit(0)).count() == 0
    assert exact_dedup(docs.limit(0)).count() == 0


def brute_near(rows, words, percent):
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append(set(zip(*[w[k:] for k in range(words)])) if len(w) >= words else ({tuple(w)} if w else set()))
    comp = {i: i for i, _ in rows if i is not None}
    changed = True
    while changed:
        changed = False
        for x in range(len(rows)):
            for y in range(len(rows)):
                i, j = rows[x][0], rows[y][0]
                if None in (i, j) or not sets[x] or not sets[y]:
                    continue
                if 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]) and comp[i] > comp[j]:
                    comp[i], changed = comp[j], True
    return sorted(repr((i, len(s), comp.get(i), i == comp.get(i))) for (i, _), s in zip(rows, sets))


@pytest.mark.parametrize("words, percent", [(3, 85), (5, 80)])
def test_near_dedup(spark, words, percent):
    rows = awkward()
    # a chain in which only neighbours are alike enough, and texts that share half
    chain = prose(8, 100).split(" ")
    for k in range(6):
        rows.append((40 - k, " ".join(chain)))
        chain[10 * k + 5] = f"new{k}"
    rows += [(60 + k, " ".join(prose(9, 60).split(" ") + prose(70 + k, 50).split(" "))) for k in range(12)]
    got = near_dedup(documents(spark, rows), words=words, percent=percent)
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute_near(rows, words, percent)


def test_near_dedup_empty_and_drop(spark):
    docs = documents(spark, awkward())
    assert near_dedup(docs.limit(0)).count() == 0
    left = drop_near_copies(docs, words=3, percent=85)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == [2, 3, 5, 7, 9, 12, 12, 13, 14, 15]


def test_signatures_estimate_similarity():
    one = shingle_set(prose(20, 400), 3)
    two = shingle_set(prose(20, 400) + " " + prose(21, 100), 3)
    short = shingle_set("a b", 3)
    same = len(set(one.tolist()) & set(two.tolist())) / len(set(one.tolist()) | set(two.tolist()))
    made = super_minhash([one, two, short, one], 192)
    assert abs((made[0] == made[1]).mean() - same) < 0.12
    assert (made[0] == made[3]).all()
    assert (made < 2**63).all()
    assert (1 - 0.85 ** rows_per_band(192, 0.85)) ** (192 // rows_per_band(192, 0.85)) <= 1e-6


def brute_strings(rows, length):
    seen = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            seen[b[p : p + length]] = seen.get(b[p : p + length], 0) + 1
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = [True] * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(map(repr, out))


def test_suffix_dedup(spark):
    rows = [r for r in awkward() if r[0] != 14] + [(14, prose(4, 3000)), (16, "a" * 500), (17, "ab" * 150), (18, prose(30, 30)[:199])]
    shared = prose(31, 80)[:200]
    rows += [(20, "x" + shared), (21, shared + "y"), (22, shared[:199] + "z"), (23, "é" * 100 + prose(32, 200))]
    got = suffix_dedup(documents(spark, rows))
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute_strings(rows, 200)


def test_suffix_dedup_segments_and_empty(spark, tmp_path, monkeypatch):
    import rillmark.llm.suffix_dedup as own

    monkeypatch.setattr(own, "SEGMENT", 300)
    from rillmark.llm.suffix_dedup import Segment, segments

    text = prose(33, 600).encode()
    assert sum(s.owned for _, s in segments(text, 200)) == len(text) - 199
    rows = [(1, prose(33, 600)), (2, "q " + prose(33, 600)[700:1500])]
    documents(spark, rows).write.parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))
    assert sorted(repr(tuple(r)) for r in suffix_dedup(docs).collect()) == brute_strings(rows, 200)
    assert suffix_dedup(docs.limit(0)).count() == 0
    assert Segment is own.Segment


def test_an_id_used_twice_loses_only_its_own_copy(spark):
    base, other = prose(41, 150), prose(42, 150)
    near = base.split(" ")
    near[70] = "changed"
    rows = [(1, base), (12, " ".join(near)), (12, other), (12, other), (13, other + " more"), (14, None), (14, ""), (None, base)]
    kept = drop_near_copies(documents(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == sorted([(1, base), (12, other), (12, other), (14, ""), (14, ""), (0, base)])
    found = near_dedup(documents(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in found) == sorted(
        [(1, 1, True), (12, 1, False), (12, 12, True), (12, 12, True), (13, 12, False), (14, 14, True), (14, 14, True), (0, 0, True)]
    )


@pytest.mark.parametrize("few", [0, 100_000])
def test_components_by_stars_and_in_one_task(spark, monkeypatch, few):
    import random

    from rillmark.llm import components as comp

    monkeypatch.setattr(comp, "FEW_LINKS", few)
    rnd = random.Random(3)
    links = [(rnd.randint(-500, 500), rnd.randint(-500, 500)) for _ in range(450)] + [(600, 600 + k) for k in range(200)]
    low = {x: x for pair in links for x in pair}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            least = min(low[a], low[b])
            changed |= (low[a], low[b]) != (least, least)
            low[a] = low[b] = least
    found = comp.components(spark.createDataFrame(links, "a bigint, b bigint").repartition(5), "a", "b")
    assert {r.node: r.component for r in found.collect()} == {x: c for x, c in low.items() if x != c}
