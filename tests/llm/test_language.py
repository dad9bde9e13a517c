"""Language model, collocations and centroids against plain versions of the same rules."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from rillmark.llm import collocations as col
from rillmark.llm import language_model as lm
from rillmark.llm.centroids import centroid_clusters, pack_signed, square_distances, unpack_signed
from rillmark.llm.collocations import collocations
from rillmark.llm.language_model import language_model_scores
from rillmark.llm.ngrams import pack_numbers, pack_sorted, unpack_numbers, unpack_sorted
from tests.llm.cases import CLASHING, awkward, documents, prose


def test_numbers_as_bytes():
    rnd = np.random.default_rng(1)
    for values in ([], [0], [0, 0], [1, 2**63], rnd.integers(0, 2**40, 1000)):
        values = np.array(values, dtype="u8")
        assert np.array_equal(unpack_numbers(pack_numbers(values)), values)
        assert np.array_equal(unpack_sorted(pack_sorted(np.sort(values))), np.sort(values))
    signed = rnd.integers(-(2**27), 2**27, (7, 3))
    assert (unpack_signed(pack_signed(signed), 3) == signed).all()


# Language model.


def plain_scores(rows, strength=(1000.0, 10.0)):
    def words(text):
        return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    def out(i):
        return zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2

    one, two, three = Counter(), Counter(), Counter()
    for i, text in rows:
        if not out(i):
            s = ["<s>", *words(text), "</s>"]
            one.update(s[1:])
            two.update(zip(s, s[1:]))
            three.update(zip(s, s[1:], s[2:]))
    n, v = sum(one.values()), len(one)
    texts = one["</s>"]

    def chance(s, k):
        p = (one[s[k]] + 1) / (n + v + 1)
        before = texts if k == 1 else one[s[k - 1]]
        p = (two[s[k - 1], s[k]] + strength[0] * p) / (before + strength[0])
        if k > 1:
            p = (three[s[k - 2], s[k - 1], s[k]] + strength[1] * p) / (two[s[k - 2], s[k - 1]] + strength[1])
        return p

    found = []
    for i, text in rows:
        s = ["<s>", *words(text), "</s>"]
        base = sum(math.log10((one[w] + 1) / (n + v + 1)) for w in s[1:])
        score = sum(math.log10(chance(s, k)) for k in range(1, len(s)))
        found.append((i, out(i), len(s) - 1, sum(one[w] > 0 for w in s[1:]), n, base, score))
    return found


def same_scores(got, want):
    def key(r):
        return (r[0] is None, r[0] or 0, r[2], round(r[6], 6))

    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


@pytest.mark.parametrize("size", [1, 400, 1 << 24])
def test_scores_of_awkward_texts(spark, monkeypatch, size):
    monkeypatch.setattr(lm, "BLOCK_BYTES", size)
    rnd = random.Random(3)
    rows = awkward() + [(100 + k, " ".join(rnd.choice(["the", "of", "Cat", "dog.", "x"]) for _ in range(rnd.randint(0, 30)))) for k in range(60)]
    same_scores([tuple(r) for r in language_model_scores(documents(spark, rows)).collect()], plain_scores(rows))


def test_scores_without_training(spark):
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    rows = [(only, "a b")]
    got = [tuple(r) for r in language_model_scores(documents(spark, rows)).collect()]
    assert got == [(only, True, 3, 0, 0, 0.0, 0.0)]
    assert language_model_scores(documents(spark, rows).limit(0)).count() == 0


def test_held_out_texts_score_better_than_by_words_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [r for r in language_model_scores(docs).collect() if r.held_out]
    assert rows and sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_chances_of_a_history_add_up():
    texts = [t.encode() for t in ("a b a", "b c", "", "a a b c a")]
    words = ["a", "b", "c", "new"]
    # every word, and the end, after the text "a b"
    asked = [f"a b {w}".encode() for w in words]
    block = lm.Block([*texts, *asked, b"a b"])
    train = np.array([True] * len(texts) + [False] * (len(asked) + 1))
    counts = {n: block.counts(n, train) for n in lm.ORDERS}
    n, v = int(counts[1].sum()), int((counts[1] > 0).sum())
    machine = lm.Automaton(block, counts, n, v, {2: 3.0, 3: 2.0})
    ends = np.cumsum(block.lengths) + 1
    starts = ends - block.lengths

    def prefix(k, size):
        return machine.traverse(*(block.at[o][starts[k] : starts[k] + size].tolist() for o in lm.ORDERS))

    last = [10 ** (prefix(k, 3) - prefix(k, 2)) for k in range(len(texts), len(texts) + len(asked) + 1)]
    assert sum(last) == pytest.approx(1.0)


# Collocations.


def plain_collocations(rows, words=3, threshold=10, per_lang=2000):
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in range(1, words + 1):
                f[lang].update(tuple(w[k : k + n]) for k in range(len(w) - n + 1))
    out = []
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= threshold}
        longest = Counter()
        for p, a in found.items():
            for n in range(2, len(p)):
                for k in range(len(p) - n + 1):
                    longest[p[k : k + n]] = max(longest[p[k : k + n]], a)
        scored = []
        for p, a in found.items():
            if longest[p] and 100 * longest[p] >= 50 * a:
                continue
            score, k = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:per_lang], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def texts_with_lang(spark, rows):
    names = CLASHING.replace("n bigint, ", "rank bigint, ")
    extra = (7, 8, "k", "x", "p", 9, "m", 1, "a", "s")
    return spark.createDataFrame([(*r, *extra) for r in rows], f"lang string, text string, {names}").repartition(3)


def some_texts():
    rnd = random.Random(5)
    words = ["New", "york", "city", "the", "of", "été", "a|b", "x y", "#", " "]
    rows = [(rnd.choice(["en", "en", "en", "fr", None]), "".join(rnd.choice(words) + rnd.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\x0b"]) for _ in range(rnd.randint(0, 80)))) for _ in range(300)]
    return rows + [("en", None), (None, None), ("de", ""), ("en", "new york city " * 50), ("en", "new york city " * 50), ("", "a b " * 10)]


@pytest.mark.parametrize("segment", [1 << 22, 64])
def test_collocations(spark, monkeypatch, segment):
    monkeypatch.setattr(col, "SEGMENT", segment)
    rows = some_texts()
    got = sorted(tuple(r) for r in collocations(texts_with_lang(spark, rows)).collect())
    assert got == plain_collocations(rows)
    few = sorted(tuple(r) for r in collocations(texts_with_lang(spark, rows), per_lang=3).collect())
    assert few == plain_collocations(rows, per_lang=3)


def test_collocations_of_nothing(spark):
    assert collocations(texts_with_lang(spark, [("en", None)])).count() == 0
    assert collocations(texts_with_lang(spark, [("en", "a")]).limit(0)).count() == 0


def test_long_texts_lose_nothing_at_cuts(monkeypatch):
    monkeypatch.setattr(col, "SEGMENT", 40)
    text = prose(8, 500).encode()
    seen = Counter()
    for words, before in col.pieces([text, b"a b", text]):
        known = col.Words()
        ids = known.numbers(words)
        for n in (1, 2, 3):
            seen.update(tuple(words[k : k + n]) for k in col.starts_of(ids, n, before))
    w = text.lower().split()
    want = Counter()
    for some in (w, w, [b"a", b"b"]):
        for n in (1, 2, 3):
            want.update(tuple(some[k : k + n]) for k in range(len(some) - n + 1))
    assert seen == want


def test_summaries_keep_what_is_frequent():
    rnd = np.random.default_rng(2)
    # 40 frequent keys of just the threshold, hidden among many rare ones, dealt to tasks in any way
    all_keys = np.concatenate([np.repeat(np.arange(40, dtype="u8"), 10), rnd.integers(1000, 2**40, 20_000).astype("u8")])
    rnd.shuffle(all_keys)
    tasks = np.array_split(all_keys, 13)
    parts = [(len(t), *(f(x) for f, x in zip((pack_sorted, pack_numbers), col.counted(t)))) for t in tasks]
    assert set(range(40)) <= set(col.survivors(parts, 10).tolist())
    capacity = len(all_keys) // 10 + 1
    keys, counts = np.zeros(0, dtype="u8"), np.zeros(0, dtype=np.int64)
    for t in tasks:
        keys, counts = col.merged(keys, counts, col.counted(t), capacity)
        assert len(keys) <= capacity
    assert set(range(40)) <= set(keys.tolist())


# Centroids.


def plain_centroids(rows, k=16, rounds=3, dims=64):
    kept = [(i, np.floor(64 * np.array(x, dtype=float)).astype(int)) for i, x in rows if x is not None and len(x) == dims and all(v is not None and np.isfinite(v) for v in x)]
    first = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), x.tolist()) for i, x in kept if i is not None)[:k]
    c = np.array([x for _, x in first])
    x = np.array([x for _, x in kept])

    def nearest():
        d = ((x[:, None] - c[None]) ** 2).sum(2)
        return d.argmin(1), d.min(1)

    for _ in range(rounds):
        t, _d = nearest()
        for j in range(len(c)):
            if (t == j).any():
                c[j] = x[t == j].sum(0) // (t == j).sum()
    t, d = nearest()
    digest = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in c.tolist()]
    return [(i, int(a), int(b), int(d[t == a].sum()), int(d.sum()), digest[a]) for (i, _), a, b in zip(kept, t, d)]


def vectors(spark, rows):
    extra = (3, 4, "s", 5, 6)
    return spark.createDataFrame([(*r, *extra) for r in rows], "vec_id bigint, embedding array<float>, chunk bigint, block int, slice string, cluster int, _x int")


@pytest.mark.parametrize("shards, chunk_rows", [(1, 4096), (4, 7), (64, 50)])
def test_centroids(spark, shards, chunk_rows):
    rnd = np.random.default_rng(4)
    rows = [(i, rnd.normal(size=64).astype("f4").tolist()) for i in range(150)]
    rows += [rows[3], (None, rows[4][1]), (7, rows[9][1]), (200, None), (201, []), (202, [1.0] * 63), (203, [1.0] * 63 + [None])]
    rows += [(204, [math.nan] * 64), (205, [math.inf] + [0.0] * 63), *[(300 + i, rows[5][1]) for i in range(80)]]
    got = centroid_clusters(vectors(spark, rows).repartition(3), shards=shards, chunk_rows=chunk_rows).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(plain_centroids(rows), key=key)


def test_few_and_far_vectors(spark):
    rows = [(1, [0.5] * 64), (2, [-0.25] * 64), (3, [0.5] * 64)]
    got = centroid_clusters(vectors(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(plain_centroids(rows))
    assert centroid_clusters(vectors(spark, rows).limit(0)).count() == 0
    with pytest.raises(Exception, match="64 bits"):
        centroid_clusters(vectors(spark, [(1, [1e9] * 64)])).count()


def test_distances_are_exact_at_any_size():
    rnd = np.random.default_rng(6)
    for most in (10, 2**27):
        x, c = rnd.integers(-most, most, (20, 16)), rnd.integers(-most, most, (5, 16))
        assert (square_distances(x, c) == ((x[:, None] - c[None]) ** 2).sum(2)).all()
