"""Token files as an exact round trip, packing against its rules, and the pipeline stage by stage."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rillmark.llm.packing import best_fit, cut, local_search, pack, pack_documents
from rillmark.llm.token_files import TokenFile, from_planes, read_token_files, to_planes, write_token_files
from rillmark.llm.tokens import ChunkEncoder
from tests.conftest import SF_DIR
from tests.llm.cases import awkward, documents, prose


@pytest.fixture(scope="module", params=[("word_bpe_49k.json", "drop"), ("byte_bpe_50k.json", "lead")])
def encoder(request):
    return ChunkEncoder(*request.param, cache_entries=2000)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet="aB \n\t\x1c é'sX1.,́İΣσKß<|endoftext|>\u00a0\u2003", max_size=40), max_size=4))
def test_chunks_give_the_ids_of_the_whole(encoder, texts):
    assert list(encoder.encode_batch(texts)) == encoder.raw(texts)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(max_codepoint=255), st.sampled_from("aS  \n'12.")), max_size=60), max_size=4))
def test_units_of_latin_give_the_ids_of_the_whole(encoder, texts):
    assert list(encoder.encode_batch(texts)) == encoder.raw(texts)


def test_all_pairs_of_latin_characters(encoder):
    chars = [chr(k) for k in range(256)]
    texts = ["".join(f"x{a}{b}y {a}{b}" for b in chars) for a in chars] + [f"{a} {b}'s{a}" for a in chars for b in "a1'. \n\xa0"]
    assert list(encoder.encode_batch(texts)) == encoder.raw(texts)


def test_special_tokens_in_texts(encoder, monkeypatch):
    import rillmark.llm.tokens as own

    names = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof"]
    texts = [t.replace("{}", n) for n in names for t in ("{}", "One {} two", "one{}two, ß three", " {}  \n{}", "Ω {} Two {}x Σ", "{} ")]
    assert encoder.encode(texts) == encoder.raw(texts)
    monkeypatch.setattr(own, "SEGMENT", 10)
    assert encoder.encode(texts) == encoder.raw(texts)


def test_known_words_in_other_forms_are_not_encoded_again(encoder, monkeypatch):
    words = prose(6, 50).split(" ")
    texts = ["x " + " ".join(words) + ", x .!\nx"]
    encoder.encode(texts)
    texts += ["x " + end.join(f" {w}" for w in words).lstrip() + end for end in (",", ".", "\nx", " x,")]
    texts = [t.replace("x ", "x, ", 1) for t in texts]
    want = encoder.raw(texts)
    calls = []
    monkeypatch.setattr(encoder, "joined", lambda units: calls.append(units))
    monkeypatch.setattr(encoder, "raw", lambda units: calls.append(units) or [b""] * len(units))
    got = encoder.encode(texts)
    assert not any(calls)
    assert got == want


@pytest.mark.parametrize("words", [["слово", "Ёлка"], ["word", "“Word”", "été"], ["日本語", "x", "ﬁn", "İs", "ΑΣ"]])
def test_other_scripts(encoder, words):
    rnd = random.Random(7)
    texts = ["".join(rnd.choice([*words, *words, " ", " ", "  ", ", ", "\n", "'s ", " 12", "\u3000"]) for _ in range(300)) for _ in range(20)]
    assert list(encoder.encode_batch(texts)) == encoder.raw(texts)


def test_small_cache_and_long_words():
    for vocabulary in (("word_bpe_49k.json", "drop"), ("byte_bpe_50k.json", "lead")):
        small = ChunkEncoder(*vocabulary, cache_entries=40)
        texts = [prose(k % 5, 30) + " " + "ab" * 50 + ("Ω" * (k % 3)) + " end." for k in range(40)]
        assert list(small.encode_batch(texts, at_once=3)) == small.raw(texts)


def test_long_text_in_segments(encoder, monkeypatch):
    import rillmark.llm.tokens as own

    monkeypatch.setattr(own, "SEGMENT", 50)
    rnd = random.Random(2)
    text = "".join(rnd.choice("ab  \n.x") for _ in range(3000))
    assert encoder.encode([text]) == encoder.raw([text])


@pytest.mark.parametrize("bits", [1, 8])
def test_planes_round_trip(bits):
    for ids in ([0], [1, 2, 3], [2**32 - 1, 0, 70_000], list(range(1000))):
        ids = np.array(ids, dtype="<u4")
        assert (from_planes(to_planes(ids, bits), len(ids), bits) == ids).all()


@pytest.mark.parametrize("bits, block", [(1, 1 << 16), (8, 100)])
def test_token_files(spark, bits, block):
    rows = awkward()
    files = write_token_files(documents(spark, rows), "word_bpe_49k.json", block_ids=block, plane_bits=bits)
    got = [tuple(r) for r in read_token_files(files).collect()]
    plain = ChunkEncoder("word_bpe_49k.json", "drop").raw([t or "" for _, t in rows])
    ids = [(i, p + b"\1\0\0\0") for (i, _), p in zip(rows, plain)]
    assert sorted((repr(i), n, c) for i, _, n, c in got) == sorted((repr(i), len(x) // 4, zlib.crc32(x)) for i, x in ids)
    got.sort(key=lambda r: r[1])
    assert [r[1] for r in got] == [sum(r[2] for r in got[:k]) for k in range(len(got))]
    assert [r[0] for r in got] == sorted((r[0] for r in got), key=lambda i: (i is not None, i))
    assert sum(TokenFile(p.path).n_ids for p in files.collect()) == sum(r[2] for r in got)


def test_token_files_of_nothing(spark):
    docs = documents(spark, awkward())
    assert read_token_files(write_token_files(docs.limit(0), "word_bpe_49k.json")).count() == 0


def test_cut():
    assert cut(0, 4) == [(0, 0)] and cut(4, 4) == [(0, 4)] and cut(9, 4) == [(0, 1), (1, 4), (5, 4)] and cut(8, 4) == [(0, 4), (4, 4)]


def test_search_empties_bins():
    rnd = random.Random(5)
    for _ in range(4):
        lengths = [rnd.randint(200, 600) for _ in range(300)]
        bins = pack(lengths, 1024)
        assert sorted(i for b in bins for _, i in b) == list(range(300))
        assert all(sum(n for n, _ in b) <= 1024 for b in bins)
        assert len(bins) <= len(best_fit(lengths, 1024))
    # best fit takes three bins here; an exchange makes two
    lengths = [6, 5, 4, 3, 2]
    assert len(pack(lengths, 10)) == 2


def raising_step(bins, capacity):
    """A move or exchange between two underfull bins that raises the sum of squared fills, by brute force."""
    left = [[n for n, _ in b] for b in bins if sum(n for n, _ in b) < capacity]
    if sum(capacity - sum(b) for b in left) < capacity:
        return None
    groups = [[(0, 0)] + [(1, n) for n in b] + [(2, b[i] + b[j]) for i in range(len(b)) for j in range(i)] for b in left]
    for x, giver in enumerate(left):
        for y, taker in enumerate(left):
            for many, out in groups[x]:
                for few, back in groups[y]:
                    gain = out - back
                    if x != y and many + few < 4 and 0 < gain <= capacity - sum(taker) and sum(taker) + gain > sum(giver):
                        return giver, taker, out, back
    return None


@pytest.mark.parametrize("capacity, low, high, count", [(30, 6, 18, 60), (60, 11, 40, 80), (1024, 200, 600, 250), (1024, 520, 700, 150)])
def test_search_leaves_no_step(capacity, low, high, count):
    rnd = random.Random(count)
    for _ in range(5):
        lengths = [rnd.randint(low, high) for _ in range(count)]
        bins = pack(lengths, capacity)
        assert sorted(i for b in bins for _, i in b) == list(range(count)) and all(sum(n for n, _ in b) <= capacity for b in bins)
        assert raising_step(bins, capacity) is None


def test_every_underfull_bin_gives():
    # the 70 emptiest bins have no step, two fuller ones can exchange 40 for 38
    bins = [[(70, k)] for k in range(70)] + [[(40, 70), (33, 71)], [(41, 72), (38, 73)]]
    assert raising_step(bins, 100)
    done = local_search(bins, 100)
    assert raising_step(done, 100) is None and sorted(i for b in done for _, i in b) == list(range(74))


def test_one_for_two():
    done = local_search([[(50, 0)], [(20, 1), (25, 2), (50, 3)], [(70, 4)], [(70, 5)]], 100)
    assert {0, 3} in [{i for _, i in b} for b in done]


def test_pack_documents(spark):
    rows = awkward()
    got = pack_documents(documents(spark, rows), "byte_bpe_50k.json", capacity=256, pieces_at_once=5).collect()
    plain = ChunkEncoder("byte_bpe_50k.json", "lead").raw([t or "" for _, t in rows])
    want = []
    for (i, _), p in zip(rows, plain):
        x = p + b"\2\0\0\0"
        want += [(i, k, s, n, zlib.crc32(x[4 * s : 4 * (s + n)])) for k, (s, n) in enumerate(cut(len(x) // 4, 256))]
    assert sorted(repr(tuple(r)[:5]) for r in got) == sorted(map(repr, want))
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        b.sort()
        assert [o for o, _ in b] == [sum(n for _, n in b[:k]) for k in range(len(b))]
        assert sum(n for _, n in b) <= 256
    assert pack_documents(documents(spark, rows).limit(0), "byte_bpe_50k.json").count() == 0


def test_pipeline_stages(spark):
    import re

    import corpus_pipeline as own
    from rillmark.llm.decontaminate import Matcher
    from tests.llm.test_dedup import brute_near

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id: r.text for r in docs.collect()}
    seen = dict(before)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    for name, stage in own.STAGES[:4]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        now = {r.doc_id: r.text for r in docs.collect()}
        if name == "exact_dedup":
            first = {}
            for i in sorted(seen):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", seen[i] or ""), i)
            assert set(now) == set(first.values())
        if name == "near_dedup":
            near = brute_near(sorted(seen.items()), 5, 80)
            assert {repr(i) for i in now} == {x[1:].split(",")[0] for x in near if x.endswith("True)")}
        if name == "decontamination":
            matcher = Matcher(items, 0.08, 25)
            assert set(now) == {i for i, t in seen.items() if not matcher.find(t)}
        assert set(now) <= set(seen) and now
        seen = now
    packed = own.STAGES[4][1](spark, docs, SF_DIR).collect()
    assert {r.doc_id for r in packed} == set(seen)
    assert own.ORACLE_SQL is None and len(own.STAGES) == 5


def test_queries_registered():
    from __spark_entry__ import oracle_sql, queries

    found = sorted(int(n[2:].split("_")[0]) for n in queries() if n.startswith("op"))
    assert found == list(range(1, 14)) and "pipeline" in queries()
    assert {"op1_exact_dedup", "op3_url_filter", "op12_collocations", "op13_centroids"} <= set(oracle_sql())


@pytest.mark.parametrize("parts", [1, 8, 64])
@pytest.mark.parametrize("at_once", [65_536, 50])
def test_sequences_do_not_depend_on_how_texts_are_dealt(spark, parts, at_once):
    rows = [(k, prose(k, 20)) for k in range(200)]
    docs = documents(spark, rows).repartition(parts)
    found = pack_documents(docs, "byte_bpe_50k.json", pieces_at_once=at_once).collect()
    total = sum(r.length for r in found)
    # sets of fifty pieces, which are under three sequences each, may cost a little
    least = -(-total // 1024)
    assert len(found) == 200 and least <= len({r.sequence_id for r in found}) <= least + 2 * (at_once == 50)
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in by_sequence.values():
        held.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(held, held[1:])) and held[0][0] == 0 and sum(held[-1]) <= 1024
