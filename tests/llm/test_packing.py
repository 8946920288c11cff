import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickloom.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.text("abcdef", min_size=1, max_size=3), st.integers(1, 3000), min_size=1, max_size=9))
def test_schedule_deals_each_slot_once(sizes):
    s = packing.Schedule(sizes)
    slots = np.sort(np.concatenate([s.slot(q, np.arange(n)) for q, n in sizes.items()]))
    assert (slots == np.arange(sum(sizes.values()))).all()
    for q, n in sizes.items():
        upto = np.arange(sum(sizes.values()) + 1)
        have, _ = s.served(q, upto)
        assert have[-1] == n and (np.diff(have) >= 0).all()
        assert np.abs(have - upto * n / upto[-1]).max() <= len(s.paths[q]) + 1


@given(st.integers(0, 2**50), st.integers(1, 2**50), st.integers(1, 2**50))
def test_muldiv_is_exact(n, a, m):
    a = min(a, m)
    q, r = packing.muldiv(n, a, m)
    assert (int(q), int(r)) == divmod(n * a, m)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 9000), min_size=1, max_size=24))
def test_windows_are_gapless(sizes):
    places = packing.Places({f"q{i}": n for i, n in enumerate(sizes)})
    windows = defaultdict(list)
    for i, n in enumerate(sizes):
        cuts = np.unique(np.concatenate([[0, n], np.arange(0, n, 700)]))
        row, at, length, w, offset = places.pieces(f"q{i}", cuts[:-1], np.diff(cuts))
        assert length.sum() == n and (length > 0).all()
        for k, o, m in zip(w.tolist(), offset.tolist(), length.tolist()):
            windows[k].append((o, m))
    assert sorted(windows) == list(range(len(windows)))
    for runs in windows.values():
        end = 0
        for o, m in sorted(runs):
            assert o == end
            end += m
        assert end <= 1024


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9000), st.sampled_from([0, 0.5, 1, 3])), min_size=1, max_size=9))
def test_windows_of_phases_are_gapless_and_weighted(queues):
    sizes, weights = {f"q{i}": n for i, (n, _) in enumerate(queues)}, {f"q{i}": w for i, (_, w) in enumerate(queues)}
    quanta = {q: -(-n // packing.QUANTUM) for q, n in sizes.items()}
    dealt = packing.phases(quanta, weights)
    assert {q: sum(p.get(q, 0) for p in dealt) for q in sizes} == quanta
    places, windows, by_queue = packing.Places(sizes, weights=weights), defaultdict(list), defaultdict(lambda: defaultdict(int))
    for q, n in sizes.items():
        cuts = np.unique(np.concatenate([[0, n], np.arange(0, n, 700)]))
        row, at, length, w, offset = places.pieces(q, cuts[:-1], np.diff(cuts))
        assert length.sum() == n and (length > 0).all()
        ends = defaultdict(int)
        for r, a, k, o, m in zip(row.tolist(), at.tolist(), w.tolist(), offset.tolist(), length.tolist()):
            assert a == ends[r]
            ends[r] += m
            windows[k].append((o, m))
            by_queue[k][q] += m
    assert sorted(windows) == list(range(len(windows)))
    for runs in windows.values():
        end = 0
        for o, m in sorted(runs):
            assert o == end
            end += m
        assert end <= 1024
    # Until the first queue ends, each window has the target proportions.
    named = {q: w for q, w in weights.items() if w}
    if named:
        slots = sum(dealt[0].values())
        for k in range(slots // places.slots):
            for q, w in named.items():
                assert abs(by_queue[k][q] - 1024 * w / sum(named.values())) <= 8 * packing.QUANTUM


def test_weights(spark):
    rows = [(i, f"word{i} " * 200, "ab"[i % 2]) for i in range(60)] + [(99, "other " * 3000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    seqs, _ = check(rows, packing.pack(docs, weights={"a": 3, "b": 1}).collect())
    for w in range(5):
        assert abs(sum(n for _, n, q in seqs[w] if q == "=a") - 768) <= 2 * packing.QUANTUM
    assert {q for _, _, q in seqs[len(seqs) - 1]} == {"null"}


def check(rows, got, window=1024):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: [*t.encode(text or "", add_special_tokens=False).ids, 0] for i, text, _ in rows}
    docs, seqs = defaultdict(list), defaultdict(list)
    for r in got:
        piece = ids[r.id][r.start : r.start + r.length]
        assert len(piece) == r.length > 0 and r.doc_tokens == len(ids[r.id])
        assert r.ids_crc32 == zlib.crc32(np.array(piece, "<u4").tobytes())
        docs[r.id].append((r.start, r.length))
        seqs[r.sequence_id].append((r.offset, r.length, r.source_queue))
    assert set(docs) == set(ids)
    for found, size in ((docs, lambda k: len(ids[k])), (seqs, None)):
        for k, runs in found.items():
            at = 0
            for r in sorted(runs):
                assert r[0] == at
                at += r[1]
            assert at == size(k) if size else at <= window
    total = sum(map(len, ids.values()))
    n_sources = len({s for _, _, s in rows})
    assert len(seqs) * window - total <= window + n_sources * packing.QUANTUM
    return seqs, ids


@pytest.mark.parametrize("most", [2, 4096])
def test_pieces(spark, most):
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(f"word{k}" for k in rng.integers(0, 99, rng.integers(1, 400))), ["a", "a", "b", None, "null", "rare" if i == 7 else "c"][i % 6]) for i in range(200)]
    rows += [(900, None, "a"), (901, "", None), (902, "<|endoftext|> x", "b"), (904, "a<|endoftext|><|endoftext|> b\n<|endoftext|>", "b"), (905, "<|endoftext", "c"), (906, " <|endoftext|>\n\n<|END|>", None), (903, "long text " * 20_000, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    docs = docs.selectExpr("*", "1 AS start", "'x' AS queue")
    got = packing.pack(docs, most_sources=most).collect()
    seqs, ids = check(rows, got)
    if most > 2:
        share = defaultdict(int)
        for i, _, s in rows:
            share["=" + s if s is not None else "null"] += len(ids[i])
        total = sum(share.values())
        for w, runs in seqs.items():
            if w < len(seqs) - 2:
                for q, n in share.items():
                    assert abs(sum(r[1] for r in runs if r[2] == q) - 1024 * n / total) <= 6 * packing.QUANTUM


def test_sequences_and_empty(spark):
    docs = spark.createDataFrame([(1, "one two three " * 500, "a"), (2, "x", "b")], "doc_id long, text string, source string")
    got = {r.sequence_id: r for r in packing.sequences(packing.pack(docs, with_ids=True)).collect()}
    assert all(len(r.ids) == 1024 or len(r.ids) == r.used and r.used & (r.used - 1) == 0 for r in got.values())
    assert packing.pack(docs.limit(0)).count() == 0
    small = spark.createDataFrame([(5, "", "a")], "doc_id long, text string, source string")
    assert [(r.used, r.ids) for r in packing.sequences(packing.pack(small, with_ids=True)).collect()] == [(1, [0])]


@pytest.mark.parametrize("char", [" ", "\n", chr(0xA0), "a", "?"])
def test_long_runs_as_the_tokenizer_has_them(char):
    encode = packing.encoder(PATH)
    tokenizer = Tokenizer.from_file(PATH)
    run, short = char * 1_000_000, char * 30_000
    for text in (f"x{run}y", f"{short}<|endoftext|>{short} y", short):
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids
    if char.isspace():  # the tokenizer itself needs gigabytes here
        assert len(encode(f"x{char * 10_000_000}y")) >= 3


@pytest.mark.parametrize("length", [9_998, 9_999, 10_000, 10_001, 10_002])
@pytest.mark.parametrize("after", ["", "y", " y", "\n", "<|endoftext|>", "'s", "\ny"])
def test_runs_about_the_bound(length, after):
    text = f"it's{' ' * length}{after}"
    assert packing.encoder(PATH)(text) == Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


def test_query_with_white_space(spark, tmp_path):
    rows = [(1, "\n" * 1_000_000, "a"), (2, "a b c", "b"), (3, None, None), (None, " " * 10_000_000 + "x", "a")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = packing.op7_mixture_packing(spark, str(tmp_path)).groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    encode = packing.encoder(PATH)
    assert {r.doc_id: (r["sum(length)"], r["max(doc_tokens)"]) for r in got} == {i: (len(encode(t or "")) + 1,) * 2 for i, t, _ in rows}


def test_sources_of_the_shared_queue_take_turns(spark):
    rows = [(k, "w " * 40, f"big{k % 2}") for k in range(300)] + [(1000 + k, "w " * 40, f"small{k % 5}") for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    got = packing.pack(docs, most_sources=2).collect()
    check(rows, got)
    by = defaultdict(lambda: defaultdict(int))
    for r in got:
        by[r.sequence_id][r.source_queue] += r.length
    per = {s: sum(w[s] for w in by.values()) / len(by) for s in {f"=small{k}" for k in range(5)}}
    full = [w for s, w in by.items() if sum(w.values()) == 1024]
    assert len(full) > 5 and all(abs(w[s] - n) <= 3 * packing.QUANTUM for w in full[:-1] for s, n in per.items())
