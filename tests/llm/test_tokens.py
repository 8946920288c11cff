"""Token counts against the tokenizer itself."""

import json
import zlib
from pathlib import Path

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickloom.llm import tokens

DATA = Path("/root/testdata/sf0.001")
PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
LENGTHS = tokens.Lengths(PATH, {"the": 1, "and": 1})


def want(text):
    return len(TOKENIZER.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=30), st.sampled_from([" the", "'s", "'re", "  ", "\n\n", "\t", " ", "　", "<|endoftext|>", "<|endof", "text|>", "é", "漢字", "\U0001f600", "౜", "\U00010940", "١٢", "x" * 50, "?!"])), max_size=12))
def test_any_text(parts):
    text = "".join(parts)
    assert LENGTHS.of_text(text) == LENGTHS.of_text(text) == want(text)
    before, tokens.SLICE = tokens.SLICE, 5
    try:
        assert LENGTHS.of_text(text) == want(text)
    finally:
        tokens.SLICE = before


def test_a_cut_before_a_space_changes_nothing_whatever_is_beside_it():
    chars = [chr(c) for c in [*range(0x3100), *range(0xA000, 0xA030), *range(0xFB00, 0x10000), *range(0x1F600, 0x1F610)]]
    for text in ("a{} b", "a {}b", "a{}  b", "a  {}b", "a{} \n b", "' {}s"):
        texts = [text.format(c) for c in chars]
        assert list(map(LENGTHS.of_text, texts)) == [len(x.ids) for x in TOKENIZER.encode_batch(texts, add_special_tokens=False)]


def test_caches_are_bounded_and_change_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    lengths = tokens.Lengths(PATH, {"word1": 2})
    texts = [f"word{k} another{k % 3} {'y' * k}" for k in range(60)]
    for _ in range(2):
        assert list(map(lengths.of_text, texts)) == list(map(want, texts))
        assert len(lengths.lengths) <= 6


@pytest.mark.parametrize("char", [" ", "\n", "a"])
def test_long_runs(spark, char):
    text = f"x{char * 1_000_000}y"
    got = tokens.token_counts(spark.createDataFrame([(1, text), (2, char * 5)], "doc_id long, text string")).collect()
    assert {r.id: (r.n_tokens, r.n_bytes) for r in got} == {1: (want(text), len(text.encode())), 2: (want(char * 5), len((char * 5).encode()))}


def test_nulls_repeats_limits_and_clashing_columns(spark):
    rows = [(1, None, "a"), (1, None, "a"), (None, "hello world", "b"), (2, "", None), (3, "the " * 512, "c"), (4, "the " * 513, "c"), (5, "a<|endoftext|>b<|endoftext|>", "")]
    got = tokens.token_counts(spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").withColumnRenamed("n_tokens", "id")).collect()
    assert sorted((r.id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted((i or 0, len((t or "").encode()), want(t), want(t) > 512) for i, t, _ in rows)
    assert tokens.token_counts(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_table_counts_the_whole_corpus(spark):
    texts = [" ".join(f"once{k}x{d}" for k in range(50)) for d in range(20)] + ["zulu " * 30]
    docs = spark.createDataFrame([(t.encode(),) for t in texts], "text binary").repartitionByRange(4, "text")  # the frequent word is in the last partition
    names, sizes = json.loads(zlib.decompress(tokens.frequent(docs, PATH, most=10)))
    assert dict(zip(names, sizes, strict=True)) == {"zulu": want(" zulu")}


def test_no_shuffle(spark, capsys):
    tokens.token_counts(spark.createDataFrame([(1, "a b c")], "doc_id long, text string")).explain()
    assert "Exchange" not in capsys.readouterr().out


@pytest.mark.skipif(not DATA.exists(), reason="needs the driver's tables")
def test_query(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.op12_token_counts(spark, str(DATA)).collect()}
    assert got == {r.doc_id: (len((r.text or "").encode()), want(r.text), want(r.text) > 512) for r in docs}
