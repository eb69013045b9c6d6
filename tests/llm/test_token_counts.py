"""Token counts against the tokenizer itself."""

from __future__ import annotations

import random

import pytest

from tastemine.llm import token_counts

SCHEMA = "doc_id bigint, text string, n_bytes string, _t int, n_tokens double, _n string"
BITS = ["<|endoftext|>", "<|endof", "<|", "|>", " ", "  ", "\n\t", "it's", "'ll", "don", "՘", "\U0001094b", "꟎", "é", "ß", "你", "好", "🤦🏼", "1", "२", "²", "\x1c",
        "\x85", "　", "!!", " a", "\x00", "​", "word", "Zz", "antidisestablishment", "the", " the"]


@pytest.fixture(scope="module")
def tokenizer():
    return token_counts._load(token_counts.tokenizer_path())


def _texts():
    rng = random.Random(1)
    out = [None, "", " ", "\n", "x", "a" * 20_000, " " * 3000, "<|endoftext|>" * 40, "the cat " * 50_000, "é" * 3000]
    return out + ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 30))) for _ in range(1500)]


def test_whole_tokens_are_proved(tokenizer):
    whole = token_counts.whole_tokens(token_counts.tokenizer_path(), token_counts.pattern())
    assert len(whole) > 40_000
    assert {" the", "the", "\n", "!!"} <= set(whole)
    assert "'sa" not in whole and "<|endoftext|>" not in whole


@pytest.mark.parametrize(("remembered", "long"), [(2_000_000, 1_000_000), (300, 20)])
def test_counter(tokenizer, monkeypatch, remembered, long):
    monkeypatch.setattr(token_counts, "REMEMBERED", remembered)
    monkeypatch.setattr(token_counts, "LONG", long)
    monkeypatch.setattr(token_counts, "_AT_ONCE", 7)
    counter = token_counts.Counter(token_counts.tokenizer_path(), token_counts.pattern(), token_counts.whole_tokens(token_counts.tokenizer_path(), token_counts.pattern()))
    for text in filter(None, _texts()):
        if len(text) < 30_000 or long > 1000:
            assert counter.count(text) == len(tokenizer.encode(text, add_special_tokens=False).ids), text[:50]
    assert counter.doubtful  # some of the characters above came to the pattern with a later Unicode version


def test_operator(spark, tokenizer):
    rows = [(k, t) for k, t in enumerate(_texts())] + [(5, "again"), (5, "again"), (None, "no id")]
    df = spark.createDataFrame([(*r, "x", 1, 2.0, "y") for r in rows], SCHEMA).repartition(3)
    out = token_counts.count_tokens(df, limit=30)
    assert out.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    expected = []
    for k, t in rows:
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        expected.append((k, len((t or "").encode()), n, n > 30))
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted((tuple(r) for r in out.collect()), key=key) == sorted(expected, key=key)
    assert token_counts.count_tokens(spark.createDataFrame([], SCHEMA)).count() == 0


def test_bytes_that_are_not_utf8(spark):
    df = spark.sql("select 1L as doc_id, cast(X'61FF62' as string) as text")
    assert tuple(token_counts.count_tokens(df).first())[:2] == (1, 3)
