"""Kernels and similarity join against Python's own matcher, used as brute force."""

from __future__ import annotations

import random
from difflib import SequenceMatcher

import numpy as np
import pytest

from tastemine.operators import fuzzy, lookup

ALPHABETS = ["ab", "abc", "abcdefgh ", "abcdefghijklmnopqrstuvwxyz ", "aé😀ß "]


def _pair(rng, most=40):
    letters = rng.choice(ALPHABETS)
    word = lambda n: "".join(rng.choice(letters) for _ in range(n))
    first = word(rng.randint(1, most))
    second = word(rng.randint(1, most)) if rng.random() < 0.4 else "".join(c for c in first if rng.random() < 0.85) + word(rng.randint(0, 5))
    return first, second or "a"


def test_ratio_of_short_texts():
    rng = random.Random(1)
    pairs = [_pair(rng) for _ in range(6000)] + [_pair(rng, 63) for _ in range(500)] + [("a", "a"), ("a", "b"), ("x" * 63, "x" * 63)]
    exact = np.array([SequenceMatcher(None, a, b).ratio() for a, b in pairs])
    passed, ratio = fuzzy.pair_ratios(*map(list, zip(*pairs, strict=True)))
    assert ((exact > 0.7) <= passed).all()  # the filter loses nothing
    assert np.array_equal(exact[passed], ratio[passed])
    assert np.array_equal(exact, fuzzy.pair_ratios(*map(list, zip(*pairs, strict=True)), cutoff=-1.0)[1])


@pytest.mark.parametrize("size", [64, 199, 200, 201, 450])
def test_ratio_of_long_texts_with_popular_characters(size):
    rng = random.Random(size)
    for _ in range(15):
        letters = rng.choice(ALPHABETS)
        first = "".join(rng.choice(letters) for _ in range(size))
        second = "".join(c if rng.random() < 0.8 else rng.choice(letters) for c in first) + "ab" * rng.randint(0, 4)
        assert fuzzy.pair_ratios([first], [second])[1][0] == SequenceMatcher(None, first, second).ratio()


def test_join_loses_nothing(spark):
    rng = random.Random(4)
    words = ["red", "green", "bolt", "gear", "small", "large", "rod", "Ünder", "The", "of", "night", "day"]
    title = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(1, 5)))
    plain = sorted({title() for _ in range(150)})
    titles = [*plain, "aaaa", "a", "The " * 20, None, ""]
    spoilt = lambda t: "".join(c for c in t if rng.random() > 0.15)
    queries = sorted({spoilt(rng.choice(plain)) for _ in range(2300)} - {""})[:2000] + ["AAAA", None, "", "the " * 19]
    q, t = spark.createDataFrame([(x,) for x in queries], "query string"), spark.createDataFrame([(x,) for x in titles], "title string")
    expected = {}
    for a in {x.lower() for x in queries if x}:
        for b in {x.lower() for x in titles if x}:
            ratio = SequenceMatcher(None, a, b).ratio()
            if ratio > 0.7:
                expected[a, b] = ratio
    got = fuzzy.similar(q, t).collect()
    assert len(got) == len(expected) > 1000
    assert {(r["_q"], r["_t"]): r["ratio"] for r in got} == expected
    report = fuzzy.filter_report(q, t).first()
    assert report["similar"] == len(expected)
    assert report["pairs"] > report["by_length"] > report["by_characters"] > report["by_subsequence"] >= report["similar"]
    scored = {(r["query"], r["title"]): r["score"] for r in lookup.match_titles_fuzzy(q, t).collect()}
    for a in queries:
        for b in titles:
            if a and b:
                x, y = a.lower(), b.lower()
                assert scored.get((a, b)) == (2.0 if x == y else 1.5 if x in y else expected.get((x, y)))


def test_nothing_to_match(spark):
    none = spark.createDataFrame([], "query string, title string")
    some = spark.createDataFrame([("a", "a")], "query string, title string")
    for q, t in ((none, some), (some, none), (none, none)):
        assert fuzzy.similar(q, t).count() == 0
        assert fuzzy.filter_report(q, t).first()["similar"] == 0


def test_rules_of_a_misspelt_title(spark):
    rules = spark.createDataFrame([(["Red Bolt"], ["gear"], 2.0, 0.5), (["red belt"], ["rod"], 3.0, 0.6), (["nut"], ["screw"], 9.0, 0.9)],
                                  "antecedents array<string>, consequents array<string>, lift double, confidence double")
    q = spark.createDataFrame([("red bollt",), ("zzz",)], "query string")
    got = lookup.rule_recommendations(q, rules, cutoff=fuzzy.CUTOFF).orderBy("rank").collect()
    assert [(r["query"], r["searched_movie"], r["movie_title"]) for r in got] == [("red bollt", "Red Bolt", "rod"), ("red bollt", "Red Bolt", "gear")]
    assert lookup.rule_recommendations(q, rules).count() == 0
