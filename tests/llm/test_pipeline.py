"""The pipeline against its five stages in plain Python, stage by stage and as a whole."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib
from fractions import Fraction

import corpus_pipeline
import numpy as np
import pytest
from test_operators import SCHEMA, WS, _fingerprint, _roots, _rows

from tastemine.llm import packing, quality_rules

Row = tuple  # doc_id, text, source


def plain_rules(rows: list[Row]) -> list[Row]:
    out = []
    for row in rows:
        t = row[1] or ""
        ws, lines = WS.findall(t), [x for x in t.split("\n") if WS.search(x)]
        windows = [tuple(ws[k : k + 8]) for k in range(len(ws) - 7)]
        counts = collections.Counter(windows)
        n = {
            "n_words": len(ws), "word_chars": sum(map(len, ws)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t)),
            "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_upper": len(re.findall("[A-Z]", t)), "n_digits": len(re.findall("[0-9]", t)),
            "n_repeat_words": len({k + d for k, x in enumerate(windows) if counts[x] > 1 for d in range(8)}),
        }
        rules = quality_rules.POLICIES[quality_rules.CURRENT].rules
        fails = [eval(sql.replace(" OR ", " or ").replace(" AND ", " and "), {}, n) for name, sql in quality_rules.RULES if name in rules]
        if not any(fails):
            out.append(row)
    return out


def plain_exact(rows: list[Row]) -> list[Row]:
    groups = collections.defaultdict(list)
    for row in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", row[1] or "")].append(row)
    return [min(g, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0)) for g in groups.values()]


def plain_near(rows: list[Row]) -> list[Row]:
    prints = [_fingerprint(r[1] or "") for r in rows]
    roots = _roots(len(rows), [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3])
    least: dict = {}
    for r, root in zip(rows, roots, strict=True):
        if r[0] is not None:
            least[root] = min(least.get(root, r[0]), r[0])
    return [r for r, root in zip(rows, roots, strict=True) if r[0] is None or r[0] == least[root]]


def plain_mixture(rows: list[Row]) -> list[Row]:
    by = collections.defaultdict(list)
    for r in rows:
        by[r[2]].append(r)
    size = {s: sum(len(WS.findall(r[1] or "")) for r in own) for s, own in by.items()}
    order = sorted(by, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    full: set = set()
    while True:  # words per unit of weight
        free = [s for s in order if s not in full]
        level = Fraction(sum(size.values()) - sum(3 * size[s] for s in full), max(1, sum(weight[s] for s in free)))
        new = {s for s in free if 3 * size[s] < weight[s] * level}
        if not new:
            break
        full |= new
    target = {s: float(3 * size[s]) if s in full else float(weight[s] * level) for s in order}
    quota: collections.Counter = collections.Counter()
    for _ in range(int(sum(size.values()) / 32 + 0.5)):
        quota[max((s for s in order if target[s]), key=lambda s: target[s] / (2 * quota[s] + 1))] += 1
    out = []
    for s, own in by.items():
        left = min(32 * quota[s], 3 * size[s])
        own.sort(key=lambda r: (hashlib.md5(f"42:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[0] is not None, r[0] or 0))
        while left > 0:
            for r in own:
                words = list(WS.finditer(r[1] or ""))
                if words and left > 0:
                    out.append((r[0], r[1] if left >= len(words) else r[1][: words[left - 1].end()], s))
                    left -= len(words)
    return out


def plain_pieces(rows: list[Row]) -> collections.Counter:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    out: collections.Counter = collections.Counter()
    for i, t, _ in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            part = np.array(ids[k : k + 2048], dtype="<u4")
            out[i, k // 2048, k, len(part), zlib.crc32(part.tobytes())] += 1
    return out


PLAIN = [plain_rules, plain_exact, plain_near, plain_mixture]


def _counter(df) -> collections.Counter:
    return collections.Counter(tuple(r) for r in df.select("doc_id", "text", "source").collect())


def _packed(df) -> collections.Counter:
    places = collections.defaultdict(list)
    for r in df.collect():
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for rows in places.values():  # gapless, and no sequence too long
        end = 0
        for offset, length in sorted(rows):
            assert offset == end
            end += length
        assert end <= 2048
    return collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect())


def _given(spark):
    """Both a table with every awkward case, and given documents."""
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    more = [(r[0] + 10_000, *r[1:], "x", 1, 2.0, "y", 3, "z", 4, "w") for r in map(tuple, table.collect())]
    return spark.createDataFrame(_rows() + more, SCHEMA)


def test_stages(spark, tmp_path):
    docs = _given(spark)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "exact_dedup", "near_dedup", "mixing", "packing"]
    given = docs
    for (name, stage), plain in zip(corpus_pipeline.STAGES[:-1], PLAIN, strict=True):
        out = stage(spark, given, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        got, rows = spark.read.parquet(str(tmp_path / name)), [tuple(r) for r in given.select("doc_id", "text", "source").collect()]
        assert _counter(got) == collections.Counter(plain(rows)), name
        given = got
    rows = [tuple(r) for r in given.select("doc_id", "text", "source").collect()]
    assert rows and _packed(corpus_pipeline.STAGES[-1][1](spark, given, str(tmp_path))) == plain_pieces(rows)


def test_run_is_the_plain_pipeline(spark, tmp_path):
    docs = _given(spark)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    for plain in PLAIN:
        rows = plain(rows)
    assert _packed(corpus_pipeline.run(spark, str(tmp_path))) == plain_pieces(rows)


@pytest.mark.parametrize("rows", [[], [(1, None), (2, "")]])
def test_run_on_next_to_nothing(spark, tmp_path, rows):
    spark.createDataFrame([(*r, "en", "a", 0, "x", 1, 2.0, "y", 3, "z", 4, "w") for r in rows], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
