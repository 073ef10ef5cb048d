"""Periodic runs against their definition, and the grammar's extensions against plain comparison."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabscope.llm import periods
from tabscope.llm.recompression import Grammar
from tests.llm import cases


def plain_runs(x, least):
    found = []
    for q in range(1, len(x) // 2 + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            start, length = i, j - i + q
            smaller = (r for r in range(1, q) if all(x[k] == x[k + r] for k in range(start, start + length - r)))
            if j > i and length >= max(least, 2 * q) and next(smaller, None) is None:
                found.append((start, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def sample_text(draw, most=90):
    x = [draw.randrange(draw.choice([1, 2, 3, 9])) for _ in range(draw.choice([0, 1, 11, 12, 30, most]))]
    if x and draw.random() < 0.5:
        a = draw.randrange(len(x))
        p = 1 + draw.randrange(max(1, (len(x) - a) // 3 + 1))
        x = [v if i < a else x[a + (i - a) % p] for i, v in enumerate(x)]
    return x


def found_runs(texts, least):
    symbols = np.array([v for x in texts for v in x], np.int64)
    columns = periods.find_runs(symbols, np.array([len(x) for x in texts], np.int64), least)
    return list(zip(*(c.tolist() for c in columns), strict=True))


@pytest.mark.parametrize("least", [2, 3, 5, 7, 12, 13])
def test_runs_match_their_definition(least):
    draw = random.Random(least)
    for _ in range(60):
        texts = [sample_text(draw) for _ in range(draw.randint(0, 6))]
        assert found_runs(texts, least) == [(k, *r) for k, x in enumerate(texts) for r in plain_runs(x, least)]


def test_grids_cut_into_parts(monkeypatch):
    monkeypatch.setattr(periods, "PLACES", 7)
    draw = random.Random(5)
    texts = [sample_text(draw) for _ in range(20)]
    assert found_runs(texts, 12) == [(k, *r) for k, x in enumerate(texts) for r in plain_runs(x, 12)]


def test_extensions_of_all_pairs():
    draw = random.Random(3)
    for _ in range(40):
        text = sample_text(draw, 60)
        row = np.array([0, *[v + 2 for v in text], 1])
        a, b = (x.ravel() for x in np.meshgrid(np.arange(1, len(row)), np.arange(1, len(row))))
        a, b = a[a < b], b[a < b]
        grammar = Grammar(row, 2)
        ahead, behind = grammar.extensions(a, b), grammar.extensions(a, b, back=True)
        for i, j, f, g in zip(a, b, ahead, behind, strict=True):
            assert f == next(k for k in range(len(row)) if row[i + k] != row[j + k])
            assert g == next(k for k in range(len(row)) if row[i - 1 - k] != row[j - 1 - k])


def test_grammar_of_a_long_run_stays_small():
    row = np.concatenate([[0], np.tile(np.arange(2, 9), 20000), [1]])
    grammar = Grammar(row, 2)
    assert grammar.extensions(np.array([1]), np.array([8]))[0] == 7 * 19999
    assert sum(map(len, grammar.symbols)) < 6 * len(row) and len(grammar.symbols) < 120


def expected(doc_id, text, least=periods.LEAST, plant=True):
    words = cases.words(text)
    h = zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words, least)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    longest = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    collapsed = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (str(doc_id), len(runs), *longest, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
PERIODIC = "a  b\tc " * 9 + "x " + "é\n" * 15 + "中文 😀 " * 7 + " end "


def digests(df):
    return sorted(((str(r[0]), *r[1:]) for r in df.select(*COLUMNS).collect()), key=str)


def test_query_on_awkward_rows(spark):
    rows = [(i, t, *rest) for i, t, *rest in cases.ROWS if t is None or len(t) < 5000]
    rows += [(k, PERIODIC, None, "a", 1) for k in (20, 21, None)] + [(k, cases.BASE, "en", "a", 1) for k in range(100, 160)]
    docs = cases.documents(spark, rows).selectExpr("*", "1 AS runs", "'x' AS collapsed", "2 AS best")
    planted = docs.withColumn("text", periods.planted(F.col("doc_id"), F.col("text")))
    assert digests(periods.run_digests(planted)) == sorted((expected(i, t) for i, t, *_ in rows), key=str)


def test_collapsed_texts_and_runs(spark):
    rows = [(1, PERIODIC), (2, "one two"), (3, None), (4, " \n"), (5, "w " * 11), (6, "w " * 12), (7, "q" * 300000 + " w" * 20)]
    out = {r.doc_id: r for r in periods.collapse_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1].collapsed == "a b c x é 中文 😀 end" and out[1].text == PERIODIC
    assert [tuple(r) for r in out[1].runs] == [(0, 27, 3), (28, 15, 1), (43, 14, 2)]
    assert [out[k].collapsed for k in (2, 3, 4, 6)] == ["one two", "", "", "w"]
    assert out[5].runs == [] and out[5].collapsed == " ".join("w" * 11)
    assert [tuple(r) for r in out[7].runs] == [(1, 20, 1)]


def test_empty_table(spark):
    assert periods.run_digests(cases.documents(spark).limit(0)).count() == 0
