"""Spelling variants against a search over all pairs, k-d trees against plain distances, counting against plain code."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabscope.llm import kdtree, queries, spelling
from tests.llm import cases


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(counts):
    near = {w: [v for v in counts if one_edit(v, w)] for w in counts}
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= 10 * counts[w]:
            forms[w] = best

    def root(w):
        while w in forms:
            w = forms[w]
        return w

    return sorted((w, forms.get(w), root(w), counts[w], len(near[w]), counts.get(forms.get(w))) for w in counts)


def found_variants(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def vocabulary(seed, size):
    draw = random.Random(seed)
    words = set()
    while len(words) < size:
        w = "".join(draw.choice("abcdeéßÿ") for _ in range(draw.choice([7, 7, 8, 9, 12])))
        words.add(w)
        for _ in range(draw.choice([0, 1, 4])):
            i = draw.randrange(len(w))
            w = draw.choice([w[:i] + w[i + 1 :], w[:i] + draw.choice("abzà") + w[i:], w[:i] + draw.choice("abzà") + w[i + 1 :], w[1:] + w[0]])
            words.add(w)
    return {w: draw.choice([2, 3, 20, 21, 200, 3000]) for w in words}


@pytest.mark.parametrize("cell", [20_000, 25])
def test_variants_match_a_search_over_all_pairs(spark, monkeypatch, cell):
    monkeypatch.setattr(spelling, "CELL", cell)
    counts = vocabulary(cell, 900)
    counts |= {"w" * 300: 2, "w" * 301: 50, "w" * 299 + "v": 600, "ab" * 150: 7}  # counts above MOST
    counts |= {w: 4 for w in ("stressed", "desserts", "tressedd")}  # equal counts, other order
    df = spark.createDataFrame([*counts.items(), (None, 5)], "word string, n long")
    assert found_variants(spelling.variants(df)) == plain_variants(counts)


def test_chains_of_forms(spark):
    chain = {"aaaaaaa" + "b" * k: 2 * 10**k for k in range(8)}
    df = spark.createDataFrame(list(chain.items()), "word string, n long")
    got = found_variants(spelling.variants(df))
    assert got == plain_variants(chain) and {r[2] for r in got} == {"aaaaaaa" + "b" * 7}


def test_ties_go_to_the_smallest_word(spark):
    counts = {"abcdefg": 2, "abcdefh": 20, "abcdefé": 20, "xbcdefg": 20}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert {r.word: r.form for r in spelling.variants(df).collect()}["abcdefg"] == "abcdefh"


def lowered(text):
    return text.translate({k: k + 32 for k in range(65, 91)})


def plain_counts(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = lowered(run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 7:
                counts[w] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def test_query_on_awkward_rows(spark, tmp_path):
    text = " ".join(["Straße-Öffnung ÉLÉGANTE elegante×mente naïveté commonly COMMONLY Commonlyy 中文abcdefgh x" * 3])
    rows = [(i, t) for i, t, *_ in cases.ROWS] + [(k, text + " the rather common words stand here again") for k in range(200)]
    rows += [(None, text), (7, "y" * 50000 + " " + "y" * 50000)]
    docs = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = found_variants(queries.op12_spelling_variants(spark, str(tmp_path)))
    counts = plain_counts(rows)
    assert len(counts) > 30 and got == plain_variants(counts)


def test_operator_on_texts_without_slips(spark):
    docs = spark.createDataFrame([(k, "received " * 20) for k in range(3)] + [(9, "recieved receved receved")], "doc_id long, text string")
    assert found_variants(spelling.spelling_variants(docs)) == [
        ("received", None, "received", 60, 1, None), ("receved", "received", "received", 2, 1, 60),
    ]


def test_empty_tables(spark):
    assert spelling.spelling_variants(cases.documents(spark).limit(0)).count() == 0
    assert spelling.spelling_variants(cases.documents(spark).where("text IS NULL")).count() == 0


@pytest.mark.parametrize("leaves", [None, 1, 13])
def test_trees_find_every_near_point(leaves):
    draw = np.random.default_rng(4)
    points, asked = draw.poisson(0.7, (700, 9)).astype(np.int16), draw.poisson(0.7, (150, 9)).astype(np.int16)
    tree = kdtree.KdTree(points, leaves)
    for up, down in ((1, 1), (1, 0), (2, 2)):
        step = points[None] - asked[:, None]
        want = (np.maximum(step, 0).sum(2) <= up) & (np.maximum(-step, 0).sum(2) <= down)
        found = np.zeros_like(want)
        for q, p in tree.pairs(asked, up, down):
            assert not found[q, p].any()
            found[q, p] = True
        assert (found == want).all()
    if leaves:
        home = tree.leaf_of(asked)
        reached = {(int(q), tree.leaf_number[node]) for node, rows in tree.near(asked, 0, 0) for q in rows}
        assert reached == set(enumerate(home.tolist())) and len(tree.leaf_number) == leaves


def test_letters_as_bytes():
    codes, bounds = spelling.letters(pa.array(["aé", "", None, "ÿàz"]))
    assert codes.tolist() == [0x61, 0xE9, 0xFF, 0xE0, 0x7A] and bounds.tolist() == [0, 2, 2, 2, 5]
    assert spelling.counted(codes, bounds)[3].nonzero()[0].tolist() == [25, 26 + 0x20, 26 + 0x3F]
