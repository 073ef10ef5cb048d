import numpy as np
import pyarrow as pa
import pytest

from tabscope.llm import minhash
from tabscope.llm.arrays import utf8
from tabscope.llm.frames import read
from tests.llm import cases


def as_rows(df):
    return sorted((str(r[0]), r[1], str(r[2]), r[3]) for r in df.collect())


def expected(rows, length):
    found = cases.components(rows, length)
    return sorted((str(i), n, str(c), i == c or c is None) for (i, _), (n, c) in zip(rows, found, strict=True))


@pytest.mark.parametrize("length", [4, 5])
def test_awkward_rows_match_all_pairs(spark, length):
    docs = cases.documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert as_rows(minhash.near_duplicates(docs, minhash.Shape(shingle=length))) == expected(rows, length)


def test_table_matches_all_pairs(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert as_rows(minhash.near_duplicates(docs, minhash.Shape(shingle=4))) == expected(rows, 4)


def test_chains_of_edits_and_near_misses(spark):
    random = np.random.default_rng(3)
    rows = []
    for group in range(6):
        base = [f"g{group}x{k}" for k in range(80)]
        for copy in range(12):
            text = list(base)
            for at in random.integers(0, 80, random.integers(0, 7)):
                text[at] = f"e{random.integers(1000)}"
            rows.append((100 * group + copy, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_rows(minhash.near_duplicates(docs, minhash.Shape(shingle=4))) == expected(rows, 4)


def test_empty_table(spark):
    empty = cases.documents(spark).limit(0)
    assert minhash.near_duplicates(empty).count() == 0
    assert minhash.without_duplicates(empty).columns == empty.columns


def test_one_of_each_group_stays_with_all_columns(spark):
    docs = cases.documents(spark).selectExpr("*", "1 AS component_id", "2 AS __node_", "3 AS kept", "4 AS n_shingles")
    left = minhash.without_duplicates(docs)
    assert left.columns == docs.columns
    ids = sorted(str(r.doc_id) for r in left.collect())
    # 2 to 4 go with 1, 9 with 8, 11 with 10, the copy without an id with 1; both rows of 13 differ and stay
    assert ids == sorted(["1", "5", "6", "7", "8", "10", "12", "13", "13", "None"])


def test_repeated_first_rows_leave_one(spark):
    docs = spark.createDataFrame([(1, cases.BASE), (1, cases.BASE), (4, cases.BASE)], "doc_id long, text string")
    assert [r.doc_id for r in minhash.without_duplicates(docs).collect()] == [1]


def test_signatures_estimate_similarity():
    texts = [" ".join(f"w{k}" for k in range(low, low + 400)) for low in (0, 40, 100, 900)]
    values, bounds = minhash.shingle_sets(*utf8(pa.array(texts)), 4)
    signature, _ = minhash.signatures(values, bounds, 1 << 12)
    for j, low in ((1, 40), (2, 100), (3, 900)):
        shared = max(0, 397 - low)
        assert abs((signature[0] == signature[j]).mean() - shared / (794 - shared)) < 0.08


def test_densification_fills_every_bin():
    values, bounds = minhash.shingle_sets(*utf8(pa.array(["a", "b c d e f", ""])), 4)
    signature, rows = minhash.signatures(values, bounds, 128)
    assert rows.tolist() == [0, 1] and set(signature[0]) == set(values[:1]) and set(signature[1]) <= set(values)
