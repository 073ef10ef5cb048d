"""Fingerprints, archives, mixing and the quality classifier."""

import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabscope.llm import merkle, mixing, quality, queries, warc
from tabscope.llm.arrays import utf8
from tabscope.llm.frames import read
from tabscope.session import scratch_path
from tests.llm import cases


def prints(spark, *texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    return [r.p for r in rows.select("i", merkle.fingerprint(F.col("text")).alias("p")).orderBy("i").collect()]


def test_roots_test_equality(spark):
    texts = ["", "\n", "\n\n", "\n\n\n", "a\n\nb", "a\nb", "a\n\n\nb", "ab", " ab", "x" * 64, "x" * 65, "a", "a\n"]
    roots = [p.split(":")[0] for p in prints(spark, *texts)]
    assert len(set(roots)) == len(texts)
    assert prints(spark, None)[0] == prints(spark, "")[0]


def test_branches_locate_edits(spark):
    a, b = prints(spark, "one\ntwo\n\nthree\nfour", "one\ntwo!\n\nthree\nfour\nfive")
    df = spark.createDataFrame([(a, b)], "a string, b string")
    (row,) = df.select(merkle.differing_branches(F.col("a"), F.col("b")).alias("x"), merkle.differing_branches(F.col("a"), F.col("a")).alias("same")).collect()
    assert [tuple(x) for x in row.x] == [(0, 1), (1, 2)] and row.same == []


def test_edited_texts(spark):
    docs = cases.documents(spark, [r for r in cases.ROWS if r[0] not in (2, 13)]).selectExpr("*", "1 AS next", "2 AS k")
    rows = [r for r in docs.collect()]
    by_id = sorted(((r.doc_id, r.text or "") for r in rows if r.doc_id is not None), reverse=True)
    following = {i: by_id[(k + 1) % len(by_id)][1] for k, (i, _) in enumerate(by_id)}
    import hashlib

    want = []
    for r in rows:
        text, n = r.text or "", len(r.text or "")
        edited = text[: n - n // 3] + following.get(r.doc_id, "")[: n // 3]
        want.append((str(r.doc_id), n, hashlib.sha256(edited.encode()).hexdigest()))
    got = merkle.edited_fingerprints(docs).collect()
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == sorted(want)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    long = next(r for r in got if r.doc_id == 11)
    assert long.near_edited > 0.6 and long.near_next > 0.9  # its successor is nearly the same text


def test_fingerprints_of_repeated_ids_and_empty_tables(spark):
    rows = merkle.edited_fingerprints(cases.documents(spark)).collect()
    assert len(rows) == len(cases.ROWS)
    equal = [r.fingerprint for r in rows if r.doc_id == 2]
    assert len(set(equal)) == 1
    assert merkle.edited_fingerprints(cases.documents(spark).limit(0)).count() == 0


def test_following_ids_over_many_ranges(spark):
    ids = [5, -3, 100, 7, 7, None, 2**40, 0, 12]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    found = {r.doc_id: r.next_id for r in merkle.following_ids(df).collect()}
    order = sorted({i for i in ids if i is not None}, reverse=True)
    assert found == {i: order[(k + 1) % len(order)] for k, i in enumerate(order)}


PAGES = [
    (5, "http://u", "same"), (3, "http://u", "same"), (None, "http://u", "same"), (7, None, None), (8, "http://x", ""),
    (None, "http://k", "only without id"), (9, "http://u", "same"), (3, "http://u", "same"), (1, "b\r\nX: y", "é" * 300000),
]


def expected_records(rows, least=0):
    first = {}
    for i, _, html in rows:
        raw = (html or "").encode()
        if i is not None and len(raw) >= least:
            first[raw] = min(first.get(raw, i), i)
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        response = first.get(raw, i) == i
        out.append((str(i), len(raw), warc.payload_digest(raw), "response" if response else "revisit", None if response else str(first[raw])))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 3, 10])
def test_archives_round_trip(spark, least):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 AS id", "2 AS digest")
    archives = warc.write_archives(pages, scratch_path(spark, "test-warc"), least)
    rows = warc.read_archives(archives).collect()
    assert sorted(((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str) == expected_records(PAGES, least)
    assert {bytes(r.payload) for r in rows if r.payload is not None} == {(h or "").encode() for _, _, h in PAGES}


def test_archive_starts_with_its_dictionary(tmp_path):
    records = [warc.record(str(k), f"http://host/{k}", f"<html><p>page {k} of the same site</p></html>".encode() * 20, None) for k in range(300)]
    path = f"{tmp_path}/a.warc.zst"
    warc.write_archive(path, records)
    raw = open(path, "rb").read()
    assert int.from_bytes(raw[:4], "little") == warc.DICTIONARY_MAGIC
    found = list(warc.read_archive(path))
    assert [r["page_id"] for r in found] == [str(k) for k in range(300)]
    open(path, "wb").write(raw[:-3])
    with pytest.raises(ValueError, match="within a record"):
        list(warc.read_archive(path))
    broken = records[0].replace(b"page 0", b"page X")
    with pytest.raises(ValueError, match="digest"):
        warc.parse(broken)


def test_archives_of_an_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(pages, scratch_path(spark, "test-warc"))).count() == 0


def test_pages_of_the_table(spark, sf_dir):
    pages = [(r.page_id, r.url, r.html) for r in read(spark, sf_dir, "pages").collect()]
    rows = queries.op9_warc_dictionary(spark, sf_dir).collect()
    got = [(str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, None if r.refers_to is None else str(r.refers_to)) for r in rows]
    assert sorted(got, key=str) == expected_records(pages)


def test_raking_meets_the_targets(spark):
    cells = spark.createDataFrame(
        [("a", "en", "x", 500), ("a", "de", "x", 100), ("b", "en", "y", 50), ("b", "de", "x", 200), (None, "en", "y", 150)],
        "source string, lang string, topic string, tokens long",
    )
    targets = {"source": {"a": 2, "b": 1, None: 1}, "lang": {"en": 1, "de": 1}, "topic": {"x": 3, "y": 2}}
    rows = mixing.rake(cells, targets=targets).collect()
    for margin, wanted in targets.items():
        for category, value in wanted.items():
            share = sum(r.weight for r in rows if r[margin] == category)
            assert share == pytest.approx(value / sum(wanted.values()), rel=2e-4)


def test_documents_are_drawn_by_their_cells(spark):
    rows = [(k, "word " * 40, "en", "big" if k % 10 else "rare", 200) for k in range(2000)]
    docs = cases.documents(spark, rows).selectExpr("*", "9 AS ratio", "8 AS tokens", "7 AS sampled")
    mixed = mixing.mix_documents(docs, targets={"source": {"big": 1, "rare": 1}}).collect()
    kept = {s: np.mean([r.sampled for r in mixed if r.source == s]) for s in ("big", "rare")}
    assert kept["rare"] == 1 and abs(kept["big"] - 0.5 / 0.9) < 0.05


def test_copies_meet_the_targets_of_all_margins(spark):
    random = np.random.default_rng(3)
    texts = {"prose": "word " * 40, "table": "a | b " * 40, "numbers": "1234 x " * 40}
    rows = []
    for k in range(12000):
        source, lang = random.choice(["hot", "mid", "rare"], p=[0.8, 0.15, 0.05]), random.choice(["en", "de"], p=[0.85, 0.15])
        rows.append((k, texts[random.choice(list(texts), p=[0.8, 0.15, 0.05])], str(lang), str(source), 0))
    docs = cases.documents(spark, rows).selectExpr("*", "5 AS copies")
    targets = {"source": {"hot": 2, "mid": 1, "rare": 1}, "lang": {"en": 2, "de": 1}, "topic": {"prose": 2, "table": 1, "numbers": 1}}
    for wanted in (targets, None):
        mixed = mixing.mix_documents(docs, targets=wanted).drop("text").toPandas()
        assert ((mixed.copies > 0) == mixed.sampled).all()
        for margin in mixing.MARGINS:
            realised = (mixed.tokens * mixed.copies).groupby(mixed[margin]).sum() / (mixed.tokens * mixed.copies).sum()
            share = mixed.groupby(margin).tokens.sum() / mixed.tokens.sum()
            weight = {c: s**mixing.POWER for c, s in share.items()} if wanted is None else wanted[margin]
            for category, value in weight.items():
                assert realised[category] == pytest.approx(value / sum(weight.values()), rel=0.06)


def test_contradicting_targets_end_with_a_warning(spark):
    cells = spark.createDataFrame([("a", "en", "x", 5), ("b", "de", "x", 5)], "source string, lang string, topic string, tokens long")
    with pytest.warns(UserWarning, match="contradict"):
        mixing.rake(cells, targets={"source": {"a": 3, "b": 1}, "lang": {"en": 1, "de": 3}}, rounds=4).collect()


def test_query_meets_its_targets(spark):
    """On the given documents, with the registered parameters, for all three margins."""
    mixed = queries.op6_mix_sources(spark, "/root/testdata/sf0.01").toPandas()
    given = mixed.tokens.sum()
    for margin in mixing.MARGINS:
        weight = (mixed.groupby(margin, dropna=False).tokens.sum() / given) ** mixing.POWER
        cells = mixed.groupby(margin, dropna=False).apply(lambda g: (g.tokens * g.ratio).sum() / given, include_groups=False)
        assert np.abs(cells / (weight / weight.sum()) - 1).max() < 1e-3
        # What is drawn differs from its expectation by chance only: the largest documents set the scale.
        realised = mixed.groupby(margin, dropna=False).apply(lambda g: (g.tokens * g.copies).sum() / given, include_groups=False)
        noise = mixed.groupby(margin, dropna=False).apply(lambda g: np.sqrt((g.tokens.astype(float) ** 2).sum()) / 2 / given, include_groups=False)
        assert (np.abs(realised - cells) < 4 * noise).all()


def test_mixing_awkward_and_empty_tables(spark):
    docs = cases.documents(spark)
    rows = mixing.mix_documents(docs).collect()
    assert len(rows) == len(cases.ROWS) and all(0 <= r.probability <= 1 and r.sampled is not None for r in rows)
    assert len({r.sampled for r in rows if r.doc_id == 2}) == 1
    assert mixing.mix_documents(docs.limit(0)).count() == 0


def test_mixing_sql_on_awkward_rows(spark):
    docs = cases.documents(spark)
    mixed = mixing.mix_documents(docs).select("doc_id", "source", "lang", "topic", "tokens", F.round("ratio", 6).alias("ratio"), F.round("probability", 6).alias("probability"), "sampled")
    documents = docs.toArrow()  # noqa: F841  read by DuckDB
    want = duckdb.sql(mixing.sql()).fetchall()
    assert sorted(map(str, (tuple(r) for r in mixed.collect()))) == sorted(map(str, want))


def test_isotonic_is_the_best_monotone_fit():
    at, weight, total = np.array([0.0, 1, 2, 3, 4]), np.array([1.0, 2, 1, 1, 1]), np.array([0.0, 2, 0, 1, 0.5])
    knots, levels = quality.isotonic(at, weight, total)
    assert (np.diff(levels) >= 0).all()
    assert np.interp(at, knots, levels) == pytest.approx([0, 2 / 3, 2 / 3, 0.75, 0.75])


def test_features_approximate_the_gaussian_kernel():
    random = np.random.default_rng(0)
    x = random.standard_normal((20, 4))
    width = 2.0
    kernel = quality.Kernel(np.zeros(4), np.ones(4), random.standard_normal((4, 20000)) / width, random.uniform(0, 2 * np.pi, 20000))
    z = kernel.features(x)[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * width**2))
    assert np.abs(z @ z.T - exact).max() < 0.05


def test_statistics_of_awkward_texts():
    table = quality.statistics(*utf8(pa.array([t for _, t, *_ in cases.ROWS], pa.string())))
    assert table.shape == (len(cases.ROWS), len(quality.STATISTICS)) and np.isfinite(table).all()
    assert (table[5, :-3] == 0).all() and (table[6] == table[5]).all()


def test_held_out_quality(spark):
    rows = {r.doc_id: r for r in queries.op10_quality_classifier(spark, "/root/testdata/sf0.01").collect()}
    labels = {r.doc_id: r.quality for r in read(spark, "/root/testdata/sf0.01", "labels").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 for i, r in rows.items())
    assert all(r.predicted == (r.score >= 0.5) for r in rows.values())
    right = [rows[i].predicted == q for i, q in labels.items() if rows[i].held_out]
    assert np.mean(right) > 0.95


def test_quality_without_labels_and_documents(spark):
    docs = cases.documents(spark).selectExpr("*", "1 AS score", "2 AS statistics")
    labels = spark.createDataFrame([(1, None), (2, 1), (10, 0), (None, 1)], "doc_id long, quality int")
    assert len(quality.classify(docs, labels).collect()) == len(cases.ROWS)
    assert len(quality.classify(docs, labels.limit(0)).collect()) == len(cases.ROWS)
    assert quality.classify(docs.limit(0), labels).count() == 0
