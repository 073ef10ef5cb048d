"""The model of word n-grams behind the perplexity rule."""

import gc
import os
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tabscope.llm import arrays, minhash, perplexity, queries, wordgrams
from tabscope.llm.arrays import Rolling, slices, utf8
from tests.llm import cases


def split(text):
    data, offsets = utf8(pa.array([text]))
    starts, ends, _ = wordgrams.tokens(data, offsets)
    return [bytes(data[a:b]).decode() for a, b in zip(starts, ends, strict=True)]


def test_tokens():
    assert split("It's a b-c,  naïve.\n") == ["It", "'", "s", "a", "b", "-", "c", ",", "naïve", "."]
    assert split("слово 中文ab カ한글 กา") == ["слово", "中", "文", "ab", "カ", "한글", "ก", "า"]
    assert split("") == [] and split(" \t") == []


def plain(texts, words):
    """Modified Kneser-Ney probability of the last of ``words``, from the definition."""
    levels = {3: {}}
    for text in texts:
        found = [None, None, *split(text)]
        for k in range(len(found) - 2):
            gram = tuple(found[k : k + 3])
            levels[3][gram] = levels[3].get(gram, 0) + 1
    for n in (2, 1):
        levels[n] = {}
        for gram in levels[n + 1]:
            levels[n][gram[1:]] = levels[n].get(gram[1:], 0) + 1
    value = 1 / (len(levels[1]) + 1)
    for n in (1, 2, 3):
        n1, n2, n3, n4 = (sum(c == k for c in levels[n].values()) for k in range(1, 5))
        y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.0
        raw = [k - (k + 1) * y * b / a if a else 0.5 * k for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1)]
        spared = [min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1)]
        gram = tuple(words[3 - n :])
        follow = {g: c for g, c in levels[n].items() if g[:-1] == gram[:-1]}
        if follow:
            d = lambda c: spared[min(c, 3) - 1]  # noqa: B023, E731
            own = follow[gram] - d(follow[gram]) if gram in follow else 0
            value = (own + sum(map(d, follow.values())) * value) / sum(follow.values())
    return value


def test_each_text_is_judged_by_the_other_fold(spark):
    texts = [f"the cat {a} the {b} and the cat {b}" for a in ("saw", "bit", "saw") for b in ("dog", "hen", "cat", "old dog")]
    texts += ["", None, "the the the", "unheard words only"]
    keys = wordgrams.text_keys(*utf8(pa.array(texts, pa.string())))
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r.text_key: r.log_perplexity for r in wordgrams.log_perplexities(docs).collect()}
    assert len(got) == len({t for t in texts if t})
    for text, key in zip(texts, keys, strict=True):
        other = [t or "" for t, k in zip(texts, keys, strict=True) if k & 1 != key & 1]
        found = [None, None, *split(text or "")]
        logs = [np.log(plain(other, found[k : k + 3])) for k in range(len(found) - 2)]
        assert not logs or got[int(key)] == pytest.approx(-np.mean(logs), abs=1e-5)
    assert wordgrams.log_perplexities(docs.limit(0)).count() == 0


def test_monotonous_text_is_rejected_and_near_copies_stay(spark, tmp_path):
    random = np.random.default_rng(5)
    words = ["".join(random.choice(list("etaoinshrdlu"), random.integers(3, 9))) for _ in range(400)]
    rows = [(k, " ".join(random.choice(words, 90)), "en", "a", 0) for k in range(160)]
    rows += [(500 + k, rows[0][1].replace(" ", f" {words[k]} ", 1), "en", "a", 0) for k in range(6)]
    rows += [(1000 + k, " ".join("a" * n for n in random.integers(1, 6, 90)), "en", "a", 0) for k in range(8)]
    docs = cases.documents(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    judged = {r.doc_id: r for r in queries.op4_perplexity_quality_rules(spark, str(tmp_path)).collect()}
    assert not any(r.base_failed for r in judged.values())
    assert sum(judged[k].kept for k in range(160)) >= 159 and all(judged[k].kept for k in range(500, 506))
    assert not any(judged[k].kept for k in range(1000, 1008))
    left = {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, str(tmp_path)).collect()}
    assert left == {k for k, r in judged.items() if r.kept}


def test_near_copies_share_a_fold(spark):
    random = np.random.default_rng(2)
    words = ["".join(random.choice(list("etaoinshrdlu"), 6)) for _ in range(300)]
    texts = [" ".join(random.choice(words, 300)) for _ in range(200)]
    near = [t.replace(" ", " another ", 1) for t in texts]
    found = perplexity.folds(*utf8(pa.array([*texts, *near, "", None, "short", "short", "é" * 16])))
    assert (found[:200] == found[200:400]).sum() >= 190 and 60 < found[:200].sum() < 140
    assert found[400] == found[401] and found[402] == found[403]
    alone = [int(perplexity.folds(*utf8(pa.array([t])))[0]) for t in [*texts[:5], "short", "é" * 16]]
    assert alone == [*found[:5], found[402], found[404]]
    assert len(perplexity.folds(*utf8(pa.array([], pa.string())))) == 0


def test_word_salad_and_exchanged_letters_are_rejected(spark, tmp_path):
    random = np.random.default_rng(4)
    words = ["".join(chr(0x430 + k) for k in random.integers(0, 12, 6)) for _ in range(480)]
    sentences = [words[8 * k : 8 * k + 8] for k in range(60)]
    prose = [[w for k in random.permutation(60)[:12] for w in sentences[k]] for _ in range(200)]
    rows = [(k, " ".join(p), "ru", "a", 0) for k, p in enumerate(prose)]
    rows += [(1000 + k, " ".join(random.permutation(prose[k])), "ru", "a", 0) for k in range(4)]
    rows += [(2000 + k, " ".join(prose[k]).translate({c: c + 12 for c in range(0x430, 0x43C)}), "ru", "a", 0) for k in range(4)]
    rows += [(500 + k, " ".join([*prose[0][:40], words[k], *prose[0][41:]]), "ru", "a", 0) for k in range(6)]  # near copies stay
    cases.documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    kept = {r.doc_id: r.kept for r in queries.op4_perplexity_quality_rules(spark, str(tmp_path)).collect()}
    assert sum(kept[k] for k in range(200)) >= 198
    assert all(kept[k] for k in range(500, 506))
    assert not any(kept[k] for k in kept if k >= 1000)


def test_blocks_parts_and_unranked_words_change_no_value(spark, monkeypatch):
    random = np.random.default_rng(7)
    names = ["".join(random.choice(list("etaoin"), 4)) for _ in range(40)]
    texts = [" ".join(random.choice(names, random.integers(1, 40))) for _ in range(60)]
    docs = spark.createDataFrame([(t,) for t in [*texts, *texts[:5], None, ""]], "text string")
    whole = {r.text_key: r.log_perplexity for r in wordgrams.log_perplexities(docs).collect()}
    for name, value in (("BLOCK_TOKENS", 50), ("PART_BYTES", 100), ("RANKED", 3), ("BUCKET_BYTES", 500)):
        monkeypatch.setattr(wordgrams, name, value)
    cut = {r.text_key: r.log_perplexity for r in wordgrams.log_perplexities(docs).collect()}
    assert cut == pytest.approx(whole, abs=1e-6) and len(cut) == len(set(texts))


def test_a_trigram_travels_in_few_bytes():
    random = np.random.default_rng(1)
    texts = [" ".join(f"w{k}" for k in random.zipf(1.3, 500) % 5000) for _ in range(400)]
    part = pa.RecordBatch.from_pydict({"text": pa.array(texts)})
    held = [wordgrams._word_hashes(part, "text")]
    ranks = wordgrams._Words(np.unique(held[0][2])[::2].tolist())
    rows = [r for b in wordgrams._block(held, 0, ranks, list(range(12)), 1) for r in b.to_pylist()]
    assert len(rows) == 12 and sum(r["texts"] is not None for r in rows) == 1
    assert sum(len(r[k]) for r in rows for k in ("rare", "body")) < 6 * len(held[0][2])


def packed(text_count, words_each, frequent=0.0):
    """Blocks of a text column whose words are drawn from 3000, one of them with the given share, packed for one bucket."""
    random = np.random.default_rng(11)
    names = np.array([f"w{k}" for k in range(3000)])
    texts = [" ".join(np.where(random.random(words_each) < frequent, "the", names[random.integers(0, 3000, words_each)])) for _ in range(text_count)]
    return texts, [wordgrams._word_hashes(pa.RecordBatch.from_pydict({"text": pa.array(texts)}), "text")]


def peak(of):
    gc.collect()
    tracemalloc.start()
    try:
        out = of()
        return out, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_packing_a_block_takes_little_memory():
    _, held = packed(400, 500)
    words = wordgrams._Words(np.unique(held[0][2]).tolist())
    rows, most = peak(lambda: [r for b in wordgrams._block(held, 0, words, list(range(12)), 1) for r in b.to_pylist()])
    assert len(rows) == 12 and most < 105 * len(held[0][2])


def test_a_bucket_with_a_frequent_word_is_cut_into_more_parts(spark, monkeypatch):
    texts, _ = packed(60, 400, 0.3)
    total = sum(map(len, texts))
    monkeypatch.setattr(wordgrams, "PART_BYTES", total // 24)
    words, shares = wordgrams._ranked(spark.createDataFrame([(t,) for t in texts], "text string"), "text")
    parts = wordgrams._parts(words, shares, 12, total)
    word = wordgrams.text_keys(*utf8(pa.array(["the"]))).view(np.uint64)
    assert words.by_rank[1] == word[0] and shares[1] == pytest.approx(0.3, abs=0.02)
    assert parts[wordgrams._bucket_of(word, 12)[0]] >= 8 and np.median(parts) <= 2 and (parts >= 1).all()
    assert (wordgrams._parts(wordgrams._Words([]), np.zeros(1), 12, 0) == 1).all()


def test_turns_change_no_value_and_leave_no_trigrams(spark, monkeypatch):
    texts, _ = packed(30, 60, 0.2)
    docs = spark.createDataFrame([(t,) for t in [*texts, *texts[:3], "one", None, ""]], "text string")
    removed, folder = [], wordgrams.remove
    monkeypatch.setattr(wordgrams, "remove", lambda session, path: (removed.append(path), folder(session, path)))
    found = []
    for rounds in (1, 2, 3):
        monkeypatch.setattr(wordgrams, "ROUNDS", rounds)
        found.append({r.text_key: r.log_perplexity for r in wordgrams.log_perplexities(docs).collect()})
    assert len(found[0]) == 31 and found[1] == pytest.approx(found[0], abs=1e-6) and found[2] == pytest.approx(found[0], abs=1e-6)
    assert len(removed) == 1 + 3 + 5 and not any(os.path.exists(p.removeprefix("file:")) for p in removed)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("trigrams_") and t.name in {p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in removed}]


def test_slices_change_no_count():
    texts = [*[t for _, t, *_ in cases.ROWS], *packed(20, 200, 0.3)[0], "a b\na b\n\na b"]
    data, offsets = utf8(pa.array(texts, pa.string()))
    whole = perplexity.base_counts(data, offsets)
    cut = [perplexity.base_counts(d, o) for d, o in slices(data, offsets, 300)]
    assert len(cut) > 10 and all((np.concatenate([c[k] for c in cut]) == v).all() for k, v in whole.items())
    assert (np.concatenate([perplexity.folds(d, o) for d, o in slices(data, offsets, 300)]) == perplexity.folds(data, offsets)).all()
    assert whole["n_dup_lines"][-1] == 2 and list(slices(data[:0], offsets[:1])) == []


def test_a_worker_gives_large_tables_back():
    long = np.full(1 << 20, 97, np.uint8)
    before = Rolling(long).of(np.array([5]), np.array([1 << 19]))
    assert len(arrays._POWERS[0]) > 1 << 20
    arrays.give_back()
    assert len(arrays._POWERS[0]) == len(arrays._POWERS[1]) == 1
    assert (Rolling(long).of(np.array([5]), np.array([1 << 19])) == before).all()


def test_passes_over_texts_give_memory_back(monkeypatch):
    given = []
    monkeypatch.setattr(arrays, "give_back", lambda: given.append(1))
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["one two three four five six", None])})
    out = list(minhash._described("text", minhash.Shape(shingle=4), "digest")(iter([batch, batch])))
    assert sum(b.num_rows for b in out) == 4 and len(given) == 1
