import hashlib
import re
from collections import Counter
from itertools import accumulate

import tiktoken
import public_tokenizers

import corpus_pipeline as pipeline
from tabscope.llm import bpe, mixing, perplexity
from tabscope.llm.frames import read
from tests.llm import cases
from tests.llm.test_text_rules import base_spans, counts


def test_stages_are_in_order():
    assert [name for name, _ in pipeline.STAGES] == ["quality_rules", "near_duplicates", "secret_scan", "mix_sources", "encode"]


def masked(text):
    spans = sorted((a, b) for _, a, b in base_spans(text))
    out, reach = "", 0
    for a, b in spans:
        if a >= reach:
            out += text[reach:a] + "[SECRET]"
        reach = max(reach, b)
    return out + text[reach:]


def meets_targets(given, drawn):
    """Token shares of source, language and topic are the targets, but for the chance in drawing the last copy of each document."""
    tokens = lambda r: -(-len(r.text.encode()) // 4)
    topic = lambda r: next((n for n, p in mixing.TOPICS.items() if re.search(p, r.text)), mixing.OTHER_TOPIC)
    total = sum(map(tokens, given))
    for of in (lambda r: r.source, lambda r: r.lang, topic):
        had, has, noise = Counter(), Counter(), Counter()
        for r in given:
            had[of(r)] += tokens(r) / total
            noise[of(r)] += (tokens(r) / total) ** 2 / 4
        for r in drawn:
            has[of(r)] += tokens(r) / total
        weight = sum(s**mixing.POWER for s in had.values())
        for category, share in had.items():
            assert abs(has[category] - share**mixing.POWER / weight) < 4 * noise[category] ** 0.5 + 1e-3


def test_each_stage_against_a_plain_version(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    columns = docs.columns
    for name, stage in pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = pipeline.stored(stage(spark, docs, sf_dir), name)
        rows = docs.collect()
        after = {r.doc_id: r for r in rows}
        assert set(after) <= set(before)
        if name not in ("mix_sources", "encode"):
            assert len(rows) == len(after)
        if name != "encode":
            assert docs.columns == columns
        if name == "quality_rules":
            for r in before.values():
                n, *_, repeated = counts(r.text)
                assert not (r.doc_id in after and (n < 20 or 100 * repeated > 30 * n))
            assert len(after) > 0.75 * len(before)
        elif name == "near_duplicates":
            ids = list(before)
            found = cases.components([(i, before[i].text) for i in ids], 5)
            assert set(after) == {i for i, (_, c) in zip(ids, found, strict=True) if i == c}
        elif name == "secret_scan":
            assert set(after) == set(before)
            assert all(r.text == masked(before[i].text) and r.n_chars == len(r.text) for i, r in after.items())
        elif name == "mix_sources":
            assert all(tuple(r) == tuple(before[r.doc_id]) for r in rows)
            meets_targets(list(before.values()), rows)
            copies = Counter(r.doc_id for r in rows)
        else:
            ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
            library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            assert Counter(r.doc_id for r in rows) == copies
            for r in after.values():
                raw = before[r.doc_id].text.encode()
                assert r.ids == library.encode_ordinary(before[r.doc_id].text) and r.n_tokens == len(r.ids)
                assert r.decoded_sha256 == hashlib.sha256(raw).hexdigest()
                assert r.ends == list(accumulate(len(library.decode_single_token_bytes(i)) for i in r.ids))


def test_stages_survive_awkward_rows_and_empty_tables(spark, sf_dir):
    extra = "1 AS n_words", "2 AS kept", "3 AS __n", "4 AS component_id", "5 AS secrets", "6 AS topic", "7 AS probability", "8 AS c0", "9 AS ids"
    for docs in (cases.documents(spark).selectExpr("*", *extra), cases.documents(spark).limit(0)):
        for name, stage in pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            assert name == "mix_sources" or out.count() <= docs.count()
            assert name == "encode" or out.columns == docs.columns


def test_run_returns_token_ids(spark, sf_dir):
    rows = pipeline.run(spark, sf_dir).collect()
    assert rows and all(r.n_tokens == len(r.ids) > 0 for r in rows)
    assert re.fullmatch("[0-9]+", str(rows[0].doc_id)) and perplexity.ORDER == 4
