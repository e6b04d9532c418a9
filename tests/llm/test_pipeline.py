"""The pipeline against a plain version of each stage."""

from collections import Counter

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from tests.llm.conftest import SF_DIR
from tests.llm.test_jaccard import brute as near_brute
from treeferry.llm import mixing, quality_rules
from treeferry.llm.token_ids import TokenIds, pack, tokenizer_path


def kept_by_rules(spark, docs):
    kept = {r.doc_id for r in quality_rules.verdicts(docs).where("kept").collect()}
    return [r for r in docs.collect() if r.doc_id in kept]


def test_stages_one_by_one(spark, documents):
    stages = dict(corpus_pipeline.STAGES)
    rows = kept_by_rules(spark, documents)
    docs = stages["quality_rules"](spark, documents, SF_DIR)
    assert docs.columns == documents.columns and 0 < len(rows) < documents.count()
    assert sorted(map(tuple, docs.collect())) == sorted(map(tuple, rows))

    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    last = {r.text.translate(fold): r for r in sorted(rows, key=lambda r: r.doc_id)}
    docs = stages["exact_dedup"](spark, docs, SF_DIR)
    assert sorted(map(tuple, docs.collect())) == sorted(map(tuple, last.values()))

    rows = [(r.doc_id, r.text) for r in last.values()]
    least = {own[0] for own in near_brute(rows).values()}
    docs = stages["jaccard_join"](spark, docs, SF_DIR).cache()
    assert docs.columns == documents.columns
    assert sorted(r.doc_id for r in docs.collect()) == sorted(least)

    wanted = {r.doc_id for r in mixing.mix(docs).where("selected").collect()}
    drawn = stages["mixing"](spark, docs, SF_DIR)
    assert sorted(map(tuple, drawn.collect())) == sorted(tuple(r) for r in docs.collect() if r.doc_id in wanted)
    assert 0 < len(wanted) < docs.count()

    library = TokenIds(tokenizer_path("byte_bpe_50k.json")).tokenizer
    lengths = {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in drawn.collect()}
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    held = Counter()
    for r in found:
        n = r.n_tokens
        assert n <= 2048 and len(r.ids) == 4 * (n if n & (n - 1) == 0 else 2048) and set(r.ids[4 * n :]) <= {0}
        held.update({p.doc_id: 0 for p in r.pieces})
        for p in r.pieces:
            held[p.doc_id] += p.length
    assert held == lengths
    # The documents' ids, put together from the sequences.
    parts = {(p.doc_id, p.start): r.ids[4 * p.offset : 4 * (p.offset + p.length)] for r in found for p in r.pieces}
    for r in drawn.collect():
        own = b"".join(parts[key] for key in sorted(k for k in parts if k[0] == r.doc_id))
        assert own == pack([*library.encode(r.text, add_special_tokens=False).ids, 1])
    assert sum(r.n_tokens for r in corpus_pipeline.run(spark, SF_DIR, sample=0.9).collect()) > 1.4 * sum(lengths.values())


def test_empty_and_odd_documents(spark, make_docs):
    for rows in ([], [(None, None), (1, ""), (2, None), (3, "few words"), (3, "few words")]):
        docs = make_docs(rows)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF_DIR)
            assert out.columns == docs.columns and out.count() <= len(rows), name
        found = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
        assert sum(len(r.pieces) for r in found) == len(rows)


def test_registered():
    assert "pipeline" in driver.queries()


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_clashing_names(spark, make_docs, stage):
    texts = [(i, f"word{i} " * 3 + "some other words that stand in this text of ours here") for i in range(5)] + [(9, "word1 " * 3 + "some other words that stand in this text of ours here")]
    docs = make_docs(texts)
    clash = docs.withColumns({name: docs.lang for name in ("m", "failed", "own_row", "text_key", "own_digest", "n_words", "topic", "tokens", "probability", "c1", "body")})
    run = dict(corpus_pipeline.STAGES)[stage]
    assert sorted(r.doc_id for r in run(spark, clash, SF_DIR).collect()) == sorted(r.doc_id for r in run(spark, docs, SF_DIR).collect())
    assert run(spark, clash, SF_DIR).columns == clash.columns
