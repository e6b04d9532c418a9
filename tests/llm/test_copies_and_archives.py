"""Exact deduplication, archives and the quality votes against plain versions."""

import hashlib
import os
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from treeferry.llm import chosen_rows, exact_dedup, quality_classifier, warc_zstd
from treeferry.llm.task_files import StoredFile

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_copies(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[(text or "").translate(FOLD)].append(i)
    out = Counter()
    for text, ids in groups.items():
        named = [i for i in ids if i is not None]
        keep = max(named) if named else None
        for n, i in enumerate(ids):
            kept = i == keep and ids.index(keep) == n
            out[(i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest())] += 1
    return out


COPIES = [
    (1, "Text"), (5, "tEXT"), (3, "text"), (2, None), (4, ""), (6, "É"), (7, "é"), (None, "text"), (None, "alone"), (None, "ALONE"), (8, "x" * 5000), (9, "X" * 5000),
    (10, "x" * 4999 + "y"), (11, "x" * 4096), (5, "text"), (12, "\x00a"), (13, "a"), (14, "ab" * 3000), (15, "AB" * 3000), (16, "ba" * 3000),
]


@pytest.mark.parametrize("piece_bytes", [1 << 20, 1000])
def test_copies(make_docs, piece_bytes):
    found = exact_dedup.deduplicate(make_docs(COPIES), piece_bytes=piece_bytes).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found) == plain_copies(COPIES)


@pytest.mark.parametrize("piece_bytes", [1 << 20, 1000])
def test_equal_fingerprints_of_different_texts(make_docs, monkeypatch, piece_bytes):
    monkeypatch.setattr(exact_dedup, "PRIME", 2)
    monkeypatch.setattr(exact_dedup, "fingerprint", lambda piece: 0)
    monkeypatch.setattr(exact_dedup, "combine", lambda first, second, n: 0)
    found = exact_dedup.deduplicate(make_docs(COPIES), piece_bytes=piece_bytes).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found) == plain_copies(COPIES)


def test_fingerprints_combine():
    chance = random.Random(3)
    for _ in range(50):
        text = chance.randbytes(chance.randint(0, 400))
        cuts = sorted(chance.randint(0, len(text)) for _ in range(3))
        parts = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)]
        assert exact_dedup.combine_all((exact_dedup.fingerprint(p), len(p)) for p in parts) == exact_dedup.fingerprint(text)


def test_drop_copies(make_docs):
    docs = make_docs(COPIES)
    kept = exact_dedup.drop_copies(docs)
    wanted = Counter((r[0], r[4]) for r in plain_copies(COPIES) if r[3])
    assert kept.columns == docs.columns
    got = Counter((r.doc_id, hashlib.sha256((r.text or "").translate(FOLD).encode()).hexdigest()) for r in kept.collect())
    # of rows without an id that differ by case only, either one stays
    assert got == wanted
    assert exact_dedup.drop_copies(make_docs([])).count() == 0 and exact_dedup.deduplicate(make_docs([])).count() == 0


def test_only_suspects_move(make_docs, monkeypatch):
    """Texts that are no other's pass no exchange; a full filter changes nothing."""
    rows = [(i, f"text {i} " * 50) for i in range(400)] + [(1000 + i, "Copy " * 60) for i in range(3)]
    docs = make_docs(rows)
    suspects = chosen_rows.KeyFilter(docs.where("doc_id >= 1000").limit(1).select("text"), F.col("text"))
    passing = [text for _, text in rows if suspects.keeps(text.encode())]
    assert passing.count("Copy " * 60) == 3 and len(passing) < 40
    wanted = Counter((r[0], r[1]) for r in rows if r[0] < 1000 or r[0] == 1002)
    assert Counter((r.doc_id, r.text) for r in exact_dedup.drop_copies(docs).collect()) == wanted
    monkeypatch.setattr(chosen_rows, "MOST_FILTER_BITS", 32)
    assert Counter((r.doc_id, r.text) for r in exact_dedup.drop_copies(docs).collect()) == wanted


def test_a_group_of_most_rows(spark, make_docs):
    """20,000 equal rows without an id, and as many with one: no task takes them all in."""
    docs = make_docs([(None, "same text")] * 20000 + [(i, "Same Text") for i in range(20000)]).repartition(8)
    found = exact_dedup.deduplicate(docs)
    assert found.agg(F.count("*"), F.sum(F.col("kept").cast("int")), F.min("keep_id"), F.min("group_size")).first()[:] == (40000, 1, 19999, 40000)
    assert [(r.doc_id, r.text) for r in exact_dedup.drop_copies(docs).collect()] == [(19999, "Same Text")]


def test_copies_beside_clashing_columns(spark):
    schema = "doc_id int, text string, fingerprint string, own_digest int, body string, c0 string, kept_id int"
    docs = spark.createDataFrame([(1, "A", "f", 1, "b", "c", 2), (2, "a", None, 2, None, "d", 3), (3, None, "g", 3, "x", None, 4)], schema)
    assert sorted((r.doc_id, r.keep_id) for r in exact_dedup.deduplicate(docs).collect()) == [(1, 2), (2, 2), (3, 3)]
    kept = exact_dedup.drop_copies(docs)
    assert kept.schema == docs.schema and sorted(r.doc_id for r in kept.collect()) == [2, 3]


BODY = "<html>" + "payload " * 30
PAGES = [
    (5, "http://a/x y\r\nz", BODY), (3, "http://b", BODY), (9, None, BODY), (1, "u", "short"), (2, "u", "short"), (4, "u", None), (6, "u", ""), (None, "u", BODY),
    (None, "u", BODY + "!"), (None, "v", BODY + "!"), (3, "http://b", BODY), (7, "é", "é" * 60), (8, "é", "é" * 60), (10, "u", "WARC/1.1\r\n\r\n" * 20), (11, "u", "z" * 300000),
]


def plain_archive(rows):
    first = defaultdict(list)
    for i, _, html in rows:
        if i is not None:
            first[html].append(i)
    out = Counter()
    for i, _, html in rows:
        data = (html or "").encode()
        least = min(first[html], default=None) if len(data) >= 100 else None
        revisit = least is not None and i != least
        out[(i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", least if revisit else None)] += 1
    return out


@pytest.mark.parametrize("archive_bytes", [1 << 30, 500])
def test_archives(spark, archive_bytes):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    files = warc_zstd.write_archives(pages, archive_bytes=archive_bytes)
    found = warc_zstd.read_archives(files, with_payload=True).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found) == plain_archive(PAGES)
    assert all(hashlib.sha256(r.payload).hexdigest() == r.payload_digest for r in found if r.record_type == "response")
    assert sum(r.n_records for r in files.collect()) == len(PAGES)


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc_zstd.read_archives(warc_zstd.write_archives(pages)).count() == 0


def test_an_archive_begins_with_its_dictionary(spark):
    chance = random.Random(1)
    words = [f"word{i}" for i in range(200)]
    rows = [(i, f"http://h/{i}", "<html><body><p>" + " ".join(chance.choices(words, k=80)) + "</p></body></html>") for i in range(600)]
    files = warc_zstd.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)).collect()
    start = StoredFile(files[0].uri).read(4)
    assert int.from_bytes(start, "little") == warc_zstd.DICTIONARY_FRAME
    assert len(list(warc_zstd.read_records(files[0].uri))) == files[0].n_records


def test_quality_votes(spark, make_docs):
    chance = random.Random(2)
    rows, labels = [], []
    for i in range(300):
        words = ["".join(chance.choices("etaoinshr", k=chance.randint(2, 9))) for _ in range(chance.randint(15, 80))]
        good = chance.random() < 0.8
        rows.append((i, " ".join(words) if good else " ".join(w.upper() + "!!" for w in words)))
        labels.append((i, int(good), 0))
    rows += [(1000, None), (1001, ""), (1002, "x" * 200000), (None, "no id"), (5, rows[5][1])]
    labels += [(7, None, 0), (9999, 1, 0), (None, 1, 0), (8, labels[8][1], 0)]
    docs = make_docs(rows).withColumn("quality", F.lit("clash"))
    found = quality_classifier.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    truth = {i: q for i, q, _ in labels if q is not None}
    for r in found:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        if r.doc_id is not None and r.doc_id < 300 and r.doc_id in truth:
            assert r.predicted == truth[r.doc_id]


def test_votes_are_exact():
    import numpy as np

    chance = np.random.default_rng(1)
    texts = [bytes(chance.choice(list(b"abcde \n|!"), 60).astype(np.uint8)) for _ in range(80)]
    labels = list(chance.integers(0, 2, 60))
    counts = quality_classifier.term_counts(texts)
    model = quality_classifier.fit(counts[:60], labels)
    latent = model.latent(counts)
    found = model.scores(counts)
    for row in range(80):
        cosines = [(float(latent[row] @ latent[k]), labels[k]) for k in range(60)]
        best = sorted(cosines, key=lambda c: -c[0])[: quality_classifier.NEIGHBOURS]
        weights = [max(c, 1e-6) ** 4 for c, _ in best]
        wanted = sum(w * y for w, (_, y) in zip(weights, best, strict=True)) / sum(weights)
        assert abs(found[row] - wanted) < 1e-3


def test_no_labels(spark, make_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in quality_classifier.classify(make_docs([(1, "a")]), labels).collect()] == [0.5]
    assert quality_classifier.classify(make_docs([]), labels).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="needs the supplied tables")
def test_held_out_accuracy(spark):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = quality_classifier.classify(documents, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in found) >= 0.95 * len(found) > 50
