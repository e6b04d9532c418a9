"""Token ids, packing and id planes against plain calls of the library."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from treeferry.scratch import written
from treeferry.llm import packing, token_planes
from treeferry.llm.token_ids import TokenIds, pack, tokenizer_path

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")

BYTES, WORDS = "byte_bpe_50k.json", "word_bpe_49k.json"
ODD = [
    "", " ", "  ", " a", "a ", "a  b", "\n\n x", "x \n y", "don't I'll  'S", "é́x", "ΑΣ ΣΑΣ.", "a  b　c", "<|endoftext|> x",
    "a\x1cb \x1c c", "tab\t\tz \t", "😀 😀x 12345 6", "İstanbul ıI", "foo\r\n bar\r\n\r\nbaz", "́abc", "a ́b", "x\x85 y", "Å Å", "a\x0b b\x0c c",
    "'s 've", "﻿hi", "a​b ​", "Ǆ ǅ ß ẞ", "word. word, word.word ,word", "x" * 5000, "end." * 300,
]


@pytest.mark.parametrize("name", [BYTES, WORDS])
def test_ids_are_the_librarys(name):
    chance = random.Random(1)
    alphabet = "ab 's\n\t  .,1²é́ Σσ\x1c\x85 漢😀'llI'"
    texts = ODD + ["".join(chance.choice(alphabet) for _ in range(chance.randint(1, 40))) for _ in range(3000)]
    own = TokenIds(tokenizer_path(name))
    wanted = own.tokenizer.encode_batch(texts, add_special_tokens=False)
    for _ in range(2):  # the second time from the cache
        assert [t for t, w in zip(texts, wanted, strict=True) if own.encode(t) != pack(w.ids)] == []


@pytest.mark.parametrize("name", [BYTES, WORDS])
@pytest.mark.parametrize("form", ["x{}y", "ab {}", "a{}B {}1.", "\u0301{} {}\t{}a"])
def test_every_character(name, form):
    """Letters that only one of two pattern engines knows were cut at different places."""
    points = [c for c in range(0x20000) if not 0xD800 <= c < 0xE000] + list(range(0xE0000, 0xE0200))
    texts = [form.replace("{}", chr(c)) for c in points]
    own = TokenIds(tokenizer_path(name))
    wanted = own.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [hex(c) for c, t, w in zip(points, texts, wanted, strict=True) if own.encode(t) != pack(w.ids)] == []


def test_ids_of_a_full_cache(monkeypatch):
    monkeypatch.setattr("treeferry.llm.token_ids.CACHE_ENTRIES", 3)
    own = TokenIds(tokenizer_path(BYTES))
    text = "one two three, four. five six seven one two. three"
    assert own.encode(text) == pack(own.tokenizer.encode(text, add_special_tokens=False).ids)


def brute(rows, name, end):
    library = TokenIds(tokenizer_path(name)).tokenizer
    return [(i, library.encode(t or "", add_special_tokens=False).ids + [end]) for i, t in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


ROWS = [(3, "one two three"), (1, None), (2, ""), (9, "word " * 5000), (None, "no id"), (7, "same"), (7, "same"), (8, "same")]


@pytest.mark.parametrize("rows", [ROWS, []])
def test_packing(make_docs, rows):
    found = packing.pack_documents(make_docs(rows), BYTES, end=1, group_documents=3, with_ids=True).cache()
    docs = defaultdict(list)
    for row in found.collect():
        assert row.ids_crc32 == zlib.crc32(row.ids) and row.length == len(row.ids) // 4 > 0
        docs[row.doc_id].append(row)
    wanted = brute(rows, BYTES, 1)
    assert sorted(map(str, docs)) == sorted({str(i) for i, _ in wanted})
    for doc_id, ids in wanted:
        copies = sum(i == doc_id for i, _ in wanted)
        pieces = sorted(docs[doc_id], key=lambda r: r.start)
        assert b"".join(r.ids for r in pieces[::copies]) == pack(ids)
        assert {r.doc_tokens for r in pieces} == {len(ids)}
    bins = defaultdict(list)
    for row in found.collect():
        bins[row.sequence_id].append((row.offset, row.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    by_place = {(r.sequence_id, r.offset): r for r in found.collect()}
    for row in packing.sequences(found, pad=0).collect():
        n = row.n_tokens
        assert len(row.ids) == 4 * (n if n & (n - 1) == 0 else 2048)
        for piece in row.pieces:
            own = by_place.pop((row.sequence_id, piece.offset))
            assert (own.doc_id, own.start, own.length) == (piece.doc_id, piece.start, piece.length)
            assert row.ids[4 * piece.offset : 4 * (piece.offset + piece.length)] == own.ids
    assert not by_place
    found.unpersist()


def test_equal_rows_are_dealt_over_groups(make_docs):
    """Rows that repeat, without an id, once fell into one group."""
    docs = make_docs([(None, "the same few words")] * 20_000)
    found = packing.pack_documents(docs, BYTES, end=1, group_documents=1000).withColumn("group", F.shiftright("sequence_id", 32)).cache()
    sizes = [r["count"] for r in found.groupBy("group").count().collect()]
    assert len(sizes) == 20 and max(sizes) < 1300 and sum(sizes) == 20_000
    assert found.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").isEmpty()
    found.unpersist()


def test_first_fit_decreasing_is_the_plain_one():
    chance = random.Random(2)
    for _ in range(200):
        lengths = [chance.randint(1, 20) for _ in range(chance.randint(1, 60))]
        bins, wanted = [], {}
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            for b, filled in enumerate(bins):
                if filled + lengths[i] <= 20:
                    break
            else:
                b = len(bins)
                bins.append(0)
            wanted[i] = (b, bins[b])
            bins[b] += lengths[i]
        assert packing.first_fit_decreasing(lengths, 20) == [wanted[i] for i in range(len(lengths))]


def test_packing_pads_little(documents):
    found = packing.pack_documents(documents, BYTES, end=1)
    total = found.agg({"length": "sum"}).first()[0]
    n = found.select("sequence_id").distinct().count()
    assert n * 2048 < 1.05 * total + 2048


@pytest.mark.parametrize("plane", ["bit", "byte"])
@pytest.mark.parametrize("rows", [ROWS, []])
def test_planes_round_trip(spark, make_docs, plane, rows):
    files = token_planes.write_ids(make_docs(rows), WORDS, end=2, tasks=3, plane=plane, block_ids=64)
    found = sorted(token_planes.read_ids(spark, files).collect(), key=lambda r: r.start)
    wanted = sorted(brute(rows, WORDS, 2), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [(r.doc_id, r.ids) for r in found] == [(i, pack(ids)) for i, ids in wanted]
    at = 0
    for row in found:
        assert (row.start, row.n_tokens) == (at, len(row.ids) // 4)
        at += row.n_tokens
    for file in files.collect():
        reader = token_planes.PlaneReader(file.uri, file.n_bytes)
        whole = b"".join(ids for _, ids in reader.documents())
        assert reader.ids(10, 100) == whole[40:440] and reader.ids(0, file.n_ids) == whole


def test_planes_of_the_table(spark, documents):
    found = token_planes.round_trip(documents, WORDS, end=2).orderBy("start").collect()
    rows = [(r.doc_id, r.text) for r in documents.orderBy("doc_id").collect()]
    at, wanted = 0, []
    for doc_id, ids in brute(rows, WORDS, 2):
        wanted.append((doc_id, at, len(ids), crc(ids)))
        at += len(ids)
    assert [tuple(r) for r in found] == wanted


def test_extra_columns_that_clash(spark, make_docs):
    docs = make_docs(ROWS).withColumn("size", F.lit("x")).withColumnsRenamed({"lang": "tie", "source": "own_group"})
    assert packing.pack_documents(docs, BYTES, end=1).count() == packing.pack_documents(make_docs(ROWS), BYTES, end=1).count()
    assert token_planes.round_trip(docs, WORDS, end=2).count() == len(ROWS)


def test_few_long_texts_are_several_groups(make_docs):
    """Groups were counted by documents, so one of many pieces was a single group."""
    found = packing.pack_documents(make_docs([(1, "some words " * 3000)]), BYTES, end=1, room=8, group_documents=100)
    pieces = found.count()
    groups = {r.group: r.pieces for r in found.groupBy(F.shiftright("sequence_id", 32).alias("group")).agg(F.count("*").alias("pieces")).collect()}
    assert pieces > 700 and sum(groups.values()) == pieces
    assert len(groups) == -(-pieces // 100) and max(groups.values()) < 200


def test_each_file_has_a_task_of_its_own(spark, make_docs):
    files = token_planes.write_ids(make_docs([(i, f"some words {i}") for i in range(600)]), WORDS, end=2, tasks=12)
    found = token_planes.read_ids(spark, files).withColumn("task", F.spark_partition_id())
    by_task = found.groupBy("task").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).collect()
    assert len(by_task) == files.count() > 8


def test_files_are_closed_by_their_size(spark, make_docs):
    """One task's documents in several files, none above its bounds by more than a document."""
    rows = [(i, "some words " * (i % 7) + str(i)) for i in range(500)] + [(None, "long " * 5000)]
    wanted, at = [], 0
    for doc_id, ids in brute(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)), WORDS, 2):
        wanted.append((doc_id, at, len(ids), crc(ids)))
        at += len(ids)
    for bounds in ({"file_ids": 900}, {"file_docs": 40}):
        files = token_planes.write_ids(make_docs(rows), WORDS, end=2, tasks=2, **bounds)
        sizes = files.orderBy("number").collect()
        assert len(sizes) > 5 and sum(r.n_docs for r in sizes) == 501
        assert all(r.n_ids < 900 + 40 or r.n_docs == 1 for r in sizes) if "file_ids" in bounds else max(r.n_docs for r in sizes) == 40
        found = token_planes.read_ids(spark, files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("c"))
        assert [tuple(r) for r in found.orderBy("start").collect()] == wanted


def test_more_tasks_for_larger_inputs(make_docs, monkeypatch):
    docs = written(make_docs([(i, f"words {i * i} " * 100) for i in range(300)]), "stored")
    monkeypatch.setattr(token_planes, "TASK_BYTES", 100)
    files = token_planes.write_ids(docs, WORDS, end=2)
    assert files.select((F.col("number") / 2**32).cast("int")).distinct().count() > 50
