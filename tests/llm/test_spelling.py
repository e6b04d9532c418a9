"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from treeferry.llm import spelling_variants as spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def vocabulary(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def plain(words):
    """{word: (n, near, form, form_n, root)}"""
    found = {}
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    for w, n in words.items():
        others = [o for k in (-1, 0, 1) for o in by_length.get(len(w) + k, ()) if near(w, o)]
        best = min(others, key=lambda o: (-words[o], o), default=None)
        if best and words[best] < 10 * n:
            best = None
        found[w] = [n, len(others), best, words.get(best)]
    for w, own in found.items():
        root = w
        while found[root][2]:
            root = found[root][2]
        own.append(root)
    return {w: tuple(own) for w, own in found.items()}


def got(frame):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.group_variants(frame).collect()}


def invented(n, seed, letters="abé", shortest=7, longest=10):
    chance = random.Random(seed)
    base = ["".join(chance.choice(letters) for _ in range(chance.randint(shortest, longest))) for _ in range(n)]
    out = []
    for word in base:
        out += [word] * chance.choice([1, 2, 2, 3, 25, 300])
        for _ in range(3):
            at = chance.randrange(len(word) + 1)
            out += [word[:at] + chance.choice(["", chance.choice(letters)]) + word[at + chance.randint(0, 1) :]] * chance.choice([1, 2, 20])
    chance.shuffle(out)
    return out


def test_odd_texts(spark, make_docs):
    rows = [(1, None), (2, ""), (3, "short Words only"), (None, "ÄRGERLICH ärgerlich Ärgerlich"), (None, "naïveté naïvetés " * 3)]
    rows += [(i, "abcdefg abcdefg abcdefgh_ABCDEFG1abcdefgh abcdefg×abcdefg") for i in range(70)] + [(7, "abcdefg " * 9)] * 2
    frame = make_docs(rows)
    for name in ("word", "n", "key", "m", "lo", "hi", "high", "form", "root", "best"):
        frame = frame.withColumn(name, F.lit(1))
    assert got(frame) == plain(vocabulary(rows))
    assert got(make_docs([])) == {}
    assert got(make_docs([(1, None), (None, "")])) == {}


@pytest.mark.parametrize("most", [None, 3, 40])
def test_invented_words(spark, make_docs, monkeypatch, most):
    if most:
        monkeypatch.setattr(spelling, "MOST_WORDS", most)
        monkeypatch.setattr(spelling, "HELD_WORDS", 10)
        monkeypatch.setattr(spelling, "PIECE", 50)
    words = invented(80, 1) + invented(40, 2, "abcdefghij", 7, 12)
    words += ["stepped"] * 2 + ["stepping"] * 3 + ["steppin"] * 40 + ["steppins"] * 900 + ["stepins"] * 9000
    rows = [(i, " ".join(words[i::40])) for i in range(40)]
    found, wanted = got(make_docs(rows)), plain(vocabulary(rows))
    assert found == wanted
    assert any(own[4] != own[2] for own in wanted.values() if own[2])  # ways of several steps


def test_partitions_are_cut_to_size(spark):
    words = spark.createDataFrame([(a, 2) for a in sorted(set(invented(600, 3)))], "word string, n long")
    cut = spelling.refined(spelling.partitions(words), 30)
    assert cut.where("m - lo - hi > 1").groupBy("key").count().agg(F.max("count")).first()[0] <= 30


def test_long_words_and_texts(spark, make_docs):
    long = "ab" * 8_000
    rows = [(1, long + " " + long + "x"), (2, long + " " + long + "x"), (3, (long[:99] + "z" + long[100:] + " ") * 20), (4, "letters " * 1_000_000)]
    assert got(make_docs(rows)) == plain(vocabulary(rows))


def test_minimised_acceptor():
    """States with the same words behind them are one, and words are numbered in order."""
    own = spelling.Acceptors()
    words = sorted(a + b + "ing" for a in "klmn" for b in "aeiou")
    start = own.add(words)
    assert len(own.counts) == 6 and own.counts[start] == len(words)
    again = own.add([w + "s" for w in words])
    replaced, put_in = own.near(start, again, 0, spelling.ANYWHERE, "")
    assert sorted(replaced) == [(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if i < j and near(a, b)]
    assert sorted(put_in) == [(i, i) for i in range(len(words))]
