"""The n-gram join against all pairs."""

import random
from itertools import combinations

import numpy as np
import pytest

from treeferry.llm import jaccard_join as join
from treeferry.llm.components import components


def grams(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def brute(rows):
    """{row number: (class, links)} with the row numbers of each class."""
    sets = [grams(t) for _, t in rows]
    links = {i: set() for i in range(len(rows))}
    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a == b or (a and b and len(a & b) >= 0.8 * len(a | b)):
            links[i].add(j)
            links[j].add(i)
    seen, found = {}, {}
    for i in links:
        if i not in seen:
            stack, members = [i], {i}
            while stack:
                for j in links[stack.pop()] - members:
                    members.add(j)
                    stack.append(j)
            seen.update(dict.fromkeys(members, members))
        ids = [rows[j][0] for j in seen[i] if rows[j][0] is not None]
        found[i] = (min(ids) if ids else None, len(links[i]))
    return found


def check(spark, make_docs, rows):
    found = sorted((repr(tuple(r)) for r in join.join_similar(make_docs(rows)).select("doc_id", "class_id", "n_links").collect()))
    wanted = sorted(repr((rows[i][0], *own)) for i, own in brute(rows).items())
    assert found == wanted


def varied(n, seed, edits=6, length=300):
    chance = random.Random(seed)
    base = [chance.choice("abcdefgh") * chance.randint(1, 9) + str(chance.randint(0, 99)) for _ in range(length)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(chance.randint(0, edits)):
            words[chance.randrange(len(words))] = str(chance.random())
        out.append(" ".join(words[: chance.randint(int(0.7 * length), length)]))
    return out


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One  TWO"), (6, "two one"), (None, "one two"), (None, None)],
        [(7, "a b c d e f"), (7, "a b c d e f"), (None, "x y"), (None, "X y"), (8, "a b c d e f g h i j k"), (8, "a b c d e f g h i j")],
    ],
)
def test_small_cases(spark, make_docs, rows):
    check(spark, make_docs, rows)


@pytest.mark.parametrize("blocks", [(256, 300_000), (4, 300_000), (256, 1000)])
def test_near_copies_in_blocks(spark, make_docs, monkeypatch, blocks):
    monkeypatch.setattr(join, "BLOCK_NODES", blocks[0])
    monkeypatch.setattr(join, "BLOCK_WORDS", blocks[1])
    texts = varied(40, 1) + varied(15, 2, edits=12) + varied(2, 3) * 4
    check(spark, make_docs, list(enumerate(texts)))


def test_the_table(spark, documents, make_docs):
    check(spark, make_docs, [(r.doc_id, r.text) for r in documents.collect()])


def test_bands_reach_the_recall():
    bands, rows = join.choose_bands(0.8, 0.999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999 and bands * rows <= join.MOST_HASHES
    with pytest.raises(ValueError):
        join.choose_bands(0.1, 0.9999, 16)


def test_signatures_estimate_similarity():
    signer = join.Signer(128, 1)
    a, b = varied(2, 5, edits=3)
    hashes, signatures, sizes = signer.sign([join.normalised(a), join.normalised(b)])
    x, y = grams(a), grams(b)
    assert sizes == [len(x), len(y)]
    assert abs((hashes[0] == hashes[1]).mean() - len(x & y) / len(x | y)) < 0.15
    assert abs((signatures[0] == signatures[1]).mean() - len(x & y) / len(x | y)) < 0.15


def test_signatures_do_not_depend_on_neighbours():
    signer, texts = join.Signer(4, 2), [join.normalised(t) for t in ["a b", "c", *varied(3, 6), "é ß " * 9]]
    alone = np.concatenate([signer.sign([t])[0] for t in texts])
    assert (signer.sign(texts)[0] == alone).all()


def test_components(spark):
    chance = random.Random(4)
    edges = [(chance.randrange(300), chance.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)]
    label = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for u, v in edges:
            least = min(label[u], label[v])
            changed |= label[u] != least or label[v] != least
            label[u] = label[v] = least
    linked = {n for u, v in edges if u != v for n in (u, v)}
    found = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert sorted(map(tuple, found)) == sorted((n, label[n]) for n in linked)


def test_keep_one(spark, make_docs):
    texts = varied(10, 1, edits=2, length=400)
    rows = [(i, t) for i, t in enumerate(texts)] + [(50, "other words stay here as they are"), (50, "other words stay here as they are"), (None, "no id"), (51, None)]
    kept = sorted(repr((r.doc_id, r.text)) for r in join.keep_one(make_docs(rows)).collect())
    classes = {own[0] for own in brute(rows).values() if own[0] is not None}
    assert len(kept) == len(classes) + 1 and repr((None, "no id")) in kept
    assert join.keep_one(make_docs(rows)).columns == make_docs(rows).columns


def test_long_texts_are_signed_in_pieces(monkeypatch):
    signer, chance = join.Signer(18, 5), random.Random(7)
    for words in (1, 4, 5, 11, 12, 13, 500):
        text = join.normalised(" ".join(chance.choice("abcdefgh") * chance.randint(1, 5) for _ in range(words)))
        wanted = signer.sign([text])
        for piece in (1, 3, 8):
            monkeypatch.setattr(join, "PIECE_WORDS", piece)
            assert all(np.array_equal(a, b) for a, b in zip(signer.sign_long(text), wanted, strict=True))
    long = "Ein Σ langer\u3000Text\n\t mit ÄÖ " * 3000
    monkeypatch.setattr(join, "HASHED_BYTES", 1000)
    assert join.normalised(long) == (" ".join(long.lower().split()) + " ").encode()
    assert join.normalised(" " * 5000) == b"" == join.normalised("")


def test_a_template_makes_no_work(spark, make_docs):
    """Texts that share more than half of their words, but no two are similar: hardly one has a
    link, so hardly a text is compared."""
    chance = random.Random(8)
    word = lambda: "w" + str(chance.randrange(10**9))
    shared = [word() for _ in range(120)]
    rows = [(i, " ".join([*shared, *(word() for _ in range(90))])) for i in range(2000)]
    docs = make_docs(rows)
    bands, per_band = join.choose_bands()
    _, nodes = join._nodes(docs, 0.8, 0.999, "text")
    assert nodes.select(join.F.explode("bands").alias("h")).groupBy("h").count().where("count > 1").count() > 10
    assert join.candidate_links(nodes, 0.8, bands, per_band).count() == 0
    assert join.join_similar(docs).where("n_links > 0").isEmpty()


def test_candidates_in_blocks(spark, make_docs, monkeypatch):
    monkeypatch.setattr(join, "BAND_NODES", 7)
    check(spark, make_docs, list(enumerate(varied(60, 9) + varied(20, 10, edits=40))))


def test_recall(spark, make_docs):
    """Pairs at the similarity itself or a little above it."""
    chance, rows = random.Random(11), []
    word = lambda: "w" + str(chance.randrange(10**9))
    for i in range(600):
        words = [word() for _ in range(300)]
        other = list(words)
        for at in chance.sample(range(6, 294, 6), 6):  # five n-grams each: 266 of 326 stay
            other[at] = word()
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
    wanted = sum(len(grams(a[1]) & grams(b[1])) >= 0.8 * len(grams(a[1]) | grams(b[1])) for a, b in zip(rows[::2], rows[1::2], strict=True))
    assert wanted == 600
    assert join.join_similar(make_docs(rows)).where("n_links = 1").count() >= 2 * 0.99 * wanted


def test_many_equal_rows(spark, make_docs):
    rows = [(i % 3 if i % 2 else None, "the same words in all of them " * 4) for i in range(20_000)] + [(7, "others")]
    found = join.join_similar(make_docs(rows)).groupBy("class_id", "n_links").count().collect()
    assert sorted(map(tuple, found)) == [(0, 19_999, 20_000), (7, 0, 1)]


def test_clashing_columns(spark, make_docs):
    docs = make_docs([(1, "a b c d e f g"), (2, "a b c d e f g")])
    for name in ("node", "bands", "hash", "rep", "component", "text_key", "signature", "own_id", "body", "words"):
        docs = docs.withColumn(name, join.F.lit(1))
    assert sorted(tuple(r)[:3] for r in join.join_similar(docs).select("doc_id", "class_id", "n_links").collect()) == [(1, 1, 1), (2, 1, 1)]
    assert join.keep_one(docs).count() == 1 and join.keep_one(docs).columns == docs.columns
