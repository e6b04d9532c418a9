"""Spelling variants: words of a corpus that one edit turns into a far more frequent word.

The vocabulary's acceptor is composed with a transducer of one edit and with the acceptor
again; what the composition accepts are the pairs of near words. It is done by partitions:
two near words share their first half, or else their second one, so the words that have a
half in common are one initial state, with a minimised acceptor of what is left of them. A
partition with too many words is cut by its next letter and by the place of the edit.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeferry.scratch import written

LEAST_LETTERS, LEAST_COUNT, FORM_RATIO = 7, 2, 10
#: Of this many pairs of document and word, one is misspelt on purpose.
MISSPELT = 31
#: Characters of a text that are cut into words at once.
PIECE = 1 << 20
#: Different words that a task counts before it hands them on.
HELD_WORDS = 300_000
#: Words of a partition that are composed at once.
MOST_WORDS = 50_000
ANYWHERE = 1 << 30

# The letters of words.
LETTERS = "A-Za-zÀ-ÿ"
WORD = re.compile(f"[{LETTERS}]{{{LEAST_LETTERS},}}")
OTHER = re.compile(f"[^{LETTERS}]")


def pieces(text: str) -> Iterator[str]:
    """Parts of a text that no word crosses, lower-cased in A-Z alone."""
    start = 0
    while start < len(text):
        end = start + PIECE
        if end < len(text):
            after = OTHER.search(text, end)
            end = after.start() if after else len(text)
        yield text[start:end].encode("utf-8", "replace").lower().decode()
        start = end


def word_counts(docs: DataFrame, text: str = "text", misspelt: int = MISSPELT) -> DataFrame:
    """``word, n``: the words of at least ``LEAST_LETTERS`` letters in all whole texts and how
    often they occur, at least ``LEAST_COUNT`` times. A null text has none; a null ``doc_id`` is
    empty in the hash that misspells. Each task counts before it hands on."""

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: Counter = Counter()

        def counted():
            rows = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return rows

        for batch in batches:
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                begun = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for part in pieces(body.as_py() or ""):
                    for run, n in Counter(WORD.findall(part)).items():
                        key = zlib.crc32(run.encode(), begun)
                        if key % misspelt == 0:
                            at = key % len(run)
                            run = run[:at] + run[at + 1 :]
                            if len(run) < LEAST_LETTERS:
                                continue
                        held[run] += n
                    if len(held) > HELD_WORDS:
                        yield counted()
        if held:
            yield counted()

    counts = docs.select(F.col("doc_id").cast("string"), F.col(text).cast("string")).mapInArrow(count, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# --- partitions


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows of ``word, n, m, lo, hi, high`` with the ``key`` of their partition: pairs of a
    word of ``m`` letters and one of ``m`` or ``m + 1`` that share their first ``lo`` and last
    ``hi`` letters, and differ first before place ``high``."""
    same = [F.col(c).cast("string") for c in ("m", "lo", "hi", "high")]
    return rows.withColumn("key", F.concat_ws(" ", *same, F.left("word", F.col("lo")), F.right("word", F.col("hi"))))


def partitions(words: DataFrame) -> DataFrame:
    """Each word of ``word, n`` in its partitions: with its own length as the shorter one's, and
    as the longer one's; by its first half, for edits behind it, and by its second half."""
    half = lambda m: F.floor(m / 2).cast("int")
    size = F.length("word")
    lengths = F.filter(F.array(size, size - 1), lambda m: m >= LEAST_LETTERS)
    ways = F.flatten(F.transform(lengths, lambda m: F.array(
        F.struct(m.alias("m"), half(m).alias("lo"), F.lit(0).alias("hi"), F.lit(ANYWHERE).alias("high")),
        F.struct(m.alias("m"), F.lit(0).alias("lo"), (m - half(m)).alias("hi"), half(m).alias("high")),
    )))
    return _keyed(words.select("word", "n", F.inline(ways)))


def refined(rows: DataFrame, most: int | None = None) -> DataFrame:
    """``partitions`` of at most ``most`` words. A larger one becomes one for each next letter,
    for edits behind it, and many small ones of the words that are alike but for that letter.
    Where one letter is left, words are no more than the letters and pairs of them."""
    most = most or MOST_WORDS
    done = []
    while True:
        sizes = rows.where("m - lo - hi > 1").groupBy("key").count()
        large = written(sizes.where(F.col("count") > most).select("key"), "large-partitions")
        if large.isEmpty():
            break
        done.append(rows.join(large, "key", "left_anti"))
        some = rows.join(large, "key", "left_semi").where("lo < high").drop("key")
        short = F.length("word") == F.col("m")
        deeper = F.struct((F.col("lo") + 1).alias("lo"), "hi", "high")
        here = (F.col("lo") + 1).alias("high")
        replaced = F.struct("lo", (F.col("m") - F.col("lo") - 1).alias("hi"), here)
        put_in = F.struct("lo", (F.col("m") - F.col("lo")).alias("hi"), here)
        ways = F.when(short, F.array(deeper, replaced, put_in)).otherwise(F.array(deeper, put_in))
        rows = written(_keyed(some.select("word", "n", "m", F.inline(ways)).where("lo < high AND lo + hi <= m")), "refined-partitions")
    for other in done:
        rows = rows.unionByName(other)
    return rows


# --- acceptors and their composition

END = 0


class Acceptors:
    """Minimised acceptors of words of one length each, with shared states. A state knows how
    many words it accepts, and each arc how many come before it: the number of a word among
    the sorted ones is the sum along its path."""

    def __init__(self):
        self._known: dict[tuple, int] = {(): END}
        self.counts = [1]
        self.arcs: list[dict[str, tuple[int, int]]] = [{}]

    def _state(self, arcs: tuple) -> int:
        state = self._known.get(arcs)
        if state is None:
            state = self._known[arcs] = len(self.counts)
            own, before = {}, 0
            for letter, goal in arcs:
                own[letter] = goal, before
                before += self.counts[goal]
            self.arcs.append(own)
            self.counts.append(before)
        return state

    def add(self, words: list[str]) -> int:
        """The initial state of an acceptor of sorted, different words of one length."""
        path: list[list] = [[] for _ in range(len(words[0]) + 1)]
        last = words[0]
        for word in words[1:]:
            self._close(path, last, len(os.path.commonprefix((last, word))))
            last = word
        self._close(path, last, 0)
        return self._state(tuple(path[0]))

    def _close(self, path: list[list], word: str, depth: int) -> None:
        """Make states of what is below ``depth`` on the path of a word: no other joins it."""
        state = END
        for at in range(len(word), depth, -1):
            if at < len(word):
                state = self._state(tuple(path[at]))
                path[at] = []
            path[at - 1].append((word[at - 1], state))

    def common(self, p: int, q: int, i: int, j: int, out: list[tuple[int, int]]) -> None:
        """Append the numbers of the words that both states accept, from ``i`` and ``j`` on."""
        todo = [(p, q, i, j)]
        while todo:
            p, q, i, j = todo.pop()
            if p == q:
                n = self.counts[p]
                out.extend(((i, j),) if n == 1 else zip(range(i, i + n), range(j, j + n), strict=True))
                continue
            others = self.arcs[q]
            for letter, (goal, before) in self.arcs[p].items():
                if letter in others:
                    other, ahead = others[letter]
                    todo.append((goal, other, i + before, j + ahead))

    def near(self, short: int, long: int | None, first: int, high: int, behind: str) -> tuple[list, list]:
        """(replaced, put in): pairs of numbers that one edit before place ``high`` turns into
        each other: two of the words of ``short``, and one of ``short`` and one of ``long``. The
        words begin at place ``first``, and ``behind`` follows each. Both go the same way until
        they differ, so each pair is found once, at the first place where they do."""
        replaced: list[tuple[int, int]] = []
        put_in: list[tuple[int, int]] = []
        todo = [(short, long, 0, 0, first)]
        while todo:
            s, l, i, j, place = todo.pop()  # noqa: E741
            if place >= high:
                continue
            arcs = self.arcs[s]
            longer = self.arcs[l] if l is not None else {}
            if len(arcs) > 1:
                own = list(arcs.values())
                for k, (a, before) in enumerate(own):
                    for b, ahead in own[k + 1 :]:
                        self.common(a, b, i + before, i + ahead, replaced)
            for letter, (after, ahead) in longer.items():
                if s == END:
                    if letter != behind[:1]:
                        put_in.append((i, j + ahead))
                    continue
                rest = self.arcs[after]
                for other, (goal, before) in arcs.items():
                    if other != letter and other in rest:
                        to, further = rest[other]
                        self.common(goal, to, i + before, j + ahead + further, put_in)
            for letter, (goal, before) in arcs.items():
                if letter in longer:
                    to, ahead = longer[letter]
                    todo.append((goal, to, i + before, j + ahead, place + 1))
                elif self.counts[goal] > 1:
                    todo.append((goal, None, i + before, 0, place + 1))
        return replaced, put_in


def composed(short: list[tuple[str, int]], long: list[tuple[str, int]], lo: int, hi: int, high: int) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words, greatest count of one, that word) of one partition, whose words and
    counts are sorted; words that no edit brings to another have no row."""
    own = Acceptors()
    left = [own.add([word[lo : len(word) - hi] for word, _ in some]) if some else None for some in (short, long)]
    behind = short[0][0][len(short[0][0]) - hi :]
    near: dict[int, list] = {}

    def meet(i: int, j: int, a: tuple[str, int], b: tuple[str, int]) -> None:
        for at, (word, n) in ((i, b), (j, a)):
            held = near.get(at)
            if held is None:
                near[at] = [1, n, word]
                continue
            held[0] += 1
            if n > held[1] or n == held[1] and word < held[2]:
                held[1:] = n, word

    replaced, put_in = own.near(left[0], left[1], lo, high, behind)
    for i, j in replaced:
        meet(i, j, short[i], short[j])
    for i, j in put_in:
        meet(i, ~j, short[i], long[j])
    for at, held in near.items():
        yield (short[at][0] if at >= 0 else long[~at][0], *held)


FOUND = "word string, near long, best_n long, best string"


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best`` of the words of ``word, n`` that have near words."""
    keyed = refined(partitions(words))

    def compose(batches: Iterator) -> Iterator:
        import pyarrow as pa

        found: list[tuple] = []

        def emit():
            columns = zip(zip(*found, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in columns], names=["word", "near", "best_n", "best"])

        key, sides, where = None, ([], []), None
        for batch in batches:
            for own, word, n, m, lo, hi, high in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != key:
                    if sides[0] and len(sides[0]) + len(sides[1]) > 1:
                        found.extend(composed(*sides, *where))
                        if len(found) > 10_000:
                            yield emit()
                            found.clear()
                    key, sides, where = own, ([], []), (lo, hi, high)
                sides[len(word) - m].append((word, n))
        if sides[0] and len(sides[0]) + len(sides[1]) > 1:
            found.extend(composed(*sides, *where))
        if found:
            yield emit()

    dealt = keyed.select("key", "word", "n", "m", "lo", "hi", "high").repartition("key").sortWithinPartitions("key", "word")
    found = dealt.mapInArrow(compose, FOUND)
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), "best"))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("first")).select(
        "word", "n_near", (-F.col("first.minus")).alias("best_n"), F.col("first.best").alias("best")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of words with a form: the last one that forms lead to. Counts grow tenfold
    with each step, so ways are short; each round doubles the steps taken."""
    hops = written(forms.select("word", F.col("form").alias("root")), "hops")
    while True:
        following = hops.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = hops.join(following, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        further = written(further, "hops")
        if further.where("moved").isEmpty():
            return hops
        hops = further.drop("moved")


def group_variants(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per word of all whole texts: ``word, form, root, n, n_near, form_n``.

    A word has seven letters or more and occurs twice or more. Its near words differ by one
    letter put in, left out or replaced. Its ``form`` is the most frequent of them (of equal ones
    the first), if that occurs ten times as often or more; ``root`` is where forms lead in the
    end, the word itself without one. Null texts have no words, an empty table gives no
    rows, rows that repeat count each, and other columns than ``doc_id`` and the text are not
    looked at. Texts are cut into pieces between words, so a very long one takes no more
    memory than itself.
    """
    words = written(word_counts(docs, text), "vocabulary")
    near = near_words(words)
    is_form = F.col("best_n") >= FORM_RATIO * F.col("n")
    found = written(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")
        ),
        "near-words",
    )
    roots = _roots(found.where(F.col("form").isNotNull()))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE = """
WITH RECURSIVE bits AS (
  SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i)),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(list_reduce(
      flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
        lambda s: CASE WHEN unicode(s) < 128 THEN [CAST(unicode(s) AS BIGINT)] ELSE [195, CAST(unicode(s) - 64 AS BIGINT)] END)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS h
  FROM counted, crc),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM pairs GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * w.n THEN other END AS form, CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
led AS (
  SELECT word, word AS root, 0 AS steps FROM formed
  UNION ALL SELECT l.word, f.form, steps + 1 FROM led l JOIN formed f ON f.word = l.root WHERE f.form IS NOT NULL)
SELECT f.word, form, arg_max(root, steps) AS root, f.n, n_near, form_n
FROM formed f JOIN led l ON l.word = f.word GROUP BY ALL
"""
