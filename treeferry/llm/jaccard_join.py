"""Documents of similar word n-grams: MinHash bands find them, full n-gram sets decide.

Texts of the same words are one node. Nodes that share a band's hash are candidates, and a
candidate pair is first held against its two signatures, a byte for each hash: what agrees in
too few of them has no link. What links connect is compared together, on whole n-gram sets,
in blocks of bounded size that any number of tasks can share. From bands and blocks come
one link a node and counts, never pairs, and only texts that have a link are moved.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeferry.llm.chosen_rows import keep_chosen
from treeferry.llm.components import components
from treeferry.scratch import written

WORDS, SIMILARITY, RECALL = 5, 0.8, 0.999
#: Hash functions of a signature, at most.
MOST_HASHES = 128
#: Nodes and words that one side of a comparison may have.
BLOCK_NODES, BLOCK_WORDS = 256, 300_000
#: Rows of comparisons that a task gets, about.
TASK_ROWS = 256
#: Standard deviations that the signatures' agreement may be below the similarity, and the
#: nodes of a band that are held against each other at once.
DOUBT, BAND_NODES = 3.0, 1024
#: Bits of the filter that keeps texts without a link where they are, at most.
MOST_FILTER_BITS = 1 << 26
#: Bytes of text that are hashed at once.
HASHED_BYTES = 1 << 20
#: Words of a piece of a text that is signed in pieces.
PIECE_WORDS = 200_000


def choose_bands(similarity: float = SIMILARITY, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band, thus the fewest false candidates, with which a
    pair at ``similarity`` shares a band with a probability of ``recall``."""
    best = None
    for rows in range(1, most + 1):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log1p(-(similarity**rows)))) if similarity < 1 else 1
        if bands * rows <= most:
            best = (bands, rows)
    if best is None:
        raise ValueError(f"no {most} hashes reach a recall of {recall} at {similarity}")
    return best


_SPACE = re.compile(r"\s")


def normalised(text: bytes | str) -> bytes:
    """The words in lower case with a space behind each. A long text is taken in pieces that
    end at white space."""
    text = text if isinstance(text, str) else text.decode("utf-8", "replace")
    parts, start = [], 0
    while start < len(text):
        end = start + HASHED_BYTES
        if end < len(text):
            after = _SPACE.search(text, end)
            end = after.end() if after else len(text)
        words = text[start:end].lower().split()
        if words:
            parts.append((" ".join(words) + " ").encode("utf-8", "replace"))
        start = end
    return b"".join(parts)


def text_key(words: bytes) -> bytes:
    return hashlib.blake2b(words, digest_size=16).digest()


def _numbers(seed: int, n: int):
    import numpy as np

    return np.random.default_rng(seed).integers(1, 2**64 - 1, n, np.uint64, True) | np.uint64(1)


class Signer:
    """Band hashes of many normalised texts at once, in numpy."""

    def __init__(self, bands: int, rows: int, n: int = WORDS):
        import numpy as np

        self.bands, self.rows, self.n = bands, rows, n
        self.values, self.places = _numbers(1, 256), _numbers(2, n)
        self.factors, self.terms = _numbers(3, bands * rows), _numbers(4, bands * rows)
        self.mixers = _numbers(5, rows)
        base = int(_numbers(6, 1)[0])
        self.base = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.powers = np.zeros(0, np.uint64), np.zeros(0, np.uint64)

    def _grow(self, n: int) -> None:
        import numpy as np

        if len(self.powers[0]) < n:
            self.powers = tuple(np.cumprod(np.full(n, b, np.uint64)) for b in self.base)

    @staticmethod
    def _mix(h):
        import numpy as np

        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)

    def _words(self, whole):
        """A hash of each word: differences of prefix sums of a polynomial, shifted back."""
        import numpy as np

        self._grow(len(whole) + 1)
        up, down = self.powers
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.values[whole] * up[: len(whole)])])
        ends = np.flatnonzero(whole == 32)
        starts = np.concatenate([[0], ends[:-1] + 1])
        return self._mix((sums[ends] - sums[starts]) * down[starts])

    def _grams(self, whole, counts):
        """(hashes, numbers) of the n-grams of texts whose bytes follow each other. A text of
        fewer words than an n-gram has one n-gram, of all its words."""
        import numpy as np

        words = self._words(whole)
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        padded = np.concatenate([words, np.zeros(self.n - 1, np.uint64)])
        grams = sum((padded[k : k + len(words)] * self.places[k] for k in range(1, self.n)), words * self.places[0])
        for row in np.flatnonzero(counts < self.n):
            own = words[first[row] : first[row] + counts[row]]
            grams[first[row]] = (own * self.places[: len(own)]).sum(dtype=np.uint64)
        n_grams = np.maximum(1, counts - self.n + 1)
        begins = np.concatenate([[0], np.cumsum(n_grams)[:-1]])
        at = np.arange(n_grams.sum()) - np.repeat(begins, n_grams) + np.repeat(first, n_grams)
        return self._mix(grams[at]), begins, n_grams

    def _least(self, grams, begins):
        """Each hash function's least value over the n-grams of each text."""
        import numpy as np

        least = np.empty((self.bands * self.rows, len(begins)), np.uint64)
        buffer = np.empty_like(grams)
        for k in range(self.bands * self.rows):
            np.multiply(grams, self.factors[k], out=buffer)
            np.add(buffer, self.terms[k], out=buffer)
            least[k] = np.minimum.reduceat(buffer, begins)
        return least

    def _signed(self, least):
        """(band hashes, signatures): a row of each for each text; a signature has a byte of
        every hash function's least value."""
        import numpy as np

        shaped = self._mix(least.reshape(self.bands, self.rows, -1))
        hashes = (shaped * self.mixers[None, :, None]).sum(axis=1, dtype=np.uint64)
        hashes = self._mix(hashes + np.arange(self.bands, dtype=np.uint64)[:, None])
        signatures = (shaped.reshape(self.bands * self.rows, -1) >> np.uint64(56)).astype(np.uint8)
        return hashes.T.astype(np.int64), np.ascontiguousarray(signatures.T)

    def sign(self, texts: list[bytes]):
        """(band hashes, signatures, number of different n-grams) for texts that all have words."""
        import numpy as np

        whole = np.frombuffer(b"".join(texts), np.uint8)
        grams, begins, n_grams = self._grams(whole, np.array([text.count(b" ") for text in texts]))
        different = [len(np.unique(grams[b : b + n])) for b, n in zip(begins, n_grams, strict=True)]
        return *self._signed(self._least(grams, begins)), different

    def sign_long(self, text: bytes):
        """``sign`` for one long text, by pieces that have the words of an n-gram but one in
        common. Beside a piece it holds eight bytes for each word and each n-gram."""
        import numpy as np

        ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
        ends = ends.astype(np.uint32) if len(text) < 1 << 32 else ends
        least, seen = None, []
        for first in range(0, max(1, len(ends) - self.n + 1), PIECE_WORDS):
            last = min(first + PIECE_WORDS + self.n - 2, len(ends) - 1)
            piece = text[int(ends[first - 1]) + 1 if first else 0 : int(ends[last]) + 1]
            grams, begins, _ = self._grams(np.frombuffer(piece, np.uint8), np.array([last - first + 1]))
            own = self._least(grams, begins)
            least = own if least is None else np.minimum(least, own)
            seen.append(np.unique(grams))
        whole = np.concatenate(seen)
        seen.clear()
        whole.sort()
        return *self._signed(least), [int(np.count_nonzero(whole[1:] != whole[:-1])) + 1]


SIGNED = "doc_id long, text_key binary, n_grams int, n_words int, bands array<long>, signature binary"


def signatures(docs: DataFrame, bands: int, rows: int, text: str = "text") -> DataFrame:
    """Per row of ``docs`` its ``doc_id``, ``text_key`` (alike for equal words), ``n_grams``,
    ``n_words``, the hashes of its bands and its ``signature``. Texts are signed in pieces, so
    one of 100 MB takes a few times its own size of memory."""

    def sign(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        signer = Signer(bands, rows)
        for batch in batches:
            keys, grams, words = [], [], []
            flat, lengths, bytes_of = [], [], []

            def flush(block, signed=None, keys=keys, grams=grams, words=words, flat=flat, lengths=lengths, bytes_of=bytes_of):
                full = [own for own in block if own]
                hashes, own_bytes, different = signed or (signer.sign(full) if full else (np.zeros((0, bands), np.int64), [], []))
                flat.append(hashes.reshape(-1))
                found, signature = iter(different), iter(own_bytes)
                for own in block:
                    keys.append(text_key(own))
                    bytes_of.append(next(signature).tobytes() if own else b"")
                    grams.append(next(found) if own else 0)
                    words.append(own.count(b" "))
                    lengths.append(bands if own else 0)

            block, size = [], 0
            for value in batch.column(1):
                own = normalised(value.as_py())
                if len(own) > 4 * HASHED_BYTES:
                    flush(block)
                    flush([own], signer.sign_long(own))
                    block, size = [], 0
                    continue
                block.append(own)
                size += len(own)
                if size >= HASHED_BYTES:
                    flush(block)
                    block, size = [], 0
            flush(block)
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(keys, pa.binary()), pa.array(grams, pa.int32()), pa.array(words, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(flat))), pa.array(bytes_of, pa.binary()),
                ],
                names=["doc_id", "text_key", "n_grams", "n_words", "bands", "signature"],
            )

    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), body.alias("body")).mapInArrow(sign, SIGNED)


def least_agreement(similarity: float, hashes: int, doubt: float = DOUBT) -> float:
    """The share of equal bytes that two signatures of texts at ``similarity`` reach but for
    ``doubt`` standard deviations: a pair at 0.8 falls below it once in 700, a more similar one
    hardly ever, and texts that share less than half of their n-grams hardly ever reach it."""
    return similarity - doubt * math.sqrt(similarity * (1 - similarity) / hashes)


def connected(found):
    """The number of the least row that each row of a symmetric matrix is connected with."""
    import numpy as np

    m = len(found)
    label = np.arange(m)
    while True:
        least = np.minimum(label, np.where(found, label[None, :], m).min(axis=1, initial=m))
        least = least[least]
        if (least == label).all():
            return label
        label = least


def candidate_links(nodes: DataFrame, similarity: float = SIMILARITY, bands: int | None = None, rows: int | None = None) -> DataFrame:
    """``u, v``: links of the nodes of ``node, bands, signature`` that share a band's hash and
    whose signatures agree well enough; a node has one at most with each block of a band.

    A band of many nodes is cut into blocks, each pair of which is one small task's work, so
    neither a template's band nor one of thousands of near copies is any task's alone.
    """
    if bands is None or rows is None:
        bands, rows = choose_bands(similarity)
    enough = least_agreement(similarity, bands * rows)
    banded = nodes.select("node", F.explode("bands").alias("hash"))
    sizes = banded.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = written(banded.join(written(sizes, "shared-bands"), "hash").withColumn("blocks", F.ceil(F.col("n") / BAND_NODES).cast("int")), "band-nodes")
    # A signature travels once for each band that its node shares, texts do not travel.
    held = shared.join(nodes.select("node", "signature"), "node")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    each = held.select("hash", "node", "signature", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = each.select("hash", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "signature")

    def link(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def links(key, members):
            ids = np.array([node for _, node, _ in members], np.int64)
            order = np.argsort(ids)
            ids, sides = ids[order], np.array([side for side, _, _ in members])[order]
            held = np.frombuffer(b"".join(members[i][2] for i in order), np.uint8).reshape(len(ids), -1)
            step = max(1, (1 << 22) // held.size)
            near = np.concatenate([(held[k : k + step, None, :] == held[None, :, :]).mean(axis=2, dtype=np.float32) >= enough for k in range(0, len(ids), step)])
            np.fill_diagonal(near, False)
            if key[1] != key[2]:
                near &= sides[:, None] != sides[None, :]
            label = connected(near)
            far = label != np.arange(len(ids))
            return ids[far], ids[label[far]]

        def emit(found):
            columns = [np.concatenate(c) for c in zip(*found, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["u", "v"])

        key, members, found = None, [], []
        for batch in batches:
            for hash_, low, high, side, node, signature in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (hash_, low, high) != key:
                    if len(members) > 1:
                        found.append(links(key, members))
                    key, members = (hash_, low, high), []
                members.append((side, node, signature))
            if len(found) > 1000:
                yield emit(found)
                found = []
        if len(members) > 1:
            found.append(links(key, members))
        if found:
            yield emit(found)

    key = "hash", "low", "high"
    found = dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(link, "u long, v long")
    return found.distinct()


class IdFilter:
    """A bit for the hash of each wanted id: never a wrong no, and a yes for few others while
    ids are fewer than bits. Its size is bounded; when it is full it says yes to all."""

    def __init__(self, ids: DataFrame, name: str):
        wanted = max(1024, 16 * ids.count())
        self.bits = min(MOST_FILTER_BITS, 1 << (wanted - 1).bit_length())
        place = F.crc32(F.col(name).cast("string")) % self.bits
        words = ids.where(F.col(name).isNotNull()).select((place / 32).cast("long").alias("word"), F.expr(f"shiftleft(1L, cast(crc32(cast({name} as string)) % 32 as int))").alias("bit"))
        found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
        self.words = self._filled(found, self.bits)

    @staticmethod
    def _filled(found, bits: int) -> bytes:
        import numpy as np

        words = np.zeros(bits // 32, "<u4")
        words[found.column("word").to_numpy()] = found.column("bits").to_numpy().astype("<u4")
        return words.tobytes()

    def keeps(self, own_id: int | None) -> bool:
        if own_id is None:
            return True
        place = zlib.crc32(str(own_id).encode()) % self.bits
        return bool(self.words[place >> 3] >> (place & 7) & 1)


def comparisons(nodes: DataFrame, found: DataFrame, similarity: float) -> DataFrame:
    """``found`` (``node, component``) with ``task``: the comparisons a node takes part in.

    A component of bounded size is one. A larger one is cut into size classes, whose bounds
    lie so far apart that similar sets are in the same or in adjacent ones, and these into
    blocks; two blocks are one comparison. A node has a row for each block that its own
    meets, so rows grow with the blocks and not with the pairs.
    """
    step = math.log(1 / similarity)
    sized = nodes.select("node", F.floor(F.log(F.greatest("n_grams", F.lit(1))) / step).cast("int").alias("class"), "n_words", "n_copies", "text_key", "rep")
    members = written(found.join(sized, "node"), "members")
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_NODES), F.ceil(F.sum("n_words") / BLOCK_WORDS)).cast("int")
    classes = members.groupBy("component", "class").agg(blocks.alias("blocks"), F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("words"))
    layout = classes.groupBy("component").agg(
        F.map_from_entries(F.collect_list(F.struct("class", "blocks"))).alias("layout"),
        ((F.sum("n") <= BLOCK_NODES) & (F.sum("words") <= BLOCK_WORDS)).alias("whole"),
    )
    placed = members.join(written(layout, "layout"), "component").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.element_at("layout", F.col("class"))).cast("int")
    )

    def meets(other, at):
        numbers = F.sequence(F.lit(0), F.coalesce(F.try_element_at("layout", other), F.lit(0)) - 1)
        return F.when(F.map_contains_key("layout", other), F.transform(numbers, at)).otherwise(F.array().cast("array<string>"))

    name = lambda c, b, d, e: F.concat_ws(" ", c, b, d, e)
    own, block = F.col("class"), F.col("block")
    tasks = F.concat(
        meets(own, lambda o: name(own, F.least(block, o), own, F.greatest(block, o))),
        meets(own + 1, lambda o: name(own, block, own + 1, o)),
        meets(own - 1, lambda o: name(own - 1, o, own, block)),
    )
    side = F.concat_ws(" ", "class", "block")
    return placed.select(
        "node", "component", "text_key", "rep", "n_copies", side.alias("side"),
        F.when(F.col("whole"), F.array(F.lit(""))).otherwise(tasks).alias("tasks"),
    )


class Comparison:
    """Exact similarity of all pairs of a few texts, or of those across two sides."""

    def __init__(self, similarity: float, n: int = WORDS):
        self.similarity, self.n = similarity, n

    def pairs_of(self, texts: list[bytes]):
        """(text, n-gram) of all different n-grams, as two arrays of numbers. Equal numbers
        are equal n-grams: they are ranked step by step and nowhere hashed."""
        import numpy as np

        known: dict[bytes, int] = {}
        parts = [np.fromiter((known.setdefault(w, len(known)) for w in text.split()), np.int64) for text in texts]
        counts = np.array([len(part) for part in parts])
        words = np.concatenate(parts)
        owner = np.repeat(np.arange(len(texts)), counts)
        if len(words) < self.n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        grams = words[: len(words) - self.n + 1]
        for k in range(1, self.n):
            joined = grams * np.int64(len(known)) + words[k : k + len(grams)]
            grams = np.unique(joined, return_inverse=True)[1].reshape(-1)
        inside = owner[: len(grams)] == owner[self.n - 1 :]
        n_grams = np.int64(grams.max() + 1)
        codes = np.unique(owner[: len(grams)][inside] * n_grams + grams[inside])
        return codes // n_grams, codes % n_grams

    def links(self, texts: list[bytes], across=None):
        """A symmetric matrix of who is similar to whom. ``across``: the side of each text,
        if only pairs of different sides count. Texts of fewer words than an n-gram are
        similar only to the same text, which is another node's never."""
        import numpy as np

        m = len(texts)
        owner, grams = self.pairs_of(texts)
        sizes = np.bincount(owner, minlength=m)
        shared = np.bincount(grams)[grams] > 1 if len(grams) else np.zeros(0, bool)
        owner, column = owner[shared], np.unique(grams[shared], return_inverse=True)[1].reshape(-1)
        common = np.zeros((m, m), np.float32)
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        width = max(256, (4 << 20) // max(1, m))
        for left in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            low, high = np.searchsorted(column, [left, left + width])
            held = np.zeros((m, width), np.float32)
            held[owner[low:high], column[low:high] - left] = 1
            common += held @ held.T
        union = sizes[:, None] + sizes[None, :] - common
        found = (common > 0) & (common >= self.similarity * union - 1e-6)
        np.fill_diagonal(found, False)
        if across is not None:
            found &= across[:, None] != across[None, :]
        return found

    def outcome(self, nodes, weights, found):
        """Per node: the weight of what it is linked to, and the least node it hangs with."""
        import numpy as np

        order = np.argsort(nodes)
        label = np.empty(len(nodes), np.int64)
        label[order] = connected(found[np.ix_(order, order)])
        return found @ weights, nodes[order][label]


COMPARED = "node long, links long, root long"


def compared(texts: DataFrame, similarity: float, tasks: int) -> DataFrame:
    """``node, links, root`` from ``component, task, side, node, n_copies, words``, for each
    comparison. A comparison's rows meet in one task, one after the other. The number of tasks
    is given: their work is more than their few bytes would have adaptive execution think."""

    def compare(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        own = Comparison(similarity)

        def result(rows):
            by_node = {row[0]: row for row in rows}  # rows of documents that repeat are one node
            rows = list(by_node.values())
            if len(rows) < 2:
                return None
            nodes = np.array([row[0] for row in rows], np.int64)
            weights = np.array([row[1] for row in rows], np.int64)
            parts = rows[0][4].split(" ")
            first, second = " ".join(parts[:2]), " ".join(parts[2:])
            across = np.array([row[3] == first for row in rows]) if first != second and second else None
            links, roots = own.outcome(nodes, weights, own.links([row[2] for row in rows], across))
            some = links > 0
            return (nodes[some], links[some], roots[some]) if some.any() else None

        def emit(results):
            columns = [np.concatenate(c) for c in zip(*results, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["node", "links", "root"])

        key, rows, results = None, [], []
        for batch in batches:
            for component, task, node, copies, words, side in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (component, task) != key:
                    if rows and (one := result(rows)):
                        results.append(one)
                    key, rows = (component, task), []
                rows.append((node, copies, words, side, task))
            if len(results) > 1000:
                yield emit(results)
                results = []
        if rows and (one := result(rows)):
            results.append(one)
        if results:
            yield emit(results)

    rows = texts.select("component", "task", "node", "n_copies", "words", "side")
    return rows.repartition(tasks, "component", "task").sortWithinPartitions("component", "task").mapInArrow(compare, COMPARED)


def _keyed(batches: Iterator, at: int, with_words: bool) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        words = [normalised(text.as_py() or "") for text in batch.column(at)]
        added = [pa.array(map(text_key, words), pa.binary())] + ([pa.array(words, pa.binary())] if with_words else [])
        names = [*batch.schema.names, "text_key", "words"][: len(batch.schema.names) + len(added)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=names)


def _nodes(docs: DataFrame, similarity: float, recall: float, text: str) -> tuple[DataFrame, DataFrame]:
    """(rows, nodes): the signed rows and, of each different text, its number ``node``, its
    least ``doc_id`` as ``rep`` and how many rows have it."""
    signed = written(signatures(docs, *choose_bands(similarity, recall), text), "signatures")
    same = signed.groupBy("text_key", "n_grams", "n_words").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n_copies"), F.first("bands").alias("bands"), F.first("signature").alias("signature")
    )
    return signed, written(same.withColumn("node", F.monotonically_increasing_id()), "nodes")


def join_similar(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``class_id`` and ``n_links``, and ``text_key``.

    Two documents are linked if their sets of lower-cased word 5-grams have a Jaccard
    similarity of at least ``similarity``; a text of fewer words is one n-gram. ``n_links``
    counts a document's links to other rows, copies included; a class is what links connect,
    named by its least ``doc_id``. Texts without words are copies of each other. Rows without
    a ``doc_id`` take part; a class of such rows only has a null ``class_id``.

    A pair at ``similarity`` is found with a probability of ``recall`` at least, and a more
    similar one, or one that others connect, with a higher one. No link is kept back for
    its group's size.
    """
    signed, nodes = _nodes(docs, similarity, recall, text)
    found = components(candidate_links(nodes, similarity, *choose_bands(similarity, recall)))
    placed = written(comparisons(nodes, found, similarity), "placed")

    rows = docs.select(F.col("doc_id").cast("long").alias("own_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("body"))
    wanted = rows.sparkSession.sparkContext.broadcast(IdFilter(placed, "rep"))

    def only_wanted(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            yield batch.filter(pa.array([wanted.value.keeps(own_id) for own_id in batch.column(0).to_pylist()], pa.bool_()))

    keyed = rows.mapInArrow(
        lambda batches: (b.select(["own_id", "text_key", "words"]) for b in _keyed(only_wanted(batches), 1, True)),
        "own_id long, text_key binary, words binary",
    )
    texts = keyed.join(placed.withColumnRenamed("text_key", "node_key"), (F.col("text_key") == F.col("node_key")) & F.col("own_id").eqNullSafe(F.col("rep")))
    texts = texts.select("component", F.explode("tasks").alias("task"), "side", "node", "n_copies", "words")
    sides = placed.agg(F.sum(F.size("tasks"))).first()[0] or 0
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-sides // TASK_ROWS))
    links = written(compared(texts, similarity, tasks), "links")

    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(links.select(F.col("node").alias("u"), F.col("root").alias("v")))
    named = written(
        nodes.select("node", "text_key", "rep", "n_copies").join(counts, "node", "left").join(classes, "node", "left")
        .select("text_key", "rep", F.coalesce("component", "node").alias("component"), (F.col("n_copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")),
        "named",
    )
    least = written(named.groupBy("component").agg(F.min("rep").alias("class_id")), "classes")
    result = named.join(least, "component").select("text_key", "class_id", "n_links", "component")
    return signed.select("doc_id", "text_key").join(result, "text_key").select("doc_id", "class_id", "n_links", "text_key", "component")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each class the one with the
    least ``doc_id``, or any one where no row of it has an id."""
    found = written(join_similar(docs, similarity, text=text), "classes-of-rows")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")
    best = found.groupBy("component").agg(F.min(order).alias("best"))
    stays = written(best.select("best.doc_id", F.col("best.text_key").alias("key")), "decided")
    contested = written(found.where("n_links > 0").select(F.col("text_key").alias("key")).distinct(), "contested")
    return keep_chosen(docs, lambda own: text_key(normalised(own.decode())), stays, contested, text)
