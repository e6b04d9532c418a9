"""Mixing of sources to target weights by iterative proportional fitting.

The tokens of all documents are summed by source, language and topic. A sample is to hold a
stated share of them. A cell's probability is the product of a factor for each of its
categories, at most 1, and raking moves the factors until the expected sums of each dimension
are at their targets. A category with fewer tokens than its target is taken whole, and the
others share what it leaves. Documents are drawn by a hash of their id, alike in every run.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeferry.scratch import written

#: Categories without a target of their own share this one, with the targets' remainder.
OTHER = "*"
# Target shares of tokens.
SOURCES = {"src0": 0.10}
LANGUAGES = {"en": 0.60, "de": 0.15, "fr": 0.14, "es": 0.10}
TOPICS = {"legal": 0.04, "contact": 0.06, "tabular": 0.03}
#: (topic, pattern found in its texts), tried in this order.
TOPIC_RULES = (
    ("legal", "(?i)licen[cs]ed|licen[cs]e,|copyright"),
    ("contact", "[A-Za-z0-9]@[A-Za-z0-9]|[0-9][0-9() -]{7,14}[0-9]"),
    ("tabular", r"\|[^|\n]*\|"),
)
ITERATIONS = 100
#: Sources without a target share what the targets leave in proportion to this power of their
#: tokens: 1 leaves their proportions, 0 makes them equal.
SOURCE_POWER = 0.5
#: Share of all tokens that a sample holds, where its categories have so many.
SAMPLE = 0.5
#: Raking ends when no sum is further from its target than this share of the sample.
CLOSE = 1e-5
#: Cells are bounded by the targets, never by the data; more targets than this are refused.
MOST_CELLS = 100_000

DIMENSIONS = ("source", "lang", "topic")
TARGETS: dict[str, Mapping[str, float]] = {"source": SOURCES, "lang": LANGUAGES, "topic": TOPICS}


def topic_of(text: Column) -> Column:
    found = F.lit(OTHER)
    for topic, pattern in reversed(TOPIC_RULES):
        found = F.when(text.rlike(pattern), topic).otherwise(found)
    return found


def measured(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] = TARGETS) -> list[Column]:
    """The categories of a row, each named as its dimension, and its ``tokens`` (words)."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    values = {"source": docs["source"], "lang": docs["lang"], "topic": topic_of(text)}
    named = [F.when(values[d].isin(list(targets[d])), values[d]).otherwise(OTHER).alias(d) for d in DIMENSIONS]
    return [*named, F.size(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")).cast("long").alias("tokens")]


def shares(targets: Mapping[str, float]) -> dict[str, float]:
    """The targets with the remainder for all other categories."""
    rest = 1.0 - sum(targets.values())
    if rest < -1e-9 or any(share < 0 for share in targets.values()):
        raise ValueError("targets are shares and sum to at most one")
    return {**targets, OTHER: max(0.0, rest)}


def draw(ids: Column, text: Column, seed: int) -> Column:
    """A number in [0, 1) by a row's id, or by its text where the id is null."""
    key = F.concat(F.coalesce(ids.cast("string"), F.md5(F.coalesce(text, F.lit("")))), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def filled(goals: Mapping[str, float], tokens: Mapping[str, float], size: float) -> dict[str, float]:
    """``size`` divided in proportion to ``goals``, no part above its ``tokens``."""
    whole: set[str] = set()
    while True:
        rest = sum(share for k, share in goals.items() if k not in whole)
        left = size - sum(tokens[k] for k in whole)
        more = {k for k, share in goals.items() if k not in whole and share > 0 and left * share >= tokens[k] * rest}
        if not more:
            return {k: tokens[k] if k in whole else left * share / rest if rest else 0.0 for k, share in goals.items()}
        whole |= more


def fitted(tokens: list[float], factors: list[float], goal: float) -> list[float]:
    """``min(1, a * factor)`` of each cell, with the ``a`` at which they hold ``goal`` tokens."""
    if goal <= 0:
        return [0.0] * len(tokens)
    order = sorted(range(len(tokens)), key=lambda i: -factors[i])
    left, rest = goal, sum(t * f for t, f in zip(tokens, factors, strict=True))
    for i in order:
        if left * factors[i] <= rest:
            return [min(1.0, left / rest * f) for f in factors]
        left, rest = left - tokens[i], rest - tokens[i] * factors[i]
        if left <= 0 or rest <= 0:
            break
    return [1.0] * len(tokens)


def _fit_each(table: DataFrame, factors: list[float], level: float | None, own: bool = False) -> DataFrame:
    """A source's cells fitted to its goal, the lesser of its tokens and ``level`` times its
    share (its tokens for None). With ``own``, ``source`` and ``odds`` by cell, else the
    expected tokens by ``cell``, a few rows from each task."""

    def fit(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sums: dict[int, float] = {}
        for batch in batches:
            sources, odds = [], []
            for source, share, cells in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                cells = [(c["cell"], float(c["tokens"])) for c in cells if factors[c["cell"]] > 0]
                tokens = [n for _, n in cells]
                goal = sum(tokens) if level is None else min(sum(tokens), level * share)
                found = fitted(tokens, [factors[cell] for cell, _ in cells], goal if share > 0 else 0.0)
                for (cell, n), p in zip(cells, found, strict=True):
                    sums[cell] = sums.get(cell, 0.0) + n * p
                sources.append(source)
                odds.append([(cell, p) for (cell, _), p in zip(cells, found, strict=True)])
            if own:
                yield pa.RecordBatch.from_arrays([pa.array(sources, pa.string()), pa.array(odds, pa.map_(pa.int32(), pa.float64()))], names=["source", "odds"])
        if not own:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(list(sums.values()), pa.float64())], names=["cell", "tokens"])

    return table.select("source", "share", "cells").mapInArrow(fit, "source string, odds map<int,double>" if own else "cell int, tokens double")


def _by_cell(fits: DataFrame, cells: int) -> list[float]:
    parts: list[list[float]] = [[] for _ in range(cells)]
    for row in fits.collect():
        parts[row["cell"]].append(row["tokens"])
    return [math.fsum(part) for part in parts]


def _shared(table: DataFrame, targets: Mapping[str, float], power: float) -> DataFrame:
    """``table`` with the target ``share`` of each source: its own, or its part of the remainder."""
    others = table.where(~F.col("source").isin(list(targets))) if targets else table
    whole = others.agg(F.sum(F.pow("live", F.lit(power)))).first()[0] or 1.0
    share = F.lit(max(0.0, 1.0 - sum(targets.values()))) * F.pow("live", F.lit(power)) / F.lit(whole)
    for name, own in targets.items():
        share = F.when(F.col("source") == name, F.lit(own)).otherwise(share)
    return table.withColumn("share", share.cast("double"))


def _level(table: DataFrame, size: float) -> float:
    """The level at which the sources' goals sum to ``size``: those with fewer tokens than
    ``level * share`` are whole. From below, each step counts more of them whole."""
    live = table.where("share > 0 AND live > 0")
    level = 0.0
    for _ in range(ITERATIONS):
        whole = F.col("live") <= F.lit(level) * F.col("share")
        row = live.agg(F.sum(F.when(whole, F.col("live")).otherwise(0.0)).alias("tokens"), F.sum(F.when(whole, 0.0).otherwise(F.col("share"))).alias("share")).first()
        if not row["share"]:
            break
        step = (size - row["tokens"]) / row["share"]
        if step <= level * (1 + 1e-12):
            break
        level = step
    return level


def sample_odds(rows: DataFrame, targets: Mapping[str, Mapping[str, float]], sample: float, power: float = SOURCE_POWER) -> DataFrame:
    """A table of ``source`` and ``odds``, the probability by cell of language and topic.

    Sources are rows of a table and never come to the driver; the cells that do are as many
    as there are pairs of language and topic targets. Each round fits every source by itself
    under the factors of languages and topics, and moves these by the sums found.
    """
    if not 0 < sample <= 1:
        raise ValueError("a sample is a share of the tokens, above 0 and at most 1")
    goals = [shares(targets[d]) for d in DIMENSIONS[1:]]
    pairs = [(lang, topic) for lang in goals[0] for topic in goals[1]]
    if len(pairs) > MOST_CELLS:
        raise ValueError(f"{len(pairs)} cells; at most {MOST_CELLS}")
    factors = [1.0 if goals[0][lang] > 0 and goals[1][topic] > 0 else 0.0 for lang, topic in pairs]
    dead = [cell for cell, factor in enumerate(factors) if not factor]
    sums = rows.groupBy("source", "cell").agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
    alive = F.when(~F.col("cell").isin(dead), F.col("tokens")).otherwise(0) if dead else F.col("tokens")
    table = sums.groupBy("source").agg(
        F.collect_list(F.struct("cell", "tokens")).alias("cells"),
        F.sum("tokens").cast("double").alias("tokens"), F.sum(alive).cast("double").alias("live"),
    )
    table = _shared(written(table, "sources"), targets["source"], power)
    whole = _by_cell(_fit_each(table, factors, None), len(pairs))
    size = min(sample * (table.agg(F.sum("tokens")).first()[0] or 0.0), math.fsum(whole))
    level = _level(table, size) if size else 0.0
    wanted = []
    for at, own in enumerate(goals):
        held: dict[str, float] = {}
        for pair, n in zip(pairs, whole, strict=True):
            held[pair[at]] = held.get(pair[at], 0.0) + n
        wanted.append(filled({k: own[k] for k, n in held.items() if n}, {k: n for k, n in held.items() if n}, size))
    for _ in range(ITERATIONS if size else 0):
        found = _by_cell(_fit_each(table, factors, level), len(pairs))
        moved, off = list(found), 0.0
        for again in range(20):
            for at, goal in enumerate(wanted):
                by: dict[str, float] = {}
                for pair, n in zip(pairs, moved, strict=True):
                    by[pair[at]] = by.get(pair[at], 0.0) + n
                if not again:
                    now = {k: math.fsum(n for pair, n in zip(pairs, found, strict=True) if pair[at] == k) for k in goal}
                    off = max(off, *(abs(now[k] - goal[k]) for k in goal))
                moved = [n * goal[pair[at]] / by[pair[at]] if by[pair[at]] else 0.0 for pair, n in zip(pairs, moved, strict=True)]
        if off <= CLOSE * size:
            break
        # Bounds, for targets that no sample of this size can have together; ``report`` tells.
        factors = [min(1e12, max(1e-12, f * m / n)) if n and m else f for f, m, n in zip(factors, moved, found, strict=True)]
    return written(_fit_each(table, factors, level, own=True), "odds")


def categories(docs: DataFrame, targets: Mapping[str, Mapping[str, float]]) -> list[Column]:
    """``measured`` with each source by its own name, and the ``cell`` of language and topic."""
    _, lang, topic, tokens = measured(docs, targets)
    source = F.coalesce(docs["source"].cast("string"), F.lit(OTHER)).alias("source")
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    cell = F.lit(0)
    for d, value in (("lang", docs["lang"]), ("topic", topic_of(text))):
        names = list(targets[d])
        place = F.array_position(F.array(*map(F.lit, names)), F.coalesce(value, F.lit(OTHER))) if names else F.lit(0)
        cell = cell * (len(names) + 1) + F.when(place > 0, place - 1).otherwise(len(names))
    return [source, lang, topic, tokens, cell.cast("int").alias("cell")]


def mix(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] = TARGETS, seed: int = 1, sample: float = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the categories ``source``, ``lang``, ``topic``,
    ``tokens``, ``probability`` (9 digits) and ``selected``. The selected rows are expected
    to hold ``sample`` of all tokens.

    Every source is a category of its own; null ones are one more, ``*``. A null language is
    another one. Texts without words weigh nothing; they are drawn as others of their cell,
    or never where it has no tokens. Rows of one id are drawn alike; a null id is drawn by
    its text.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = written(docs.select(docs["doc_id"], *categories(docs, targets), draw(docs["doc_id"], text, seed).alias("drawn")), "measured")
    odds = sample_odds(rows, targets, sample)
    p = F.coalesce(F.element_at("odds", F.col("cell")), F.lit(0.0))
    return rows.join(odds, "source", "left").select(
        "doc_id", *DIMENSIONS, "tokens", F.round(p, 9).alias("probability"), (F.col("drawn") < p).alias("selected")
    )


def keep_drawn(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] = TARGETS, seed: int = 1, sample: float = SAMPLE) -> DataFrame:
    """The drawn rows of ``docs``, with all their columns. Texts are measured once: the rows
    are written with what was found."""
    whole = F.struct(*(docs[f"`{name}`"] for name in docs.columns)).alias("own_row")
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    source, _, _, tokens, cell = categories(docs, targets)
    rows = written(docs.select(whole, source, cell, tokens, draw(docs["doc_id"], text, seed).alias("drawn")), "measured")
    odds = sample_odds(rows.select("source", "cell", "tokens"), targets, sample)
    return rows.join(odds, "source").where(F.col("drawn") < F.element_at("odds", F.col("cell"))).select("own_row.*")


def report(mixed: DataFrame, targets: Mapping[str, Mapping[str, float]] = TARGETS, power: float = SOURCE_POWER) -> DataFrame:
    """What a mix does to the shares, from the rows of ``mix``: ``dimension, category, tokens,
    share`` (of all tokens), ``target``, ``expected`` and ``drawn`` (shares of the sample), and
    ``off``, the target less what is expected. A row of dimension ``kept`` has the shares of
    all tokens that are expected and drawn. A category is below its target where it has too
    few tokens, and is whole then; the others share what it leaves."""
    held, taken = F.col("tokens") * F.col("probability"), F.when(F.col("selected"), F.col("tokens")).otherwise(0)
    sums = (F.sum("tokens").alias("tokens"), F.sum(held).alias("expected_tokens"), F.sum(taken).alias("drawn_tokens"))
    parts = []
    for d in DIMENSIONS:
        own = mixed.groupBy(F.coalesce(F.col(d).cast("string"), F.lit(OTHER)).alias("category")).agg(*sums)
        if d == "source":
            own = _shared(own.withColumn("live", F.col("tokens").cast("double")).withColumn("source", F.col("category")), targets[d], power)
            own = own.drop("live", "source").withColumnRenamed("share", "target")
        else:
            goal = F.lit(shares(targets[d])[OTHER])
            for name, share in targets[d].items():
                goal = F.when(F.col("category") == name, share).otherwise(goal)
            own = own.withColumn("target", goal.cast("double"))
        parts.append(own.select(F.lit(d).alias("dimension"), "category", "tokens", "target", "expected_tokens", "drawn_tokens"))
    whole = mixed.agg(*sums).select(*(F.coalesce(F.col(c), F.lit(0)).alias(f"all_{c}") for c in ("tokens", "expected_tokens", "drawn_tokens")))
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).crossJoin(F.broadcast(whole))
    share = lambda n, of: F.when(F.col(of) > 0, F.col(n) / F.col(of)).otherwise(0.0)
    named = rows.select(
        "dimension", "category", F.col("tokens").cast("long").alias("tokens"), share("tokens", "all_tokens").alias("share"), "target",
        share("expected_tokens", "all_expected_tokens").alias("expected"), share("drawn_tokens", "all_drawn_tokens").alias("drawn"),
    )
    kept = whole.select(
        F.lit("kept").alias("dimension"), F.lit(OTHER).alias("category"), F.col("all_tokens").cast("long").alias("tokens"), F.lit(1.0).alias("share"),
        F.lit(None).cast("double").alias("target"), share("all_expected_tokens", "all_tokens").alias("expected"), share("all_drawn_tokens", "all_tokens").alias("drawn"),
    )
    return named.unionByName(kept).withColumn("off", F.col("target") - F.col("expected"))
