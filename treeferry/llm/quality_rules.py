"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per text. The ledger keeps its measurements and one bit for
each failed rule, so a policy is only a mask over those bits: another version of a policy,
or the effect of leaving one rule out, is a bitwise pass over the ledger and no second
look at the texts.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeferry.llm.columns import let

WINDOW = 5
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

#: (rule, whether a text fails it), in the order of the bits. Only integers are compared,
#: so every engine decides alike. New rules go to the end: bits of stored ledgers stay valid.
RULES: tuple[tuple[str, str], ...] = (
    ("too_few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "n_symbols >= 5 AND 100 * n_symbols > 10 * n_words"),
    ("duplicate_lines", "n_dup_lines >= 2 AND 100 * n_dup_lines > 30 * n_lines"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    ("shouting", "100 * n_exclamations > 20 * n_words"),
    ("capitals", "n_words >= 10 AND 100 * n_capitals > 30 * word_chars"),
)
BITS = {rule: 1 << bit for bit, (rule, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A version of what rejects a text: any one of these rules."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BITS[rule] for rule in dict.fromkeys(self.rules))


BASE = Policy("base-1", ("too_few_words", "repeated_windows"))
EVERY_RULE = Policy("strict-1", tuple(BITS))
#: Short lines repeat in good texts too, and where they do not, windows repeat as well: by
#: the ablation of ``strict-1`` this rule alone rejected none but good texts.
STRICT = Policy("strict-2", tuple(rule for rule in BITS if rule != "duplicate_lines"))
POLICIES = {policy.version: policy for policy in (BASE, EVERY_RULE, STRICT)}

MEASUREMENTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_exclamations", "n_capitals",
)


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _repeated_words(words: Column) -> Column:
    """Words inside a window of five words that occurs in the text at least twice.

    Hashes of all windows tell most texts, which repeat nothing, at once: without equal
    hashes there are no equal windows. The others sort their windows with positions, and
    equal neighbours are repeats, so the cost stays n log n however much is repeated.
    """
    starts = F.sequence(F.lit(0), F.size(words) - F.lit(WINDOW))
    hashes = F.transform(starts, lambda i: F.xxhash64(*(F.get(words, i + F.lit(k)) for k in range(WINDOW))))

    def covered(windows: Column) -> Column:
        repeated = F.filter(
            windows,
            lambda x, j: (x["window"] == F.get(windows, j - 1)["window"])
            | (x["window"] == F.get(windows, j + 1)["window"]),
        )
        positions = F.array_sort(F.transform(repeated, lambda x: x["at"]))
        return let(
            positions,
            lambda at: F.aggregate(
                F.transform(at, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - x, F.lit(WINDOW)))),
                F.lit(0).cast("long"),
                lambda total, own: total + own,
            ),
        )

    windows = F.array_sort(
        F.transform(starts, lambda i: F.struct(F.array_join(F.slice(words, i + 1, WINDOW), " ").alias("window"), i.alias("at")))
    )
    repeats = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(F.size(words) < WINDOW + 1, F.lit(0).cast("long")).when(repeats, let(windows, covered)).otherwise(
        F.lit(0).cast("long")
    )


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id`` and the measurements of each text; a null text is an empty one."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    words = F.array_remove(F.split(body, r"[\x20\x09-\x0D]+"), "")
    lines = F.filter(F.split(body, "\n"), lambda line: F.length(_without(line, SPACES)) > 0)

    def all_of(w: Column, l: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            (F.size(l) - F.size(F.array_distinct(l))).cast("long").alias("n_dup_lines"),
            _repeated_words(w).alias("n_repeat_words"),
            F.size(l).cast("long").alias("n_lines"),
        )

    length = F.length(body).cast("long")
    measured = docs.select(
        F.col("doc_id"),
        let(words, lambda w: let(lines, lambda l: all_of(w, l))).alias("m"),
        F.length(_without(body, SPACES)).cast("long").alias("word_chars"),
        (length - F.length(_without(body, SYMBOLS))).alias("n_symbols"),
        (length - F.length(_without(body, "!"))).alias("n_exclamations"),
        F.length(F.regexp_replace(body, r"\P{Lu}+", "")).cast("long").alias("n_capitals"),
    )
    return measured.select(
        "doc_id", "m.n_words", "word_chars", "n_symbols", "m.n_dup_lines", "m.n_repeat_words", "m.n_lines",
        "n_exclamations", "n_capitals",
    )


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the measurements, and ``failed`` with a
    bit for each failed rule.

    Only ``doc_id`` and the text are read, so other columns may have any name. Null and
    empty texts have no words and fail ``too_few_words``. Rows that repeat, and null
    ``doc_id``, get a row each. No row leaves its partition, whatever the sources' sizes.
    """
    bits = [F.when(F.expr(fails), BITS[rule]).otherwise(0) for rule, fails in RULES]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measure(docs, text).withColumn("failed", failed.cast("long"))


def rejected_by(policy: Policy, failed: Column | None = None) -> Column:
    """Whether a policy rejects the row of a ledger."""
    return (F.col("failed") if failed is None else failed).bitwiseAND(F.lit(policy.mask).cast("long")) != 0


def apply_policies(entries: DataFrame, policies: Mapping[str, Policy] = POLICIES) -> DataFrame:
    """A ledger with one boolean column ``kept_<version>`` for each policy."""
    return entries.select("*", *((~rejected_by(p)).alias(f"kept_{name}") for name, p in policies.items()))


def ablation(entries: DataFrame, policy: Policy) -> DataFrame:
    """What each rule of a policy does: ``rule``, ``fails`` (texts that fail it), ``alone``
    (texts that it alone rejects, so kept without it) and ``rejected`` (by the policy).

    One pass: the ledger is first counted by its masked bits, of which there are at most
    two to the number of rules, and the rules are told apart on those few counts.
    """
    rules = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(BITS[r]).cast("long").alias("bit")) for r in policy.rules)))
    masked = F.col("failed").bitwiseAND(F.lit(policy.mask).cast("long"))
    counts = entries.groupBy(masked.alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    some = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).alias
    return (
        counts.select("bits", "n", rules.alias("r"))
        .groupBy("r.rule")
        .agg(
            some(F.col("bits").bitwiseAND(F.col("r.bit")) != 0)("fails"),
            some(F.col("bits") == F.col("r.bit"))("alone"),
            some(F.col("bits") != 0)("rejected"),
        )
    )


def keep_good(docs: DataFrame, policy: Policy = STRICT) -> DataFrame:
    """The rows of ``docs`` that a policy keeps, with all their columns.

    The rules run beside the row, so nothing is joined and clashing names do not matter.
    """
    whole = F.struct(*(docs[f"`{name}`"] for name in docs.columns))
    rows = docs.select(whole.alias("doc_id"), docs["text"].alias("text"))
    return ledger(rows).where(~rejected_by(policy)).select("doc_id.*")


def verdicts(docs: DataFrame, policy: Policy = STRICT) -> DataFrame:
    """The ledger with the base verdict and that of ``policy``."""
    failed = rejected_by(BASE)
    return ledger(docs).select(
        "doc_id", *MEASUREMENTS[:5], failed.alias("base_failed"), (~failed & ~rejected_by(policy)).alias("kept"), "failed"
    )


def _sql_rules() -> str:
    return " + ".join(f"CASE WHEN {fails} THEN {BITS[rule]} ELSE 0 END" for rule, fails in RULES)


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
g AS (SELECT r, ws, CASE WHEN len(ws) < 5 THEN [] ELSE list_transform(range(1, len(ws) - 3),
  lambda i: array_to_string(list_slice(ws, i, i + 4), ' ')) END AS gs FROM w),
pos AS (SELECT r, unnest(gs) AS g, unnest(range(len(gs))) AS i FROM g),
rep AS (SELECT r, i FROM pos QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
cov AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest(range(5)) AS k) GROUP BY r),
lines AS (SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
m AS (SELECT d.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(ls) AS BIGINT) AS n_lines,
  CAST(length(regexp_replace(t, '[^!]+', '', 'g')) AS BIGINT) AS n_exclamations,
  CAST(length(regexp_replace(t, '\P{{Lu}}+', '', 'g')) AS BIGINT) AS n_capitals
  FROM d JOIN w USING (r) JOIN lines USING (r) LEFT JOIN cov USING (r)),
l AS (SELECT *, CAST({_sql_rules()} AS BIGINT) AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  failed & {BASE.mask} <> 0 AS base_failed, failed & {STRICT.mask} = 0 AS kept, failed FROM l
"""
