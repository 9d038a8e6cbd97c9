"""Quality rules as a ledger: every rule is evaluated once, failures are kept as bits beside the measurements.

A policy is a named version of a bit mask. Applying one, comparing versions and asking what each rule alone removes are bitwise
expressions over the ledger; no text is read again.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import in_blocks, ship

SYMBOLS, WHITE = "#*$%&|<>", " \t\n\x0b\f\r"
MIN_WORDS, WINDOW = 50, 3

MEASURES = pa.struct([(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
                                                "n_upper_words", "longest_word")])

#: Rules by bit: name and the condition under which a document fails. Two bits are the base rules.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", f"n_words < {MIN_WORDS}"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > 3 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("upper_case", "2 * n_upper_words > n_words"),
    ("word_length", "word_chars < 2 * n_words or word_chars > 20 * n_words"),
    ("long_word", "longest_word > 1000"),
)
BASE = 0b11


def mask_of(*names: str) -> int:
    bits = {name: 1 << k for k, (name, _) in enumerate(RULES)}
    return reduce(lambda a, b: a | b, (bits[n] for n in names), 0)


#: Versions of the policy. A document is kept if it fails no rule of the mask.
POLICIES: dict[str, int] = {
    "base": BASE,
    "v1": BASE | mask_of("symbols", "upper_case"),
    "v2": BASE | mask_of("symbols", "upper_case", "repeated_lines", "word_length", "long_word"),
}
CURRENT = "v2"


def repeated(words: list, window: int = WINDOW) -> int:
    """Words that lie in a window of words found twice or more, first finds included."""
    if len(words) <= window:
        return 0
    number: dict = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    keys = codes[:len(codes) - window + 1]
    for k in range(1, window):
        # Renumbered at each step, so that the pairs stay within 64 bits whatever the number of words.
        _, keys = np.unique(keys, return_inverse=True)
        keys = keys * len(number) + codes[k:len(codes) - window + 1 + k]
    _, back, counts = np.unique(keys, return_inverse=True, return_counts=True)
    at = np.flatnonzero(counts[back] > 1)
    inside = np.zeros(len(words), bool)
    for k in range(window):
        inside[at + k] = True
    return int(inside.sum())


def _measure(text: str) -> tuple[int, ...]:
    words = text.encode().split()  # bytes split at ASCII white space only
    seen, again, lines = set(), 0, 0
    for line in text.split("\n"):
        if line.strip(WHITE):
            lines += 1
            again += line in seen
            seen.add(line)
    upper = sum(1 for w in words if w.isupper() and len(w) > 1)
    longest = max(map(len, words), default=0)
    return (len(words), len(text) - sum(map(text.count, WHITE)), sum(map(text.count, SYMBOLS)), again, repeated(words), lines, upper, longest)


def _measures(texts: pa.Array):
    return list(zip(*[_measure(t.as_py()) for t in texts])) or [[]] * MEASURES.num_fields


def failed(rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """Failure bits from the measurements."""
    return reduce(lambda a, b: a.bitwiseOR(b), (F.when(F.expr(c), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, (_, c) in enumerate(rules)))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements and failure bits of every row of ``docs``; one pass over the text, nothing is shuffled.

    A null or empty text has no words and fails ``few_words``; null ids and repeated rows stay; other columns are not read.
    """
    ship(docs.sparkSession)
    kind = "struct<" + ",".join(f"{f.name}:bigint" for f in MEASURES) + ">"

    @F.arrow_udf(kind)
    def measures(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from in_blocks(columns, _measures, MEASURES)

    measured = docs.select(F.col(id_col).alias("doc_id"), measures(F.col(text_col)).alias("m")).select("doc_id", "m.*")
    return measured.withColumn("failed", failed())


def apply_policy(book: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with the verdict of one version of the policy."""
    hit = F.col("failed").bitwiseAND(F.lit(POLICIES[policy]))
    return book.withColumn("base_failed", F.col("failed").bitwiseAND(F.lit(BASE)) != 0).withColumn("kept", hit == 0)


def ablation(book: DataFrame) -> DataFrame:
    """For each version and rule: documents that fail the rule, that fail it alone within the version, and that the version drops.

    Documents are first counted by their failure bits, so all versions are computed from one row per bit pattern.
    """
    counts = book.groupBy("failed").agg(F.count("*").alias("n"))
    cells = F.array(*[F.struct(F.lit(v).alias("policy"), F.lit(m).cast("long").alias("mask"), F.lit(n).alias("rule"), F.lit(1 << k).cast("long").alias("bit"))
                      for v, m in POLICIES.items() for k, (n, _) in enumerate(RULES) if m >> k & 1])
    hit = F.col("failed").bitwiseAND(F.col("c.mask"))
    total = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))
    return (counts.select("failed", "n", F.explode(cells).alias("c"))
            .groupBy(F.col("c.policy").alias("policy"), F.col("c.rule").alias("rule"))
            .agg(total(hit.bitwiseAND(F.col("c.bit")) != 0).alias("n_fail"), total(hit == F.col("c.bit")).alias("n_only"), total(hit != 0).alias("n_dropped")))
