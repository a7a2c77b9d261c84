"""Quality rules as a ledger of bits: every rule is evaluated once per document, policies are bit masks.

``ledger`` reads a text once and stores the measurements and one bit per failed rule. ``apply_policy`` and
``ablation`` only look at the bits, so a new policy version costs no second look at the texts.

Null and empty texts have no words, fail ``few_words`` and are not kept. Repeated rows are judged one by one,
texts of any length whole; equal lines and windows count by number, so there are no ties. An empty table has an empty ledger. Only doc_id and
text are read, whatever other columns there are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import BLANKS, WordHashes, map_texts, shingles, word_hashes

#: Name of each rule, in bit order, and when it fails (``None``: decided with the base columns below).
RULES = [
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "10 * n_symbols > 3 * n_words"),
    ("duplicate_lines", "n_lines >= 4 AND 10 * n_dup_lines > 3 * n_lines"),
    ("word_length", "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 25 * n_words)"),
    ("shouting", "n_upper_words >= 10 AND 10 * n_upper_words > 4 * n_words"),
    ("same_word_runs", "n_words >= 10 AND 10 * n_adjacent > 3 * n_words"),
    ("exclamation", "n_words >= 10 AND 10 * n_exclaimed > 3 * n_words"),
]
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_windows"]
#: A policy is a mask of the rules whose failure removes a document.
POLICIES = {1: BASE, 2: BASE | BIT["symbols"] | BIT["duplicate_lines"], 3: (1 << len(RULES)) - 1}
CURRENT = 3
WINDOW = 5
MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper_words", "n_adjacent", "n_exclaimed",
]


def repeated_words(codes: np.ndarray, width: int = WINDOW) -> int:
    """Words that lie in a window of ``width`` words found twice or more, the first one included."""
    if len(codes) <= width:
        return 0
    windows = shingles(codes, width)
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    starts = (counts[inverse] > 1).astype(np.int32)
    if not starts.any():
        return 0
    edges = np.zeros(len(codes) + 1, np.int32)
    edges[: len(starts)] += starts
    edges[width : width + len(starts)] -= starts
    return int((edges.cumsum()[:-1] > 0).sum())


def measure(text: bytes, hashes: WordHashes) -> list[int]:
    words = text.split()
    codes = hashes.of(words)
    dense = text.translate(None, BLANKS)
    continuation = int(((np.frombuffer(dense, np.uint8) & 0xC0) == 0x80).sum())
    lines = [x for x in text.split(b"\n") if x.split(None, 1)]
    return [
        len(words),
        len(dense) - continuation,
        len(dense) - len(dense.translate(None, b"#*$%&|<>")),
        len(lines) - len(set(lines)),
        repeated_words(codes),
        len(lines),
        sum(map(bytes.isupper, words)),
        int((codes[1:] == codes[:-1]).sum()),
        text.count(b"!! ") + text.endswith(b"!!"),
    ]


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements, and ``failed``: one bit per failed rule."""
    def work(texts: list[bytes]) -> dict[str, object]:
        hashes = word_hashes()
        rows = np.array([measure(t, hashes) for t in texts], np.int64).reshape(-1, len(MEASURES))
        return {name: pa.array(rows[:, i]) for i, name in enumerate(MEASURES)}

    measured = map_texts(docs, work, ", ".join(f"{m} bigint" for m in MEASURES))
    bits = sum((F.expr(f"IF({fails}, {BIT[name]}L, 0L)") for name, fails in RULES), F.lit(0).cast("long"))
    return measured.withColumn("failed", bits)


def apply_policy(rows: DataFrame, version: int = CURRENT) -> DataFrame:
    """``rows`` of a ledger with ``kept`` under the policy of that version."""
    return rows.withColumn("kept", F.col("failed").bitwiseAND(F.lit(POLICIES[version])) == 0)


def ablation(rows: DataFrame, version: int = CURRENT) -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail nothing else, and that stay without it."""
    mask = POLICIES[version]
    used = [(n, BIT[n]) for n, _ in RULES if BIT[n] & mask]
    per_mask = rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("n"))
    each = per_mask.select("bits", "n", F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(b).cast("long").alias("bit")) for n, b in used])).alias("r"))
    fails = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    alone = F.col("bits") == F.col("r.bit")
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(fails, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when(alone | (F.col("bits") == 0), F.col("n")).otherwise(0)).alias("n_kept_without"),
    )
