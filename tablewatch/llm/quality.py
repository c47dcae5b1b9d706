"""Quality rules as a bitmask ledger.

Every rule is evaluated once per text.  The ledger keeps the measurements and one
bit per failed rule; a policy is a named, versioned set of rules, so accepting or
rejecting under any policy, and counting what each of its rules costs, is bitwise
work on the ledger and never reads a text again.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewatch.llm.common import pick

WINDOW = 8
PIECE = 1 << 20                 # bytes of the texts measured together
_SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper",
            "n_echo_words", "n_distinct_words")

#: name -> SQL predicate over the measurements that is true when a text fails.  The position is the bit; only append.
RULES = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > 2 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 14 * n_words",
    "repeated_lines": "10 * n_dup_lines > 4 * n_lines",
    "capitals": "10 * n_upper > 4 * word_chars",
    "echoed_words": "10 * n_echo_words > 3 * n_words",
    "few_distinct_words": "n_words >= 100 and 10 * n_distinct_words < n_words",
}
BITS = {name: 1 << i for i, name in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BITS[r] for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
FULL = Policy("full", 1, tuple(RULES))


def _pair_rank(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Equal numbers exactly for equal pairs."""
    return np.unique(left * (int(right.max()) + 1) + right, return_inverse=True)[1]


def _repeated(ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Marks the words in windows that occur twice or more in their own text; ids differ between texts."""
    n = len(ids)
    marked = np.zeros(n, bool)
    if n < WINDOW:
        return marked
    span, rank = 1, ids
    while span < WINDOW:                        # windows of 1, 2, 4, 8 words are numbered from their halves
        rank = _pair_rank(rank[:-span], rank[span:])
        span *= 2
    start = np.arange(n - WINDOW + 1)
    inside = start + WINDOW <= ends[np.searchsorted(ends, start, "right")]
    twice = inside & (np.bincount(rank, weights=inside)[rank] > 1)
    edge = np.zeros(n + 1, np.int64)
    hits = start[twice]
    np.add.at(edge, hits, 1)
    np.add.at(edge, hits + WINDOW, -1)
    return np.cumsum(edge[:-1]) > 0


def measure(texts: list[bytes]) -> np.ndarray:
    """One row of MEASURES per UTF-8 text."""
    import pandas as pd
    out = np.zeros((len(texts), len(MEASURES)), np.int64)
    symbol, upper, white = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
    symbol[list(_SYMBOLS)] = upper[65:91] = white[[32, *range(9, 14)]] = True
    words = [t.split() for t in texts]
    counts = np.array([len(w) for w in words], np.int64)
    for i, t in enumerate(texts):
        raw = np.frombuffer(t, np.uint8)
        points = (raw & 0xC0) != 0x80
        lines = [x for x in t.split(b"\n") if x and not x.isspace()]
        capitals = upper[raw].sum() + ((raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E)).sum()
        out[i, 1:5] = (points & ~white[raw]).sum(), symbol[raw].sum(), len(lines), len(lines) - len(set(lines))
        out[i, 6] = capitals
    out[:, 0] = counts
    total = int(counts.sum())
    if total:
        flat = np.empty(total, object)
        flat[:] = [w for ws in words for w in ws]
        words.clear()
        word, known = pd.factorize(flat)
        ends = np.cumsum(counts)
        ends = ends[counts > 0]
        text = np.repeat(np.arange(len(texts)), counts)
        own, ids = np.unique(text * len(known) + word, return_inverse=True)
        out[:, 8] = np.bincount(own // len(known), minlength=len(texts))
        echo = np.concatenate([[False], ids[1:] == ids[:-1]])
        out[:, 5] = np.bincount(text, weights=_repeated(ids, ends), minlength=len(texts))
        out[:, 7] = np.bincount(text, weights=echo, minlength=len(texts))
    return out


def pieces(column, most: int = PIECE, rows: int = 256):
    """(first row, rows) of pieces of a binary Arrow column: of ``most`` bytes (but for a single longer text) and ``rows`` rows at most."""
    import pyarrow.compute as pc
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        limit = (ends[at - 1] if at else 0) + most
        n = min(max(int(np.searchsorted(ends, limit, "right")) - at, 1), rows)
        yield at, n
        at += n


def measured(text: Column) -> Column:
    """Struct of the measurements of a text column (null: an empty text)."""
    @F.arrow_udf(", ".join(f"{m} long" for m in MEASURES))
    def run(column):
        import pyarrow as pa
        found = [measure(column.slice(at, n).to_pylist()) for at, n in pieces(column)]
        found = np.concatenate(found) if found else np.zeros((0, len(MEASURES)), np.int64)
        return pa.StructArray.from_arrays([pa.array(found[:, i]) for i in range(len(MEASURES))], list(MEASURES))
    return run(F.coalesce(text, F.lit("")).cast("binary"))


def failures(measures: str) -> Column:
    """Bitmask of the failed rules, from a column of measurements."""
    bits = F.lit(0).cast("long")
    for name, rule in RULES.items():
        for m in MEASURES:
            rule = re.sub(rf"\b{m}\b", f"{measures}.{m}", rule)
        bits = bits.bitwiseOR(F.when(F.expr(rule), F.lit(BITS[name]).cast("long")).otherwise(F.lit(0).cast("long")))
    return bits


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, measurements, failed) per row; bit i of ``failed`` is rule i of RULES.

    A null text is an empty one: no words, so it fails few_words.  Null ids and
    repeated rows keep their own row; other columns are not read, and an empty table
    gives an empty ledger.
    """
    book = pick(docs, id=id_col, text=text_col).select("id", measured(F.col("text")).alias("m"))
    return book.select("id", "m.*", failures("m").alias("failed"))


def accepted(docs: DataFrame, policy: Policy, text_col: str = "text") -> DataFrame:
    """The rows whose text the policy accepts, all columns unchanged."""
    boxed = docs.select(F.struct("*").alias("row"), measured(docs[f"`{text_col}`"]).alias("m"))
    return boxed.select("row", failures("m").alias("failed")).where(~rejected_by(policy)).select("row.*")


def rejected_by(policy: Policy, failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(policy.mask).cast("long")) != 0


def apply_policy(book: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with the policy's verdict and name."""
    return book.withColumn("kept", ~rejected_by(policy)) \
        .withColumn("policy", F.lit(f"{policy.name}/{policy.version}"))


def ablations(book: DataFrame, policies: list[Policy]) -> DataFrame:
    """Per policy and rule: texts that fail the rule, and texts that only this rule rejects.

    The ledger is first counted by distinct bitmask; the rest works on those few rows.
    """
    masks = book.groupBy("failed").agg(F.count("*").alias("texts"))
    rows = [F.struct(F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(r).alias("rule"),
                     F.lit(BITS[r]).cast("long").alias("bit"), F.lit(p.mask).cast("long").alias("mask"))
            for p in policies for r in p.rules]
    each = masks.select("failed", "texts", F.explode(F.array(*rows)).alias("x")).select("failed", "texts", "x.*")
    hit = F.col("failed").bitwiseAND(F.col("mask"))
    return each.groupBy("policy", "version", "rule").agg(
        F.sum(F.when(F.col("failed").bitwiseAND(F.col("bit")) != 0, F.col("texts")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(hit == F.col("bit"), F.col("texts")).otherwise(0)).alias("n_only_this"),
        F.sum("texts").alias("n_texts"))
