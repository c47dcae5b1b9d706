"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes of a text.  Of every ``WINDOW`` neighbouring word ends
the one with the smallest hash of its last 32 bytes ends a chunk (the last one among
equals), and so do the first that can and the last.  A chunk is the ``MIN_WORDS`` words up to its end;
chunks overlap.  In text without white space an end after which the hash is very
small counts as a word end.  Ends depend on nearby bytes only, and two neighbouring
ones are at most ``WINDOW`` words apart: a passage that holds ``MIN_WORDS + WINDOW - 1``
words after its first 32 bytes holds a chunk wherever it stands, and what lies
between its first and its last chunk is covered without a gap.

A chunk is a repeat when its digest occurs in a document with a smaller id, or
earlier in its own without overlap.  Repeated chunks are removed; those that touch make a run.

Digests are counted with map-side combine (smallest id per digest) and joined back;
a digest that a third of the documents share is one row on its side of the join.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewatch.llm.common import pick, slices, text_bytes

MIN_WORDS = 12                  # words of a chunk
WINDOW = 12                     # word ends of which one ends a chunk; at most MIN_WORDS, so that chunks overlap or touch
WHITE = b" \t\n\v\f\r"
_FREE = 1 << 20                 # of 2^32: ends without white space, about every 4096 bytes


def _gear() -> np.ndarray:
    """256 random 32-bit numbers from a multiplicative generator."""
    x, out = 0x9E3779B97F4A7C15, []
    for _ in range(256):
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append(x >> 32)
    return np.array(out, np.uint32)


def rolling(raw: np.ndarray) -> np.ndarray:
    """Gear hash at every byte: sum of table[byte] << age over the last 32 bytes, by doubling."""
    h, span = _gear()[raw], 1
    while span < 32 and span < len(h):
        older = h[:-span] << np.uint32(span)
        h = np.concatenate([h[:span], h[span:] + older])
        span *= 2
    return h


def laid(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, next) of the chunks of a text: bytes up to ``stop`` make the digest, those up to ``next`` are white space.

    The first chunk's start is 0 and the last one's next the text's length.
    """
    raw = np.frombuffer(text, np.uint8)
    none = np.zeros(0, np.int64)
    if not len(raw):
        return none, none, none
    h = rolling(raw)
    white = (raw == 32) | ((raw >= 9) & (raw <= 13))
    after = np.empty_like(white)                   # no end inside a letter of several bytes
    after[:-1], after[-1] = (raw[1:] & 0xC0) != 0x80, True
    stop = ~white & (np.append(white[1:], True) | (after & (h < _FREE)))
    start = ~white & np.concatenate([[True], white[:-1] | stop[:-1]])
    stops, starts = np.flatnonzero(stop) + 1, np.flatnonzero(start)
    if len(stops) < MIN_WORDS:
        return none, none, none
    key = h[stops[MIN_WORDS - 1:] - 1]
    n, span = len(key), min(WINDOW, len(key))
    least = np.lib.stride_tricks.sliding_window_view(key, span)[:, ::-1].argmin(1)
    at = np.unique(np.concatenate([[0], np.arange(span - 1, n) - least, [n - 1]]))
    following = np.append(starts[1:], len(raw))[at + MIN_WORDS - 1]
    return np.where(at == 0, 0, starts[at]), stops[at + MIN_WORDS - 1], following


def ends(text: bytes) -> np.ndarray:
    """Ends of the chunks of a text with the white space after them, the last one its length."""
    following = laid(text)[2]
    return following if len(following) or not text else np.array([len(text)])


def own(text: str):
    """32 bits of a text's digest: tells apart texts that share an id."""
    return F.hash(F.coalesce(F.col(text), F.lit("")))


def chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, start, size, digest, again) per chunk; offsets in bytes, th as of ``own``."""
    def run(batches):
        import pyarrow as pa
        import xxhash
        digest = xxhash.xxh3_64_intdigest
        for b in slices(batches):
            cols = [[] for _ in range(5)]
            for row, text in enumerate(b.column(2).to_pylist()):
                starts, stops, following = laid(text)
                n = len(stops)
                lead = len(text) - len(text.lstrip(WHITE))
                marks = np.array([digest(text[max(i, lead):j]) for i, j in zip(starts.tolist(), stops.tolist())], np.uint64).view(np.int64)
                first, back = np.unique(marks, return_index=True, return_inverse=True)[1:]
                for c, v in zip(cols, (np.full(n, row), starts, following - starts, marks, starts >= stops[first[back]])):
                    c.append(v)
            rows, *rest = (np.concatenate(c) for c in cols)
            rows = pa.array(rows.astype(np.int64))
            kinds = (np.int32, np.int32, np.int64, bool)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(rows), b.column(1).take(rows), *(pa.array(v.astype(k)) for v, k in zip(rest, kinds))],
                ["id", "th", "start", "size", "digest", "again"])
    src = pick(docs, id=id_col, text=text_col).select("id", own("text").alias("th"), text_bytes().alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, th int, start int, size int, digest long, again boolean")


def repeated(found: DataFrame) -> DataFrame:
    """Repeated chunks with the smallest id that has them (``source``).

    The smallest ids are already dealt by digest, so the join moves the chunks once.
    """
    first = found.groupBy("digest").agg(F.min("id").alias("source"))
    return found.join(first, "digest").where("again or source < id or (id is null and source is not null)")


def runs(marked: DataFrame) -> DataFrame:
    """(id, th, start, stop, sources) of the runs to remove."""
    # rows that share id and text give the same chunks: one of each is enough
    one = marked.groupBy("id", "th", "start").agg(*[F.first(c).alias(c) for c in ("size", "source")])
    order = W.partitionBy("id", "th").orderBy("start")
    stop = F.col("start") + F.col("size")
    before = F.max(stop).over(order.rowsBetween(W.unboundedPreceding, -1))
    island = one.withColumn("fresh", F.coalesce(before < F.col("start"), F.lit(True)).cast("int")).withColumn("run", F.sum("fresh").over(order))
    return island.groupBy("id", "th", "run").agg(
        F.min("start").alias("start"), F.max(stop).alias("stop"), F.array_sort(F.collect_set("source")).alias("sources"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, repeats, n_removed_words, sources, spans, text) per input row.

    ``text`` is what stays; ``spans`` are the removed byte ranges as start:stop, comma-joined;
    ``sources`` are the ids whose earlier chunks they repeat; ``repeats`` says whether there are any.
    A null text is an empty one and stays null.  Documents with a null id come after all
    others.  Rows that share an id are one document: they are no repeats of each other.
    Only the two columns are read; an empty table gives an empty result.
    """
    found = runs(repeated(chunks(docs, id_col, text_col)))
    per = found.groupBy("id", "th").agg(
        F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("sources")))).alias("sources")) \
        .select(F.col("id").alias("_id"), F.col("th").alias("_th"), "spans", "sources")
    keyed = pick(docs, id=id_col, text=text_col).withColumn("th", own("text"))
    kind = keyed.schema["id"].dataType.simpleString()
    both = keyed.join(per.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left")
    raw = F.col("text").cast("binary")
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform("spans", lambda s: s["stop"]))
    stops = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.octet_length("text").cast("long")))
    left = F.array_join(F.transform(F.arrays_zip(starts.alias("a"), stops.alias("b")), lambda x: F.substring(
        raw, (x["a"] + 1).cast("int"), (x["b"] - x["a"]).cast("int")).cast("string")), "")
    words = F.aggregate("spans", F.lit(0), lambda n, x: n + F.regexp_count(F.substring(
        raw, x["start"] + 1, x["stop"] - x["start"]).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")))
    none = F.expr(f"cast(array() as array<{kind}>)")
    return both.select(
        "id", F.col("spans").isNotNull().alias("repeats"), F.coalesce(words, F.lit(0)).cast("long").alias("n_removed_words"),
        F.coalesce("sources", none).alias("sources"),
        F.coalesce(F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["stop"].cast("string"))), ","),
                   F.lit("")).alias("spans"),
        F.when(F.col("spans").isNull(), F.col("text")).otherwise(left).alias("text"))
