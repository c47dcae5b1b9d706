"""Best-fit packing by large-item matching.

Documents become token counts; what follows needs lengths only.  The plan is made
from the number of pieces of each length (at most ``capacity`` numbers, whatever the
corpus size): pieces above a third of the capacity are matched greedily, the longest
with the longest that still fits, at most two a bin; shorter ones go, longest first,
into the smallest gap that holds them.  The plan is a table of bin shapes with
counts.  Pieces get their place by rank within their length: each task numbers its
own pieces per length, the tasks' counts are summed up, and the rank looks up the
shape, bin and offset.  No task sees more than its own pieces.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, insort

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewatch.llm.bpe import byte_letters
from tablewatch.llm.common import cut, pick, slices, worker_state

CACHE_WORDS = 300_000           # words kept per Python worker; beyond it the cache starts anew
LATIN = "\u0250"                # letters below are the same in every Unicode version
# Fixed value: the pattern of byte-level tokenizer files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# ------------------------------------------------------------------- tokenizing

class Tokens:
    """Ids of whole texts with a byte-level tokenizer file, as little-endian 32-bit words.

    A match of the tokenizer's pattern never goes on past a space that has a visible
    character behind it, so a text is cut there and each distinct part encoded once.
    Parts of Latin letters are merged by rank, which the file's ids are; other parts, texts
    where a space meets other white space, and texts with a special token go through
    the tokenizer itself.
    """

    def __init__(self, path: str):
        import json
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.parts: dict[str, bytes] = {}              # what follows a space -> ids, the space included
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, raw = model["vocab"], {c: b for b, c in byte_letters().items()}
        steps = [vocab["".join(m if not isinstance(m, str) else m.split(" "))] for m in model["merges"]]
        self.merge = None
        if steps == sorted(steps) and len(vocab) == 256 + len(steps):
            ranks = {bytes(map(raw.__getitem__, t)): i for t, i in vocab.items()}
            self.merge = tiktoken.Encoding("parts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _part(self, part: str) -> bytes:
        if self.merge is not None and max(part) < LATIN:
            ids = self.merge(part)
            return struct.pack(f"<{len(ids)}I", *ids)
        return self._ids([part])[0]

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self._ids([text])[0]
        if len(self.parts) > CACHE_WORDS:
            self.parts.clear()
        first, *parts = text.split(" ")
        new = set(parts).difference(self.parts)
        if any(not p or p[0].isspace() for p in new):
            return self._ids([text])[0]
        for p in new:
            self.parts[p] = self._part(" " + p)
        return (self._part(first) if first else b"") + b"".join(map(self.parts.__getitem__, parts))


def tokens(path: str) -> Tokens:
    kept = worker_state().setdefault("tokens", {})
    if path not in kept:
        kept[path] = Tokens(path)
    return kept[path]


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: one, or full pieces after a first one that may be shorter."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    starts = ([0] if first else []) + list(range(first, n, capacity))
    return list(zip(starts, [b - a for a, b in zip(starts, [*starts[1:], n])]))


def pieces(docs: DataFrame, path: str, capacity: int = 2048, end: int = 0, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, and its task and number among that task's pieces of its length."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        tok, part, seen = tokens(path), TaskContext.get().partitionId(), {}
        stop = np.array([end], "<u4").tobytes()
        for b in slices(batches):
            rows = []
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = memoryview(tok.encode(text or "") + stop)
                for k, (start, length) in enumerate(cuts(len(ids) // 4, capacity)):
                    at = seen[length] = seen.get(length, -1) + 1
                    rows.append((key, k, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), part, at))
            cols = list(zip(*rows))
            kinds = [b.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             ["id", "piece", "start", "length", "ids_crc32", "part", "nth"])
    src = pick(docs, id=id_col, text=text_col)
    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long, part int, nth long")


# --------------------------------------------------------------------- the plan

def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Bin shapes as (number of bins, ((length, times), ...)) that hold the pieces of a length histogram."""
    left = {n: c for n, c in histogram.items() if c > 0}
    gaps: dict[int, list] = {}                 # gap -> groups [bins, shape]
    order: list[int] = []                      # the gaps there are, ascending

    def add(gap, bins, shape):
        if bins:
            if gap not in gaps:
                gaps[gap] = []
                insort(order, gap)
            gaps[gap].append((bins, shape))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:                               # the longest, with the longest that still fits
        n = large[-1]
        fits = bisect_left(large, capacity - n + 1)
        if not fits:
            add(capacity - n, left[n], ((n, 1),))
            left[large.pop()] = 0
            continue
        m = large[fits - 1]
        bins = left[n] // 2 if m == n else min(left[n], left[m])
        if bins:
            add(capacity - n - m, bins, ((n, 2),) if m == n else ((n, 1), (m, 1)))
            left[n] -= bins
            left[m] -= bins
        if m == n and left[n] == 1:            # an odd one: its partner is the next shorter, if any
            if fits > 1:
                m = large[fits - 2]
                add(capacity - n - m, 1, ((n, 1), (m, 1)))
                left[m] -= 1
            else:
                add(capacity - n, 1, ((n, 1),))
            left[n] = 0
        large = [x for x in large if left[x]]
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        count = left[n]
        while count:
            at = bisect_left(order, n)
            if at == len(order):               # no gap holds it: new bins
                each = capacity // n
                add(capacity - each * n, count // each, ((n, each),))
                add(capacity - count % each * n, int(count % each > 0), ((n, count % each),))
                break
            gap = order[at]
            each = gap // n                    # best fit goes on in the bin it has begun
            bins, shape = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                order.pop(at)
            full = min(bins, count // each)
            rest = count % each if full < bins and count // each <= full else 0
            add(gap - each * n, full, (*shape, (n, each)))
            add(gap - rest * n, int(rest > 0), (*shape, (n, rest)))
            add(gap, bins - full - (rest > 0), shape)
            count -= full * each + rest
    return [group for gap in order for group in gaps[gap]]


def places(shapes) -> dict[int, np.ndarray]:
    """Per length: rows (first rank, first sequence, times in a bin, offset), ascending by rank."""
    out: dict[int, list] = {}
    base = 0
    rank: dict[int, int] = {}
    for bins, shape in shapes:
        at = 0
        for n, times in shape:
            first = rank.get(n, 0)
            out.setdefault(n, []).append((first, base, times, at))
            rank[n] = first + bins * times
            at += n * times
        base += bins
    return {n: np.array(rows, np.int64) for n, rows in out.items()}


def pack(found: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` with sequence_id and offset.  The plan holds a few rows per length, so it goes along with the tasks."""
    kind = found.schema["id"].dataType.simpleString()
    counts = found.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = cut(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))
    histogram = {r["length"]: r["n"] for r in offsets.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = places(plan(histogram, capacity))

    def run(batches):
        import pyarrow as pa
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            seq, off = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for n in np.unique(length):
                mine = np.flatnonzero(length == n)
                rows = table[int(n)]
                row = rows[np.searchsorted(rows[:, 0], rank[mine], "right") - 1]
                k = rank[mine] - row[:, 0]
                seq[mine], off[mine] = row[:, 1] + k // row[:, 2], row[:, 3] + k % row[:, 2] * n
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("id", "piece", "start", "length", "ids_crc32")),
                                              pa.array(seq), pa.array(off)],
                                             ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    ranked = found.join(offsets.select("part", "length", "before"), ["part", "length"]).select(
        "id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"))
    return ranked.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long, "
                                  "sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, end: int = 0, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Pieces of all documents with their place: id, piece, start, length, ids_crc32, sequence_id, offset.

    ``path`` names the tokenizer file on the executors; every document ends with the
    id ``end``.  A null text is an empty one (the end id alone).  Null ids and repeated
    rows are documents like any other; other columns are not read.  No documents, no pieces.
    """
    return pack(cut(pieces(docs, path, capacity, end, id_col, text_col)), capacity)
