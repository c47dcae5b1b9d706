"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints are made once per text; equal ones are one row from then on.  Two
fingerprints within ``radius`` bits agree on at least ``blocks - radius`` of
``blocks`` bit blocks, so each is dealt to one bucket per choice of agreeing
blocks.  Inside a bucket the fingerprints are stored as vertical bit planes (one
machine word holds one bit of 64 rows); distances to all rows of the block grow
together in carry-save counters, and a block is left as soon as every distance in
it has passed the radius.  A bucket of more than ``BLOCK`` rows is split into chunks
and compared chunk pair by chunk pair, each a task of its own.  A block gives the
edges of a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.llm.common import cut, pick, slices, text_bytes
from tablewatch.llm.components import connected

BLOCK = 2048
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of the ``shingle``-word shingles (XXH64, seed 42) of a UTF-8 text."""
    import xxhash
    words = text.lower().split()
    if not words:
        return 0
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    line = b" ".join(words)
    k = min(shingle, len(words))
    last = ends[k - 1:].tolist()
    first = [0, *(ends[:len(words) - k] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    counts, total = np.zeros(64, np.int64), len(last)
    for at in range(0, total, 65536):
        h = np.array([digest(line[i:j], 42) for i, j in zip(first[at:at + 65536], last[at:at + 65536])], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp) per row; fp holds the 64 bits as a signed long.  A null text is an empty one: fingerprint 0."""
    def run(batches):
        import pyarrow as pa
        for b in slices(batches):
            fps = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])
    src = pick(docs, id=id_col, text=text_col).select("id", text_bytes().alias("text"))
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, fp long")


# ------------------------------------------------------------------ the kernel

def bit_planes(fps: np.ndarray) -> np.ndarray:
    """(64, words): plane p holds bit p of every fingerprint, 64 rows a word; the rows must fill whole words."""
    bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def bit_masks(fps: np.ndarray) -> np.ndarray:
    """(64, rows): all ones where the row's bit is set, else zero."""
    bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T.astype(np.uint64)
    return np.uint64(0) - bits


def within(planes, masks, over: np.ndarray, radius: int) -> np.ndarray:
    """Words whose bits say which rows lie within ``radius`` of each query.

    ``planes[p]`` and ``masks[p]`` broadcast to the shape of ``over``, whose set bits
    are rows not to be compared.  Counters start so that they overflow at radius + 1.
    """
    width = max(1, radius.bit_length())
    start = (1 << width) - 1 - radius
    counters = [np.full(over.shape, _ALL if start >> i & 1 else np.uint64(0)) for i in range(width)]
    over = over.copy()
    for p in range(0, 64, 2):
        one, two = planes[p] ^ masks[p], planes[p + 1] ^ masks[p + 1]
        half = counters[0] ^ one                       # carry-save: two planes and the ones give one carry
        carry = (counters[0] & one) | (half & two)
        counters[0] = half ^ two
        for i in range(1, width):
            counters[i], carry = counters[i] ^ carry, counters[i] & carry
        over |= carry
        if p % 8 == 6 and over.min() == _ALL:          # every distance is past the radius
            break
    return ~over


def _positions(words: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little"))


def large_block(fps: np.ndarray, radius: int) -> np.ndarray:
    """Labels of the link components of one block of distinct fingerprints."""
    n = len(fps)
    padded = np.concatenate([fps, np.zeros(-n % 64, np.uint64)])
    planes, masks, label = bit_planes(padded), bit_masks(padded), np.arange(n)
    words = len(padded) // 64
    blocked = np.zeros(words, np.uint64)
    if n % 64:
        blocked[-1] = _ALL << np.uint64(n % 64)
    for at in range(0, n, 64):                         # 64 queries against the rows from their word on
        first = at // 64
        over = np.broadcast_to(blocked[first:], (64, words - first))
        near = within(planes[:, None, first:], masks[:, at:at + 64, None], over, radius)
        for i in np.flatnonzero(np.bitwise_count(near).sum(1) > 1):
            if at + i < n:
                roots = np.unique(label[at + _positions(near[i])])
                if len(roots) > 1:
                    label[np.isin(label, roots[1:])] = roots[0]
    return label


def small_blocks(fps: np.ndarray, sizes: list[int], radius: int):
    """Edges (i, j) of spanning forests of many blocks of at most 64 rows, 64 words of rows at a time."""
    tiles, at, tile, used = [], 0, [], 0
    for n in sizes:
        if used + n > 64:
            tiles.append(tile)
            tile, used = [], 0
        tile.append((at, n))
        at, used = at + n, used + n
    tiles.append(tile)
    for lot in range(0, len(tiles), 64):
        some = tiles[lot:lot + 64]
        where = np.full((len(some), 64), -1)
        over = np.full((len(some), 64), _ALL)
        for t, blocks in enumerate(some):
            put = 0
            for start, n in blocks:
                where[t, put:put + n] = np.arange(start, start + n)
                own = ((1 << n) - 1) << put
                for i in range(n):                     # later rows of the own block only
                    over[t, put + i] = ~np.uint64(own & ~((2 << (put + i)) - 1))
                put += n
        rows = np.where(where < 0, np.uint64(0), fps[where])
        planes = np.stack([bit_planes(r)[:, 0] for r in rows], 1)[:, :, None]
        masks = bit_masks(rows.reshape(-1)).reshape(64, len(some), 64)
        near = within(planes, masks, over, radius)
        for t in np.flatnonzero(near.any(1)):
            root = list(range(64))

            def find(i):
                while root[i] != i:
                    root[i] = root[root[i]]
                    i = root[i]
                return i
            for i in np.flatnonzero(near[t]):
                for j in _positions(near[t, i:i + 1]):
                    a, b = find(int(i)), find(int(j))
                    if a != b:
                        root[max(a, b)] = min(a, b)
                        yield where[t, a], where[t, b]


def _compare(radius: int):
    def edges_of(fps, starts, stops):
        out = []
        small = [(s, e) for s, e in zip(starts, stops) if 1 < e - s <= 64]
        if small:
            rows = np.concatenate([fps[s:e] for s, e in small])
            out += [(rows[i], rows[j]) for i, j in small_blocks(rows, [e - s for s, e in small], radius)]
        for s, e in zip(starts, stops):
            if e - s > 64:
                label = large_block(fps[s:e], radius)
                moved = np.flatnonzero(label != np.arange(e - s))
                out += zip(fps[s:e][label[moved]], fps[s:e][moved])
        return np.array(out, np.uint64).reshape(-1, 2).view(np.int64)

    def run(batches):
        import pyarrow as pa
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            group = np.stack([held.column(c).to_numpy() for c in ("bucket", "p", "q")])
            stops = np.flatnonzero((group[:, 1:] != group[:, :-1]).any(0)) + 1
            if len(stops):                             # the last block may go on in the next batch
                fps = held.column("fp").to_numpy().view(np.uint64)
                found = edges_of(fps, [0, *stops[:-1].tolist()], stops.tolist())
                held = held.slice(int(stops[-1]))
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])
        if held is not None and held.num_rows:
            fps = held.column("fp").to_numpy().view(np.uint64)
            found = edges_of(np.ascontiguousarray(fps), [0], [len(fps)])
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])
    return run


# ---------------------------------------------------------------- the operator

def buckets(fps: DataFrame, radius: int, blocks: int) -> DataFrame:
    """(bucket, fp): one row per choice of ``blocks - radius`` agreeing bit blocks."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    keys = []
    for table, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << edges[i + 1]) - (1 << edges[i])) for i in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.xxhash64(F.lit(table), F.col("fp").bitwiseAND(F.lit(signed))))
    return fps.select(F.explode(F.array(*keys)).alias("bucket"), "fp")


def links(fps: DataFrame, radius: int = 3, blocks: int = 5) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that give the same components as all links would.

    Buckets are told apart by a 64-bit hash; should two share one, their rows are
    merely compared as well.
    """
    dealt = buckets(fps, radius, blocks)
    full = (dealt.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
            .select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("chunks")))
    own = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("chunks")).cast("int")
    rows = (dealt.join(full, "bucket").withColumn("own", own)
            .withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
            .select("bucket", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "fp"))
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(parts, "bucket", "p", "q").sortWithinPartitions("bucket", "p", "q", "fp")
            .mapInArrow(_compare(radius), "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = 3, blocks: int = 5) -> DataFrame:
    """(id, fp, component_id) per input row; component_id is the smallest id reachable over links.

    Null or empty texts have fingerprint 0 and link like any other; a null id never
    becomes a component's id unless the component has no other (then it is null).
    Repeated rows are one fingerprint and each keep their own result row.  Only the id
    and text columns are read.  An empty table gives an empty result.
    """
    marks = cut(fingerprints(docs, id_col, text_col, shingle))
    classes = cut(marks.groupBy("fp").agg(F.min("id").alias("first")))
    found = connected(links(classes.select("fp"), radius, blocks))
    rooted = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "first", F.coalesce("component", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return marks.join(named, "fp").select("id", "fp", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The input rows with one row of each group of near-duplicates: its smallest id (null first), then text digest.

    Rows that share id and text are one row in the result.  All columns stay.
    """
    text, key = F.coalesce(docs[f"`{text_col}`"], F.lit("")), docs[f"`{id_col}`"]
    place = F.struct(key.alias("id"), F.xxhash64(text).alias("th"))
    found = near_duplicates(docs.select(place.alias("id"), text.alias("text")), "id", "text", **options)

    def name(at):
        return F.concat_ws(":", F.coalesce(at["id"].cast("string"), F.lit("null")), at["th"].cast("string"))
    stay = found.where("id = component_id").select(name(F.col("id")).alias("place"))
    boxed = docs.select(F.struct("*").alias("row"), name(place).alias("place"))
    return boxed.join(stay, "place", "left_semi").dropDuplicates(["place"]).select("row.*")


def hex16(column: str):
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))
