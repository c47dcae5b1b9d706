"""Near-duplicate embeddings by an inverted multi-index.

Unit vectors are cut into halves; each half has its own codebook, and the pairs of
codewords form the grid of cells.  A vector is stored in the cell of its two nearest
codewords.  As a query it walks the grid in the order of summed half distances (the
multi-sequence order) as far as the target recall asks for, and its cosines with
what the cells hold are then computed in double precision.  Of two vectors the one
in the lower cell does the walk, so each pair is met once.

How far to walk is set once, on the sample the codebooks are fitted on: vectors are
turned away by exactly the angle of the threshold in random directions (the
hardest pairs that count), and the walk must reach the cell of the turned vector in
``recall`` of the cases.

Equal vectors are one row with a count.  A cell with many vectors is split into
chunks of ``CHUNK`` stored vectors; a query visits each chunk in a task of its own.  A
task gives counts and a spanning forest of its links, never the pairs.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.llm.common import cut, pick
from tablewatch.llm.components import connected

SAMPLE = 16384          # vectors the codebooks are fitted on, about
CHUNK = 4096            # stored vectors of a cell that one task holds
PER_CELL = 1024         # stored vectors of a cell aimed at, over all labels


# ------------------------------------------------------------------ codebooks

def kmeans(rows: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)]
    for _ in range(rounds):
        near = distances(rows, centres).argmin(1)
        for c in range(len(centres)):
            mine = rows[near == c]
            centres[c] = mine.mean(0) if len(mine) else rows[rng.integers(len(rows))]
    return centres


def distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances."""
    return np.maximum((rows ** 2).sum(1)[:, None] - 2 * rows @ centres.T + (centres ** 2).sum(1), 0)


def halves(unit: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    padded = np.zeros((len(unit), width))
    padded[:, :min(width, unit.shape[1])] = unit[:, :width]
    return padded[:, :width // 2], padded[:, width // 2:]


def walk_order(d1: np.ndarray, d2: np.ndarray, reach: float) -> list[int]:
    """Cells (i * len(d2) + j) by rising d1[i] + d2[j], as far as ``reach`` above the first: the multi-sequence walk."""
    import heapq
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    s1, s2, n2 = d1[o1], d2[o2], len(d2)
    limit = s1[0] + s2[0] + reach
    heap, out, seen = [(s1[0] + s2[0], 0, 0)], [], {(0, 0)}
    while heap:
        total, i, j = heapq.heappop(heap)
        if total > limit:
            break
        out.append(int(o1[i]) * n2 + int(o2[j]))
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(s1) and y < n2 and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (s1[x] + s2[y], x, y))
    return out


class Grid:
    """Codebooks and reach of the walk, fitted on sample vectors."""

    def __init__(self, sample: np.ndarray, width: int, k: int, threshold: float, recall: float, seed: int = 7):
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        self.width = width
        h1, h2 = halves(unit, width)
        self.first, self.second = kmeans(h1, k, seed=seed), kmeans(h2, k, seed=seed + 1)
        rng = np.random.default_rng(seed + 2)
        away = rng.standard_normal(unit.shape)
        away -= (away * unit).sum(1, keepdims=True) * unit
        size = np.linalg.norm(away, axis=1, keepdims=True)
        turned = threshold * unit + np.sqrt(1 - threshold ** 2) * np.divide(away, size, where=size > 0,
                                                                           out=np.zeros_like(away))
        d1, d2 = self.reached(unit)
        c1, c2 = self.reached(turned)
        at = np.arange(len(unit))
        excess = d1[at, c1.argmin(1)] - d1.min(1) + d2[at, c2.argmin(1)] - d2.min(1)
        self.reach = float(np.quantile(excess, recall)) + 1e-12

    def reached(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h1, h2 = halves(unit, self.width)
        return distances(h1, self.first), distances(h2, self.second)

    def walks(self, unit: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Home cell, and the cells to visit, of each row."""
        d1, d2 = self.reached(unit)
        home = d1.argmin(1) * len(self.second) + d2.argmin(1)
        near = (d1 - d1.min(1, keepdims=True) <= self.reach).sum(1) * (d2 - d2.min(1, keepdims=True) <= self.reach).sum(1)
        cells = [walk_order(a, b, self.reach) if n > 1 else [h] for a, b, n, h in zip(d1, d2, near, home.tolist())]
        return home, cells


# --------------------------------------------------------------------- compare

def _matrix(column) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64)


def _padded(column, width: int) -> np.ndarray:
    """Rows of an Arrow list column, filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    rows = np.zeros((len(column), width))
    rows[np.arange(width)[None, :] < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return rows


def _pointers(hit: np.ndarray) -> np.ndarray:
    """Labels of the components of a queries x stored hit matrix; queries first, then stored."""
    q, m = hit.shape
    label = np.arange(q + m)
    while True:
        low_q = np.where(hit, label[q:][None, :], q + m).min(1, initial=q + m)
        new_q = np.minimum(label[:q], low_q)
        new_m = np.minimum(label[q:], np.where(hit, new_q[:, None], q + m).min(0, initial=q + m))
        new = np.concatenate([new_q, new_m])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(threshold: float):
    def links(stored, asking):
        """Counts and forest edges between one chunk of stored vectors and some queries."""
        for at in range(0, len(asking["k"]), 512):
            part = {c: v[at:at + 512] for c, v in asking.items()}
            hit = (part["v"] @ stored["v"].T) / (part["r"][:, None] * stored["r"][None, :]) >= threshold
            home = part["home"]
            if home.any():                      # at home each pair is met from its smaller key
                hit[home] &= part["k"][home][:, None] < stored["k"][None, :]
            rows, cols = np.flatnonzero(hit.any(1)), np.flatnonzero(hit.any(0))
            if not len(rows):
                continue
            hit = hit[np.ix_(rows, cols)]
            keys = np.concatenate([part["k"][rows], stored["k"][cols]])
            gain = np.concatenate([hit @ stored["n"][cols], part["n"][rows] @ hit])
            label = _pointers(hit)
            yield keys, keys[label], gain

    def run(batches):
        import pyarrow as pa
        group, stored, parts = None, None, []
        out = []

        def flush():
            if out:
                a, b, n = (np.concatenate(x) for x in zip(*out))
                out.clear()
                return pa.RecordBatch.from_arrays([pa.array(a.astype(str)), pa.array(b.astype(str)),
                                                   pa.array(n.astype(np.int64))], ["a", "b", "n"])

        for b in batches:
            cols = [b.column(c).to_numpy(zero_copy_only=False) for c in ("label", "width", "cell", "chunk")]
            change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], 0)) + 1
            for s, e in zip([0, *change], [*change, b.num_rows]):
                here = tuple(int(c[s]) for c in cols)
                if here != group:
                    group, stored, parts = here, None, []
                x = b.slice(s, e - s)
                v = _matrix(x.column("v"))
                rows = {"v": v, "r": np.linalg.norm(v, axis=1), "k": np.array(x.column("k").to_pylist(), "S"),
                        "n": x.column("n").to_numpy(), "home": x.column("home").to_numpy(zero_copy_only=False).astype(bool)}
                kept = x.column("stored").to_numpy(zero_copy_only=False).astype(bool)
                if kept.any():
                    parts.append({c: r[kept] for c, r in rows.items()})
                    stored = None
                if not kept.all() and parts:
                    if stored is None:
                        stored = {c: np.concatenate([p[c] for p in parts]) for c in rows}
                        parts = [stored]
                    out.extend(links(stored, {c: r[~kept] for c, r in rows.items()}))
            if out:
                yield flush()
    return run


# ---------------------------------------------------------------- the operator

def classes(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Input rows with the key of their vector's class; the key is null where a vector links with nothing."""
    src = pick(vectors, id=id_col, v=vec_col, label=label_col).withColumn("v", F.col("v").cast("array<double>"))
    fine = (F.col("label").isNotNull() & F.col("v").isNotNull()
            & F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
            & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False)))
    key = F.concat(F.hex(F.xxhash64(F.lit(1), "label", "v")), F.lit("-"), F.hex(F.xxhash64(F.lit(2), "label", "v")))
    return src.withColumn("k", F.when(fine, key))


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, recall: float = 0.999, id_col: str = "vec_id",
                    vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept) per input row.

    Only vectors of equal, non-null label and equal length are compared.  Null, zero
    and empty vectors and those with a null or non-finite component link with nothing:
    no links, component of their own.  Copies of a vector link with each other.  A row
    with a null id has a null component unless it is linked to one with an id, and is
    never kept.  Only the three named columns are read; no rows give no rows.
    """
    spark = vectors.sparkSession
    rows = cut(classes(vectors, id_col, vec_col, label_col))
    stock = cut(rows.where("k is not null").groupBy("k").agg(
        F.first("v").alias("v"), F.first("label").cast("long").alias("label"), F.count("*").alias("n"),
        F.min("id").alias("first")).withColumn("width", F.size("v")))
    size = stock.agg(F.count("*").alias("n"), F.max("width").alias("w")).first()
    total, width = size["n"], size["w"] or 0
    if not total:
        return rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"),
                           F.col("id").isNotNull().alias("kept"))
    share = min(1.0, SAMPLE / total)
    drawn = stock.where(F.pmod(F.xxhash64(F.lit(3), "k"), F.lit(1 << 30)) < int(share * (1 << 30))).select("v").toArrow()
    drawn = (drawn if drawn.num_rows else stock.select("v").limit(1).toArrow()).column("v").combine_chunks()
    wide = width + width % 2
    sample = _padded(drawn, wide)
    top = np.abs(sample).max(1, keepdims=True)
    grid = Grid(sample / top, wide, max(8, round((total / PER_CELL) ** 0.5)), threshold, recall)

    def deal(batches):
        import pyarrow as pa
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                x = b.slice(at, 2048)
                unit = _padded(x.column("v"), wide)
                unit /= np.abs(unit).max(1, keepdims=True)
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                home, cells = grid.walks(unit)
                cells = [[h, *(c for c in cs if c > h)] for h, cs in zip(home.tolist(), cells)]
                yield pa.RecordBatch.from_arrays([x.column("k"), pa.array(cells, pa.list_(pa.int64()))], ["k", "cells"])

    dealt = cut(stock.select("k", "v").mapInArrow(deal, "k string, cells array<long>"))
    full = stock.join(dealt, "k").withColumn("v", F.transform("v", lambda x: x / F.array_max(F.transform("v", F.abs))))
    held = dealt.join(stock.select("k", "label", "width"), "k").groupBy("label", "width", F.col("cells")[0].alias("cell")) \
        .agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    asked = full.select("k", "v", "n", "label", "width", F.posexplode("cells").alias("step", "cell"))
    # a cell nobody is stored in drops out of the join; what is stored goes to one chunk, a query to all of them
    met = asked.join(held, ["label", "width", "cell"]).withColumn("home", F.col("step") == 0)
    own = F.pmod(F.xxhash64("k"), F.col("chunks")).cast("int")
    asks = met.withColumn("chunk", F.explode(F.expr("sequence(0, chunks - 1)"))).withColumn("stored", F.lit(False))
    keeps = met.where("home").withColumn("chunk", own).withColumn("stored", F.lit(True))
    cols = ["label", "width", "cell", "chunk", "stored", "home", "k", "n", "v"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lined = keeps.select(cols).unionByName(asks.select(cols)).repartition(parts, "label", "width", "cell", "chunk") \
        .sortWithinPartitions("label", "width", "cell", "chunk", F.col("stored").desc(), "k")
    found = cut(lined.mapInArrow(_compare(threshold), "a string, b string, n long"))
    links = found.groupBy(F.col("a").alias("k")).agg(F.sum("n").alias("links"))
    comps = connected(found.select("a", "b"))
    named = stock.select("k", "n", "first").join(links, "k", "left").join(comps.withColumnRenamed("node", "k"), "k", "left") \
        .select("k", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "first",
                F.coalesce("component", "k").alias("component"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = named.join(least, "component").select("k", "n_links", "component_id")
    alone = rows.where("k is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    done = rows.where("k is not null").select("id", "k").join(named, "k").select("id", "n_links", "component_id").unionByName(alone)
    return done.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))
