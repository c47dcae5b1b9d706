"""Vector code compression: product codes from a member-resident Lloyd iteration.

Vectors become whole numbers and are cut into equal consecutive parts.  Every part is a
row that lives with its owner: the rows are partitioned by (position, entry, salt), where
the salt spreads an entry that holds many members over several owners.  A round lets
owners sum the members that reside with them (partial sums of one row an owner and entry
are all that is shuffled for that), and then gives each member its nearest entry anew:
members that keep theirs are written where they are, only those that change it go through
the next shuffle.  Generations are written below the session's shared folder, so that a
lost executor costs its own tasks only.

What every task gets is the codebooks: ``entries`` vectors, whatever the number of rows.
All sums are whole numbers, so results don't depend on the order of rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewatch.llm.common import pick, shared_path

SCALE = 256                     # steps of a component's unit
LIMIT = 1 << 24                 # whole components beyond this are set to it, so that sums stay in 64 bits
OWNED = 1 << 16                 # members that an owner has on average, at most
SALTS = 16                      # shares of a label in the join with its total


def whole(vector: Column, scale: int = SCALE, limit: int = LIMIT) -> Column:
    """floor(scale * x) of every component; null where the vector or a component is null or not finite."""
    fine = vector.isNotNull() & (F.size(vector) > 0) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(fine, F.transform(vector, lambda x: F.floor(F.greatest(F.least(
        x.cast("double") * scale, F.lit(float(limit))), F.lit(float(-limit)))).cast("int")))


def nearest(books: np.ndarray, place: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of the nearest entry of each part's codebook; ties go to the lower index."""
    entry, error = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    for p in np.unique(place):
        rows = np.flatnonzero(place == p)
        for at in range(0, len(rows), 4096):
            few = rows[at:at + 4096]
            dist = np.zeros((len(few), books.shape[1]), np.int64)
            for j in range(books.shape[2]):
                dist += (parts[few, j, None] - books[p, None, :, j]) ** 2
            entry[few] = dist.argmin(1)
            error[few] = dist[np.arange(len(few)), entry[few]]
    return entry, error


def _search(books: np.ndarray):
    """Column function (position, part) -> (entry, error) under the given codebooks."""
    width = books.shape[2]

    @F.pandas_udf("entry long, error long")
    def search(place: pd.Series, part: pd.Series) -> pd.DataFrame:
        flat = np.concatenate(part.to_numpy()).reshape(-1, width).astype(np.int64) if len(part) else np.zeros((0, width), np.int64)
        entry, error = nearest(books, place.to_numpy().astype(np.int64), flat)
        return pd.DataFrame({"entry": entry, "error": error})
    return search


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _start(kept: DataFrame, parts: int, entries: int) -> tuple[int, np.ndarray]:
    """Components of a vector and the first codebooks: the parts of the rows with the smallest ids."""
    def least(rows, n):
        return [r["x"] for r in rows.orderBy(F.col("id").asc_nulls_last(), "x").limit(n).select("x").collect()]
    first = least(kept, entries)
    if not first:
        return 0, np.zeros((parts, 0, 1), np.int64)
    size = len(first[0])
    if any(len(x) != size for x in first):
        first = least(kept.where(F.size("x") == size), entries)
    width = -(-size // parts)
    grid = np.zeros((len(first), parts * width), np.int64)
    grid[:, :size] = first
    return size, np.ascontiguousarray(grid.reshape(len(first), parts, width).transpose(1, 0, 2))


def _updated(residents: DataFrame, books: np.ndarray, salts: int) -> np.ndarray:
    """Codebooks with every entry the floor of its members' mean; entries without members stay."""
    parts, entries, width = books.shape
    cell = F.expr(f"cast(slot div {salts} as long)")
    sums = residents.groupBy(cell.alias("cell")).agg(F.count("*").alias("n"), *[F.sum(F.col("part")[j]).alias(f"s{j}") for j in range(width)])
    new = books.copy()
    for r in sums.collect():                            # at most parts * entries rows
        new[r["cell"] // entries, r["cell"] % entries] = [r[f"s{j}"] // r["n"] for j in range(width)]
    return new


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal: by part, entry and position within the part, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, id_col: str = "vec_id",
             vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """(id, label, code, error, label_error) per row, and the codebooks (parts, entries, components).

    ``code`` has two lower-case hex digits a part.  Rows whose vector is null, empty or holds null or non-finite
    components get no row, nor do vectors of another length than that of the smallest id (null ids are the largest;
    equal ids go by their components).  Where the length is no multiple of ``parts``, zeros fill it up; fewer rows than
    ``entries`` make smaller codebooks.  Components are floor(256 x), set to +-2^24 beyond it.  Repeated rows and null
    ids keep rows of their own; null labels are one label; other columns are not read; an empty table gives none.
    """
    if entries > 256:
        raise ValueError("an entry has two hex digits")
    spark = vectors.sparkSession
    src = pick(vectors, id=id_col, label=label_col, vector=vector_col)
    kinds = {c: src.schema[c].dataType for c in ("id", "label")}
    kept = src.select("id", "label", whole(F.col("vector")).alias("x")).where("x is not null")
    size, books = _start(kept, parts, entries)
    if not size:
        none = kept.where("false").select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                                          F.lit(0).cast("long").alias("label_error"))
        return none, books
    kept = kept.where(F.size("x") == size)
    tasks, cells = int(spark.conf.get("spark.sql.shuffle.partitions")), parts * books.shape[1]
    salts = max(1, -(-kept.count() * parts // (OWNED * cells)), -(-4 * tasks // cells))
    width = books.shape[2]
    filled = F.concat("x", F.array_repeat(F.lit(0), parts * width - size))
    cut = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.slice(filled, p * width + 1, width))
    rows = kept.withColumn("uid", F.monotonically_increasing_id()).select("uid", "id", "label", F.posexplode(cut).alias("place", "part"))
    first = F.col("place") == 0                         # id and label travel with the first part alone
    rows = rows.select("uid", F.when(first, F.col("id")).alias("id"), F.when(first, F.col("label")).alias("label"), "place", "part")

    def slot(entry: Column) -> Column:
        return (F.col("place") * books.shape[1] + entry) * salts + F.pmod(F.xxhash64("uid"), F.lit(salts))
    names = ["uid", "id", "label", "place", "part", "slot"]
    placed = rows.withColumn("slot", slot(_search(books)("place", "part")["entry"]))
    residents = _stored(placed.repartition(tasks, "slot").sortWithinPartitions("slot"), "codes-0")
    for turn in range(1, rounds + 1):
        books = _updated(residents, books, salts)
        if turn == rounds:
            break
        search = _search(books)
        to = residents.withColumn("to", slot(search("place", "part")["entry"]))
        stay = to.where("to = slot").select(*names)
        moved = to.where("to <> slot").select("uid", "id", "label", "place", "part", F.col("to").alias("slot"))
        residents = _stored(stay.unionByName(moved.repartition(tasks, "slot").sortWithinPartitions("slot")), f"codes-{turn}")
    last = residents.select("uid", "id", "label", "place", _search(books)("place", "part").alias("f"))
    words = -(-parts // 8)
    packed = [F.bit_or(F.when(F.floor(F.col("place") / 8) == w, F.expr(f"shiftleft(f.entry, cast(8 * ({8 * w + 7} - place) as int))"))
                       .otherwise(F.lit(0).cast("long"))).alias(f"w{w}") for w in range(words)]
    codes = last.groupBy("uid").agg(F.max("id").alias("id"), F.max("label").alias("label"), F.sum("f.error").alias("error"), *packed)
    text = F.concat(*[F.lpad(F.lower(F.hex(f"w{w}")), 16, "0") for w in range(words)])
    codes = _stored(codes.select("uid", "id", "label", F.substring(text, 1, 2 * parts).alias("code"), "error"), "codes")
    totals = codes.groupBy("label").agg(F.sum("error").alias("label_error"))
    shares = totals.select(F.col("label").alias("of"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("share"))
    joined = codes.withColumn("part", F.pmod(F.xxhash64("uid"), F.lit(SALTS)).cast("int")) \
        .join(shares, F.col("label").eqNullSafe(F.col("of")) & (F.col("part") == F.col("share")))
    out = joined.select(F.col("id").cast(kinds["id"]).alias("id"), F.col("label").cast(kinds["label"]).alias("label"),
                        "code", "error", "label_error")
    return out, books
