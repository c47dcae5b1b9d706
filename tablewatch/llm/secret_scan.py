"""Secret scan: patterns, and a character model for what patterns do not name.

Two Markov chains over character classes are trained from labelled samples: random
strings (what the patterns found in a sample of texts, and digests made for each
sampled text) and ordinary identifiers (the other long words of those texts).  A
candidate run is a secret when its log-likelihood ratio, for each pair of neighbouring
characters, passes the threshold.
Weights are whole thousandths of a nat, so scores are exact sums.

Everything runs in DataFrame expressions; a text never leaves its row.  The model is
one number per pair of classes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewatch.llm.common import pick

SAMPLE = 4000                   # texts the chains are trained on, about
MIN_RUN = 20                    # characters of a candidate run at least
THRESHOLD = 800                 # thousandths of a nat for each pair of characters
CLASSES = 63                    # a-z, A-Z, 0-9, anything else

# What counts as a secret by its look.  Kind -> (pattern, pattern of a match that stays).
KINDS = {
    "assign": (r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
               r"""^(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12,}$"""),
    "access": (r"AKIA[A-Z0-9]+", r"^.{18,}$"),
    "hex": (r"[0-9a-f]{16,}", r"^.{16,}$"),
}
RUN = r"[A-Za-z0-9+/_=-]{20,}"
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")


def _lit(pattern: str) -> Column:
    return F.lit(pattern)


def spans_of(text: Column, pattern: str, stay: str | None, kind: str, rank: int) -> Column:
    """Matches of a pattern, left to right: array of (start, end, rank, kind, match), in code points."""
    hits = F.regexp_extract_all(text, _lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    both = F.zip_with(hits, F.slice(gaps, F.lit(1), F.size(hits)), lambda h, g: F.struct(h.alias("hit"), g.alias("gap")))
    empty = F.expr("cast(array() as array<struct<start:bigint,end:bigint,rank:int,kind:string,hit:string>>)")
    walked = F.aggregate(
        both, F.struct(F.lit(0).cast("long").alias("at"), empty.alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + F.length(x["hit"])).alias("at"),
            F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + F.length(x["hit"])).alias("end"),
                F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), x["hit"].alias("hit")))).alias("out")),
        lambda acc: acc["out"])
    return F.filter(walked, lambda s: s["hit"].rlike(stay)) if stay else walked


def _maybe(test: Column, spans: Column) -> Column:
    """Spans where a cheap test passes; most texts end there."""
    return F.when(test, spans).otherwise(
        F.expr("cast(array() as array<struct<start:bigint,end:bigint,rank:int,kind:string,hit:string>>)"))


def base_spans(text: Column) -> Column:
    low = F.lower(text)
    named = F.lit(False)
    for w in _WORDS:
        named = named | F.contains(low, F.lit(w))
    tests = {"assign": named, "access": F.contains(text, F.lit("AKIA")), "hex": text.rlike(r"[0-9a-f]{16}")}
    parts = [_maybe(tests[k], spans_of(text, p, stay, k, i)) for i, (k, (p, stay)) in enumerate(KINDS.items())]
    return F.array_sort(F.concat(*parts))


# -------------------------------------------------------------------- the model

def _class(ch: Column) -> Column:
    code = F.ascii(ch)
    return F.when(code.between(97, 122), code - 97).when(code.between(65, 90), code - 39) \
        .when(code.between(48, 57), code + 4).otherwise(CLASSES - 1)


def _drawn(docs: DataFrame, texts: int) -> DataFrame:
    """About ``texts`` rows, chosen by a digest of the text: the same rows whatever the layout."""
    total = docs.count()
    limit = (1 << 24) if total <= texts else int((1 << 24) * texts / total)
    place = F.conv(F.substring(F.md5(F.coalesce("text", F.lit("")).cast("binary")), 1, 6), 16, 10).cast("int")
    return docs.where(place < limit)


def samples(docs: DataFrame, texts: int = SAMPLE) -> DataFrame:
    """(random boolean, token): labelled samples of about ``texts`` texts."""
    t = F.coalesce("text", F.lit(""))
    base = _drawn(docs, texts).select(t.alias("text"), base_spans(t).alias("base"))
    found = base.select(F.explode("base").alias("s")).select(
        F.lit(True).alias("random"), F.regexp_extract("s.hit", r"[A-Za-z0-9+/_.=-]+$", 0).alias("token"))
    made = base.select(F.lit(True).alias("random"), F.explode(F.array(*[
        F.base64(F.unhex(F.sha2(F.concat(F.lit(salt), "text").cast("binary"), 256))) for salt in "abcd"])).alias("token"))
    words = base.where(F.size("base") == 0).select(F.lit(False).alias("random"), F.explode(
        F.regexp_extract_all("text", _lit(r"[A-Za-z][A-Za-z_-]{5,}"), F.lit(0))).alias("token"))
    return found.unionByName(made).unionByName(words)


def train(docs: DataFrame, texts: int = SAMPLE) -> list[int]:
    """Weights: for each pair of classes, ln P(second | first, random) - ln P(second | first, ordinary), in thousandths."""
    tokens = samples(docs, texts).where(F.length("token") > 1).groupBy("random", "token").agg(F.count("*").alias("n"))
    step = tokens.select("random", "token", "n", F.explode(F.expr("sequence(1, length(token) - 1)")).alias("i"))
    pairs = step.groupBy("random", _class(F.expr("substring(token, i, 1)")).alias("a"),
                         _class(F.expr("substring(token, i + 1, 1)")).alias("b")).agg(F.sum("n").alias("n")).collect()
    count = {True: {}, False: {}}
    for r in pairs:
        count[r["random"]][r["a"], r["b"]] = r["n"]
    return weights(count)


def weights(count: dict[bool, dict[tuple[int, int], int]], pseudo: float = 0.5) -> list[int]:
    rows = {k: [sum(c.get((a, b), 0) for b in range(CLASSES)) for a in range(CLASSES)] for k, c in count.items()}

    def log(kind, a, b):
        return math.log((count[kind].get((a, b), 0) + pseudo) / (rows[kind][a] + pseudo * CLASSES))
    return [round(1000 * (log(True, a, b) - log(False, a, b))) for a in range(CLASSES) for b in range(CLASSES)]


def score(token: Column, table: list[int]) -> Column:
    """Log-likelihood ratio of a token, in thousandths of a nat."""
    values = F.expr(f"cast(split('{','.join(map(str, table))}', ',') as array<int>)")
    classes = F.transform(F.split(token, ""), lambda c: _class(c))
    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(token) - 1, F.lit(1))), F.lit(0).cast("long"),
                       lambda acc, i: acc + F.coalesce(F.get(values, F.get(classes, i - 1) * CLASSES + F.get(classes, i)),
                                                       F.lit(0)))


def scan(docs: DataFrame, table: list[int], threshold: int = THRESHOLD, id_col: str | None = "doc_id", text_col: str = "text",
         keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row: id (and the kept columns), base and added: arrays of spans (start, end, rank, kind, hit).

    Spans are in code points, end exclusive, by start and then kind.  Added spans never
    overlap base ones.  A null text is an empty one.  Null ids and repeated rows keep
    their own result row; no other columns are read.
    """
    src = docs.select(*([docs[f"`{id_col}`"].alias("id")] if id_col else []), F.coalesce(docs[f"`{text_col}`"], F.lit("")).alias("text"),
                      *[docs[f"`{c}`"] for c in keep])
    found = src.withColumn("base", base_spans(F.col("text"))).withColumn(
        "runs", _maybe(F.col("text").rlike(RUN), spans_of(F.col("text"), RUN, None, "markov", len(KINDS))))
    clear = F.filter("runs", lambda m: ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    added = F.filter(clear, lambda m: score(m["hit"], table) >= threshold * (F.length(m["hit"]) - 1))
    return found.withColumn("added", F.when(F.size("runs") > 0, added).otherwise(F.col("runs"))).drop("runs")


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def counted(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span replaced by the mark; spans that overlap share one."""
    walked = F.aggregate(
        spans, F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(
                acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mark)))
            .otherwise(acc["out"]).alias("out")),
        lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) > 0, walked).otherwise(text)
