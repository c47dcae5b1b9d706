"""Language identification by Bayesian evidence fusion.

Evidence about a page: its visible text, the language its markup declares, the last
label of its address's host, and what is known of its host.  The text's likelihood
comes from byte trigrams counted in a bounded sample of labelled documents.  How
far declarations and suffixes can be trusted, and what hosts publish, is counted over
all pages by grouped aggregation of the texts' posteriors: hosts are smoothed towards
their domain and domains towards all pages, and a page's own share is taken out of
the prior it is judged by.

Sums are made of whole millionths, so that results don't depend on the order of rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewatch.llm.common import cut, pick, slices

SAMPLE = 4000                   # labelled documents the trigram tables are counted on, about
CODES = 1 << 16                 # trigram codes
UNIT = 1_000_000
TEMPER = 0.05                   # weight of one trigram's log-likelihood: neighbours are far from independent
KAPPA = 20.0                    # pages that a parent's prior counts for


# ---------------------------------------------------------------- text evidence

def codes(text: bytes) -> np.ndarray:
    """Codes of the byte trigrams of a lower-cased text, white space and digits as one blank."""
    fold = np.arange(256, dtype=np.uint32)
    fold[65:91] += 32
    fold[:65] = 32
    raw = fold[np.frombuffer(text, np.uint8)]
    raw = raw[np.concatenate([[True], (raw[1:] != 32) | (raw[:-1] != 32)])] if len(raw) else raw
    return ((raw[:-2] * 40503 + raw[1:-1] * 30011 + raw[2:] * 10007) * np.uint32(2654435761) >> np.uint32(16)) if len(raw) > 2 \
        else np.zeros(0, np.uint32)


def train(docs: DataFrame, texts: int = SAMPLE, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and their log trigram probabilities, from about ``texts`` labelled documents."""
    src = pick(docs, text=text_col, lang=lang_col).where("text is not null and lang is not null")
    total = src.count()
    limit = (1 << 24) if total <= texts else int((1 << 24) * texts / total)
    drawn = src.where(F.conv(F.substring(F.md5(F.col("text").cast("binary")), 1, 6), 16, 10).cast("int") < limit)

    def count(batches):
        import pyarrow as pa
        seen: dict[str, np.ndarray] = {}
        for b in batches:
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seen.setdefault(lang, np.zeros(CODES, np.int64))
                seen[lang] += np.bincount(codes(text.encode()), minlength=CODES)
        for lang, n in seen.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(n[at])], ["lang", "code", "n"])
    rows = drawn.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n")).collect()
    langs = sorted({r["lang"] for r in rows})
    table = np.full((len(langs), CODES), 0.1)
    place = {x: i for i, x in enumerate(langs)}
    for r in rows:
        table[place[r["lang"]], r["code"]] += r["n"]
    return langs, np.log(table / table.sum(1, keepdims=True)) if langs else table


def declared(html: str) -> str | None:
    """Language of the first html tag that names one, wherever it stands; comments, scripts and styles hold no tags."""
    import re
    for m in re.finditer(r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<html\b([^>]*)", html, re.I | re.S):
        head = re.search(r"\blang\s*+=\s*+[\"']?+\s*+([A-Za-z]{2,3})(?![A-Za-z])", m.group(2) or "", re.I)
        if head:
            return head.group(1).lower()
    return None


def visible(html: str) -> tuple[str | None, str]:
    """(declared language, visible text) of a page."""
    import re
    text = re.sub(r"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w+;", " ", html, flags=re.I | re.S)
    return declared(html), text


def posterior(found: np.ndarray, table: np.ndarray) -> np.ndarray:
    score = TEMPER * table[:, found].sum(1)
    p = np.exp(score - score.max())
    return p / p.sum()


def text_evidence(pages: DataFrame, langs: list[str], table: np.ndarray, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(id, host, domain, suffix, declared, p: millionths per language) per page."""
    small = table.astype(np.float32)

    def run(batches):
        import pyarrow as pa
        from urllib.parse import urlsplit
        for b in slices(batches):
            out = []
            for url, html in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                try:
                    host = (urlsplit(url or "").hostname or "").rstrip(".")
                except ValueError:
                    host = ""
                labels = host.split(".") if host else []
                said, text = visible(html or "")
                p = posterior(codes(text.encode("utf-8", "replace")), small)
                out.append((host or None, ".".join(labels[-2:]) or None, labels[-1] if labels else None, said,
                            np.rint(p * UNIT).astype(np.int64).tolist()))
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.string()) for c in cols[:4]),
                                              pa.array(cols[4], pa.list_(pa.int64()))],
                                             ["id", "host", "domain", "suffix", "declared", "p"])
    src = pick(pages, id=id_col, url=url_col, html=html_col)
    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, host string, domain string, suffix string, declared string, p array<long>")


# ----------------------------------------------------------------------- fusion

def _sums(n: int) -> list[Column]:
    return [F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(n)]


def _packed(n: int, name: str) -> Column:
    return F.array(*[F.col(f"s{i}").cast("double") / UNIT for i in range(n)]).alias(name)


def _given(rows: DataFrame, key: str, n: int, name: str) -> DataFrame:
    """(key, name): log P(key | language) per language, add-one smoothed over the values seen."""
    count = rows.where(F.col(key).isNotNull()).groupBy(key).agg(*_sums(n)).select(key, _packed(n, "v"))
    total = count.agg(F.count("*").alias("kinds"), *[F.sum(F.col("v")[i]).alias(f"t{i}") for i in range(n)]).first()
    logs = [F.round(F.log((F.col("v")[i] + 1) / ((total[f"t{i}"] or 0.0) + total["kinds"] + 1)), 6) for i in range(n)]
    return count.select(key, F.array(*logs).alias(name))


def identify(pages: DataFrame, docs: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
             texts: int = SAMPLE) -> DataFrame:
    """(id, lang, probability, text_lang, declared, suffix, host) per page.

    ``docs`` are the labelled documents (text, lang).  Evidence that a page lacks (null or
    empty page, null or odd address, no declaration) says nothing; a page without any gets the most
    frequent language.  Ties go to the first language by name.  Without labelled documents
    every lang is null.  Null ids and repeated rows keep their own result row; other columns are not read.
    """
    langs, table = train(docs, texts)
    n = len(langs)
    if not n:
        empty = F.lit(None).cast("string")
        return pick(pages, id=id_col).select("id", empty.alias("lang"), F.lit(None).cast("double").alias("probability"),
                                             empty.alias("text_lang"), empty.alias("declared"), empty.alias("suffix"), empty.alias("host"))
    rows = cut(text_evidence(pages, langs, table, id_col, url_col, html_col))
    world = rows.agg(*_sums(n)).first()
    share = np.array([float(x or 0) for x in world]) / UNIT + 1.0
    share = (share / share.sum()).tolist()
    hosts = rows.where("host is not null").groupBy("domain", "host").agg(*_sums(n)).select("domain", "host", _packed(n, "h"))
    domains = hosts.groupBy("domain").agg(*[F.sum(F.col("h")[i]).alias(f"d{i}") for i in range(n)]) \
        .select("domain", F.array(*[F.col(f"d{i}") for i in range(n)]).alias("d"))
    known = hosts.join(domains, "domain").select("host", "h", "d")
    fused = rows.join(known, "host", "left")
    own = [F.col("p")[i].cast("double") / UNIT for i in range(n)]
    world_prior = [F.lit(x) for x in share]

    def smoothed(counts: str, parent: list[Column]) -> list[Column]:
        rest = [F.greatest(F.coalesce(F.col(counts)[i], own[i]) - own[i], F.lit(0.0)) for i in range(n)]
        size = sum(rest[1:], rest[0])
        return [(rest[i] + KAPPA * parent[i]) / (size + KAPPA) for i in range(n)]
    prior = smoothed("h", smoothed("d", world_prior))
    fused = fused.withColumn("prior", F.array(*prior))
    nothing = F.array(*[F.lit(0.0)] * n)
    for key in ("declared", "suffix"):
        fused = fused.join(_given(rows, key, n, f"l_{key}"), key, "left").withColumn(f"l_{key}", F.coalesce(f"l_{key}", nothing))
    score = F.array(*[F.round(F.log(F.greatest(own[i], F.lit(1.0 / UNIT))) + F.log(F.col("prior")[i]) + F.col("l_declared")[i]
                              + F.col("l_suffix")[i], 6) for i in range(n)])
    fused = fused.withColumn("score", score).withColumn("top", F.array_max("score"))
    names = F.array(*[F.lit(x) for x in langs])
    total = F.aggregate(F.transform("score", lambda s: F.exp(s - F.col("top"))), F.lit(0.0), lambda a, x: a + x)
    return fused.select("id", F.get(names, (F.array_position("score", F.col("top")) - 1).cast("int")).alias("lang"),
                        F.round(1 / total, 6).alias("probability"),
                        F.get(names, (F.array_position("p", F.array_max("p")) - 1).cast("int")).alias("text_lang"),
                        "declared", "suffix", "host")
