"""Personal data: patterns, and boosted trees over candidates that patterns don't name.

Generators of high recall propose candidate spans that may overlap: chains of digits with
any separators, digit groups of usual shapes, addresses with spelled-out signs, account
numbers, colon-separated hex.  Every candidate has features of its format (counts, groups,
check digits) and its context (the characters and words beside it).  Gradient boosted trees,
trained on labelled samples, give it a margin; a threshold per generator, calibrated on
samples held out from training, decides.  Patterns' spans always stay, candidates that touch
one give way, and of two candidates that overlap the higher margin stays.

Labelled samples come from every text, copies counted once: values of many formats, personal
or not, written between words of the text; the text's own candidates count as personal where
they cover a pattern's span and, with a small weight, as ordinary elsewhere.  Samples with
equal features are one row whose weight is their number's, so trees and thresholds see them all.

Everything runs in DataFrame expressions, the trees are compiled into one; a text never
leaves its row.  Patterns take time linear in the text: they start at the beginning of a run
or where the last match ended, and repeat possessively.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewatch.llm.common import cut, pick

PLANTED, LEAST = 47_200, 4      # values written into samples, at least: of all texts, of each
SPLITS = 1024                   # split points of a feature, at most; MLlib looks for them in SPLITS ** 2 rows, no feature has 100 values
PART = 100_000                  # rows of different features that the trees are fitted on, per partition
TREES, DEPTH = 40, 4            # on all texts 20 left a sixth to half of the group generator's recall unlearned
PRECISION = 0.995               # of held-out samples above a generator's threshold, at least
UNLABELLED = 0.25               # weight of a text's own candidate that no pattern covers
CONTEXT = 32                    # characters of context before a candidate
LONGEST = 48                    # characters of a candidate, at most

_LOCAL = "A-Za-z0-9._%+-"
# What counts as personal data by its look.  Kind -> pattern, in the order of the kinds.
KINDS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# Cheap tests that a text must pass before a pattern is tried.
_TESTS = {"email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": r"(?:[0-9][\x20-]?){11}[0-9]", "phone": r"\+[0-9]"}

_AT, _DOT = r"(?:@|[\[({<]\x20?at\x20?[\])}>])", r"(?:\.|[\[({<]\x20?dot\x20?[\])}>])"
# Generator -> (test, pattern).
GENERATORS = {
    "mailish": (r"(?i)@|[\[({<]\x20?at\x20?[\])}>]",
                rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++\x20?(?i:{_AT})\x20?[A-Za-z0-9-]++(?:\x20?(?i:{_DOT})\x20?[A-Za-z0-9-]++)++"),
    "chain": (r"(?:[0-9][\x20().\/-]{0,3}){6}[0-9]", r"[+(]?[0-9](?:[\x20().\/-]{0,3}[0-9])++"),
    "group": (r"[0-9]{7}|[0-9]{3}[)]?[\x20.-][0-9]{2}|[0-9]{4}[\x20.-][0-9]{4}",
              r"(?<![0-9])(?:[0-9]{4}[\x20.-][0-9]{4}[\x20.-][0-9]{4}[\x20.-][0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4}"
              r"|[(]?[0-9]{3}[)]?[\x20.-][0-9]{3}[\x20.-][0-9]{4}|[0-9]{7,19})(?![0-9])"),
    "account": (r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "colons": (r"(?:[0-9A-Fa-f]{1,4}::?){3}", r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?:::?[0-9A-Fa-f]{1,4}){4,7}(?![0-9A-Za-z:])"),
}
_WORDS = {                      # words of the context, in the languages of the tables
    "w_phone": r"(?i)(?:phone|tel|t[ée]l|call|mobil|fax|anruf|llam|appel)",
    "w_mail": r"(?i)(?:mail|contact|kontakt|correo|courriel|write)",
    "w_card": r"(?i)(?:card|visa|karte|carte|tarjeta|credit)",
    "w_id": r"(?i)(?:ssn|social|passport|iban|account|konto|compte|cuenta|tax)",
    "w_net": r"(?i)(?:\bip\b|server|host|address|mac\b)",
    "w_thing": r"(?i)(?:order|invoice|version|isbn|date|total|price|ref|item|serial|page|no\.|nr\.|build|part)",
}
_SPANS = "array<struct<start:bigint,end:bigint,rank:int,kind:string,hit:string,before:string,after:string>>"


# ------------------------------------------------------------------------ spans

def _let(value: Column, use) -> Column:
    """``use(value)``, the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _chunks(items: Column) -> Column:
    """An array in pieces of about the root of its size: folds that append stay far from quadratic."""
    size = F.ceil(F.sqrt(F.size(items))).cast("int")
    return F.when(F.size(items) > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / size).cast("int")),
                                                 lambda j: F.slice(items, j * size + 1, size)))


def spans_of(text: Column, test: str, pattern: str, kind: str, rank: int) -> Column:
    """Matches of a pattern, left to right, with the characters beside them that the pattern leaves."""
    none = F.expr(f"cast(array() as {_SPANS})")
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    met = _let(F.split(text, pattern, -1), lambda gaps: F.transform(
        hits, lambda h, i: F.struct(h.alias("hit"), F.get(gaps, i).alias("gap"), F.get(gaps, i + 1).alias("next"))))

    def walked(chunk: Column) -> Column:                # spans counted from the chunk's start, and its length
        return F.aggregate(
            chunk, F.struct(F.lit(0).cast("long").alias("at"), none.alias("out")),
            lambda acc, x: _let(acc["at"] + F.length(x["gap"]), lambda start: F.struct(
                (start + F.length(x["hit"])).alias("at"),
                F.concat(acc["out"], F.array(F.struct(
                    start.alias("start"), (start + F.length(x["hit"])).alias("end"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
                    x["hit"].alias("hit"), F.right(x["gap"], F.lit(CONTEXT)).alias("before"), F.left(x["next"], F.lit(8)).alias("after")))).alias("out"))))

    def moved(spans: Column, by: Column) -> Column:
        return F.transform(spans, lambda s: F.struct((s["start"] + by).alias("start"), (s["end"] + by).alias("end"), *[
            s[c].alias(c) for c in ("rank", "kind", "hit", "before", "after")]))
    joined = F.aggregate(
        F.transform(_let(met, _chunks), walked), F.struct(F.lit(0).cast("long").alias("at"), F.expr(f"cast(array() as array<{_SPANS}>)").alias("out")),
        lambda acc, c: F.struct((acc["at"] + c["at"]).alias("at"), F.concat(acc["out"], F.array(moved(c["out"], acc["at"]))).alias("out")),
        lambda acc: F.flatten(acc["out"]))
    return F.when(text.rlike(test), F.coalesce(joined, none)).otherwise(none)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return hit.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return F.when(hit.rlike(r"^[0-9](?:[\x20-]?[0-9]){11,18}$"), _luhn(_digits(hit))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(hit)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """The patterns' spans."""
    def valid(kind):
        return lambda s: _valid(kind, s["hit"])
    return F.concat(*[F.filter(spans_of(text, _TESTS[k], p, k, i), valid(k)) for i, (k, p) in enumerate(KINDS.items())])


def candidates(text: Column) -> Column:
    """What the generators propose: spans of 7 or more digits or with letters, not too long."""
    def fits(least):
        return lambda s: (F.length(s["hit"]) <= LONGEST) & (F.length(_digits(s["hit"])) >= least)
    return F.concat(*[F.filter(spans_of(text, test, p, k, len(KINDS) + i), fits(7 if k in ("chain", "group") else 0))
                      for i, (k, (test, p)) in enumerate(GENERATORS.items())])


# --------------------------------------------------------------------- features

def _number(test: Column) -> Column:
    return F.coalesce(test.cast("int"), F.lit(0)).cast("double")


def _mod97(hit: Column) -> Column:
    """Remainder of an account number as its check digits take it; 0 where it cannot be one."""
    tight = F.regexp_replace(hit, " ", "")
    turned = F.concat(F.substring(tight, 5, 64), F.substring(tight, 1, 4))
    value = F.aggregate(F.split(turned, ""), F.lit(0).cast("long"), lambda acc, c: F.when(
        c.between("0", "9"), (acc * 10 + F.ascii(c) - 48) % 97).when(c.between("A", "Z"), (acc * 100 + F.ascii(c) - 55) % 97).otherwise(acc))
    return F.when(tight.rlike("^[A-Z]{2}[0-9]{2}[A-Z0-9]{8,30}$"), value).otherwise(F.lit(0).cast("long"))


def features(c: Column) -> dict[str, Column]:
    """Features of a candidate (hit, before, after, rank), all doubles."""
    hit, before, after = c["hit"], c["before"], c["after"]
    digits = _digits(hit)
    groups = F.filter(F.split(hit, "[^0-9]+"), lambda g: g != "")
    sizes = F.transform(groups, lambda g: F.length(g))
    out = {
        "generator": c["rank"].cast("double"), "length": F.length(hit).cast("double"), "digits": F.length(digits).cast("double"),
        "letters": F.length(F.regexp_replace(hit, "[^A-Za-z]", "")).cast("double"),
        "spaces": F.length(F.regexp_replace(hit, "[^ ]", "")).cast("double"),
        "dots": F.length(F.regexp_replace(hit, "[^.]", "")).cast("double"),
        "dashes": F.length(F.regexp_replace(hit, "[^-]", "")).cast("double"),
        "slashes": F.length(F.regexp_replace(hit, "[^/]", "")).cast("double"),
        "groups": F.size(groups).cast("double"), "largest": F.coalesce(F.array_max(sizes), F.lit(0)).cast("double"),
        "first_group": F.coalesce(F.get(sizes, F.lit(0)), F.lit(0)).cast("double"),
        "last_group": F.coalesce(F.get(sizes, F.size(sizes) - 1), F.lit(0)).cast("double"),
        "luhn": _number(F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(F.lit(False))),
        "mod97": _number(_mod97(hit) == 1), "plus": _number(hit.startswith("+")), "paren": _number(hit.contains("(")),
        "zero": _number(digits.startswith("0")), "at": _number(hit.contains("@")),
        "bytes": _number(hit.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")),
        "top_label": F.length(F.regexp_extract(hit, r"([A-Za-z]+)$", 1)).cast("double"),
        "date": _number(hit.rlike(r"^(?:(?:19|20)[0-9]{2}[-./][0-9]{1,2}[-./][0-9]{1,2}|[0-9]{1,2}[-./][0-9]{1,2}[-./](?:19|20)[0-9]{2})")),
        "decimal": _number(hit.rlike(r"^[0-9]+\.[0-9]+$")), "book": _number(digits.rlike(r"^97[89][0-9]{10}$")),
        "colons": F.length(F.regexp_replace(hit, "[^:]", "")).cast("double"),
        "joined_before": _number(before.rlike(r"[\p{L}0-9_#$%&*=/.:,+-]$")), "joined_after": _number(after.rlike(r"^[\p{L}0-9_%=/:+-]")),
        "digits_before": F.length(_digits(before)).cast("double"),
    }
    near = F.right(before, F.lit(20))
    return out | {w: _number(near.rlike(p)) for w, p in _WORDS.items()}


FEATURES = ("generator length digits letters spaces dots dashes slashes groups largest first_group last_group luhn mod97 plus paren zero at bytes "
            "top_label date decimal book colons joined_before joined_after digits_before").split() + list(_WORDS)


# ------------------------------------------------------------------ labelled samples

def _pool(key: Column) -> Column:
    """1,024 digits for a text's digest."""
    return F.concat(*[F.translate(F.sha2(F.concat(F.lit(salt), key), 256), "abcdef", "047293") for salt in "abcdefghijklmnop"])


def _formats(name: Column, pool: Column, hexes: Column) -> list[tuple[bool, str, Column]]:
    """(personal, lead, value) of every format, the value made from a text's name, digits and hex digits."""
    at = {"i": 1}

    def d(n: int) -> Column:                            # the next n digits
        start, at["i"] = at["i"], at["i"] + n
        return F.substring(pool, start, n)

    def card(n: int, sep: str, good: bool) -> Column:
        head = F.concat(F.lit("4"), d(n - 2))
        whole = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda x: F.concat(head, x.cast("string")))
        value = F.get(F.filter(whole, lambda v: _luhn(v) == F.lit(good)), F.lit(0))
        return F.concat_ws(sep, *[F.substring(value, i, 4) for i in range(1, n, 4)]) if sep else value

    def byte(n: int = 2) -> Column:
        return F.pmod(d(n).cast("int"), F.lit(256)).cast("string")
    bank = d(18)
    check = F.lpad((98 - F.concat(bank, F.lit("131400")).cast("decimal(38,0)") % 97).cast("int").cast("string"), 2, "0")
    L, C = F.lit, F.concat
    yes = [
        ("", C(L("("), d(3), L(") "), d(3), L("-"), d(4))), ("call ", C(L("("), d(3), L(") "), d(3), L("-"), d(4))),
        ("phone: ", C(d(3), L("-"), d(3), L("-"), d(4))), ("tel ", C(d(3), L("."), d(3), L("."), d(4))), ("", C(d(3), L("-"), d(3), L("-"), d(4))),
        ("tél. ", C(L("0"), d(1), L(" "), d(2), L(" "), d(2), L(" "), d(2), L(" "), d(2))), ("Tel: ", C(L("00"), d(2), L(" "), d(3), L(" "), d(6))),
        ("mobil ", C(L("0"), d(3), L("/"), d(7))), ("", C(L("+"), L("4"), d(1), L(" "), d(3), L(" "), d(7))),
        ("", card(16, "", True)), ("card ", card(16, "", True)), ("", card(16, "-", True)), ("", card(16, " ", True)), ("visa ", card(16, ".", True)),
        ("", C(card(16, "", True), L(" "), card(16, "", True))),
        ("ssn ", C(d(3), L("-"), d(2), L("-"), d(4))), ("social security ", C(d(3), L("-"), d(2), L("-"), d(4))),
        ("", C(name, L(" [at] "), name, L(" [dot] com"))), ("mail ", C(name, L("(at)"), name, L(".org"))), ("", C(name, L(" @ "), name, L(".com"))),
        ("", C(name, L("."), d(2), L("@mail.example.com"))), ("contact ", C(name, L("@"), name, L(".net"))),
        ("iban ", C(L("DE"), check, bank)), ("", C(L("DE"), check, L(" "), F.regexp_replace(bank, "([0-9]{4})(?=[0-9])", "$1 "))),
        ("ip ", F.concat_ws(".", byte(), byte(3), byte(), byte(3))), ("mac ", F.regexp_replace(F.substring(hexes, 1, 12), "(..)(?=.)", "$1:")),
        ("host ", F.regexp_replace(F.substring(hexes, 1, 32), "(....)(?=.)", "$1:")),
    ]
    no = [
        ("order ", d(9)), ("", d(8)), ("", d(11)), ("", C(L("1"), d(12))), ("ref ", d(16)), ("", card(16, "", False)), ("", card(16, "", False)),
        ("", card(16, "-", False)), ("", card(16, " ", False)), ("card ", card(16, "", False)), ("", d(24)), ("serial ", d(18)), ("invoice ", C(d(4), L("-"), d(6))),
        ("date ", C(L("20"), d(2), L("-0"), d(1), L("-1"), d(1))), ("", C(L("1"), d(1), L(".0"), d(1), L(".19"), d(2))), ("", C(L("20"), d(2), L("/1"), d(1), L("/0"), d(1), L(" 10"))),
        ("", C(d(2), L("."), d(9))), ("total ", C(d(1), L(" "), d(3), L(" "), d(3), L("."), d(2))), ("isbn ", C(L("978-3-"), d(2), L("-"), d(6), L("-"), d(1))),
        ("", C(L("978"), d(10))), ("version ", C(d(1), L("."), d(2), L("."), d(1), L("."), d(4))), ("", C(L("9"), d(2), L(".4"), d(2), L(".3"), d(2), L(".8"), d(2))),
        ("", C(d(2), L(" "), d(2), L(" "), d(2), L(" "), d(2), L(" "), d(2), L(" "), d(2))), ("", C(L("19"), d(2), L("-20"), d(2), L("-20"), d(2))),
        ("", C(d(3), L(" "), d(3), L(" "), d(3), L(" "), d(3))), ("", C(name, L(" @ "), d(1), L(".50"))), ("", C(name, L(" @"), name, L(". "), name)),
        ("", C(L("AB"), d(2), L(" "), d(4), L(" CD"), d(2), L(" "), d(4))), ("part ", C(F.upper(F.substring(hexes, 1, 2)), L("XY"), d(2), d(8))),
        ("", C(d(2), L(":"), d(2), L(":"), d(2), L(":"), d(2), L(":"), d(2))), ("build ", C(d(4), L("."), d(4), L("."), d(2))), ("page ", C(d(3), L("-"), d(4))),
    ]
    return [(good, lead, value) for good, some in ((True, yes), (False, no)) for lead, value in some]


def _made(texts: DataFrame, planted: int) -> DataFrame:
    """(key, of, nth, held, label, weight, c): candidates that meet one of the values written between two words of each text.

    A text takes as many formats as it needs for ``planted`` values in all, ``LEAST`` or more, the first one by its
    digest; the weights are as if it took all of them."""
    formats = _formats(F.col("name"), F.col("pool"), F.col("key"))
    shown = [(i, lead) for i, (_, lead, _) in enumerate(formats)] + [(i, "") for i, (_, lead, _) in enumerate(formats) if lead]     # every value also without its lead
    number = max(texts.select("key").distinct().count(), 1)
    each = min(len(shown), max(LEAST, -(-planted // number)))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    place = F.conv(F.substring("key", 1, 7), 16, 10).cast("int")

    def word(at: Column) -> Column:
        return F.coalesce(F.get(F.col("words"), F.pmod(at, F.greatest(F.size("words"), F.lit(1)))), F.lit("word"))
    name = F.coalesce(F.nullif(F.lower(F.regexp_extract("text", r"([A-Za-z]{3,12})", 1)), F.lit("")), F.lit("name"))
    beside = texts.select("key", name.alias("name"), words.alias("words")).select(
        "key", "name", _pool(F.col("key")).alias("pool"), word(place).alias("a"), word(place + 7).alias("b"))
    first = F.conv(F.substring("key", 8, 7), 16, 10).cast("int")
    dealt = beside.select("*", F.explode(F.transform(F.sequence(F.lit(0), F.lit(each - 1)), lambda j: F.pmod(first + j, F.lit(len(shown))))).alias("of"))

    def known(items) -> Column:
        return F.get(F.array(*[F.lit(x) for x in items]), F.col("of"))
    dealt = dealt.withColumns({"i": known(i for i, _ in shown), "lead": known(lead for _, lead in shown),
                               "personal": known(formats[i][0] for i, _ in shown)})
    value = F.when(F.col("i") == 0, formats[0][2])
    for i, (_, _, v) in enumerate(formats[1:], 1):
        value = value.when(F.col("i") == i, v)
    made = dealt.select("key", "of", "personal", "a", "b", "lead", value.alias("value"))
    start = F.length("a") + 1 + F.length("lead")
    made = made.select("key", "of", "personal", "value", F.concat("a", F.lit(" "), "lead", "value", F.lit(" "), "b").alias("text"),
                       start.cast("long").alias("s"), (start + F.length("value")).cast("long").alias("e"))
    made = made.select("key", "of", "personal", "value", "s", "e", F.posexplode(candidates(F.col("text"))).alias("nth", "c"))
    half = F.col("personal") & F.col("value").rlike(r"^[0-9]{16}\x20[0-9]{16}$")                   # either number is one
    covers = ((F.col("c.start") <= F.col("s")) & (F.col("c.end") >= F.col("e"))) | (half & F.col("c.hit").rlike("^[0-9]{16}$"))
    return made.where((F.col("c.start") < F.col("e")) & (F.col("s") < F.col("c.end"))).select(
        "key", "of", "nth", (F.col("personal") & covers).cast("double").alias("label"), F.lit(len(shown) / each).alias("weight"), "c")


def samples(docs: DataFrame, texts: int | None = None, text_col: str = "text", planted: int = PLANTED) -> DataFrame:
    """(held, label, weight, features): labelled candidates of every distinct text, those of equal features in one row of
    their weights' sum.  ``texts`` is for trials: that many texts, the smallest digests."""
    src = pick(docs, text=text_col).where("text is not null and text <> ''")
    keyed = src.withColumn("key", F.md5(F.col("text").cast("binary")))
    if texts is not None:
        keyed = keyed.where(F.col("key").isin([r["key"] for r in keyed.select("key").distinct().orderBy("key").limit(texts).collect()]))
    real = keyed.select("key", base_spans(F.col("text")).alias("base"), candidates(F.col("text")).alias("cs"))
    real = real.select("key", "base", F.posexplode("cs").alias("nth", "c"))
    known = F.exists("base", lambda b: (F.col("c.start") <= b["start"] + 1) & (b["end"] <= F.col("c.end")))
    real = real.select("key", F.lit(-1).alias("of"), "nth", known.cast("double").alias("label"),
                       F.when(known, 1.0).otherwise(UNLABELLED).alias("weight"), "c")
    held = (F.conv(F.substring("key", 32, 1), 16, 10).cast("int") % 3 == 0).alias("held")
    # all features are small whole numbers: a text of them is what is shuffled
    code = F.concat_ws(",", *[v.cast("int").cast("string") for v in features(F.col("c")).values()]).alias("code")
    every = _made(keyed, planted).unionByName(real).select("key", "of", "nth", held, "label", "weight", code)
    # copies of a text give equal rows; weights are multiplied, not summed, so that they don't depend on the layout
    counted = every.distinct().groupBy("held", "label", "weight", "code").count()
    numbers = F.split("code", ",")
    return counted.select("held", "label", (F.col("weight") * F.col("count")).alias("weight"), "code").select(
        "held", "label", "weight", *[F.get(numbers, F.lit(i)).cast("double").alias(n) for i, n in enumerate(FEATURES)])


# --------------------------------------------------------------------- the model

@dataclass(frozen=True)
class Model:
    """Margin of a candidate as SQL over its features, the threshold of each generator, and held-out figures."""
    margin: str
    thresholds: dict[int, float]
    held_out: dict[str, tuple[float, float, float]] = field(default_factory=dict)        # generator -> samples, precision, recall


def _tree(node, names) -> str:
    if not node.getClass().getSimpleName().endswith("InternalNode"):
        return f"{float(node.prediction())!r}D"
    split = node.split()
    test = f"{{c}}.{names[split.featureIndex()]} <= {float(split.threshold())!r}D"
    return f"CASE WHEN {test} THEN {_tree(node.leftChild(), names)} ELSE {_tree(node.rightChild(), names)} END"


def train(docs: DataFrame, texts: int | None = None, trees: int = TREES, depth: int = DEPTH, precision: float = PRECISION,
          text_col: str = "text") -> Model:
    """Trees fitted on two thirds of the samples, thresholds set on the rest.  Without texts nothing is ever added."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    rows = cut(samples(docs, texts, text_col))
    fit = rows.where("not held")
    if fit.groupBy("label").count().count() < 2:
        return Model("0D", {})
    # rows dealt by their features and in a fixed order: sums of doubles hardly depend on the layout, in one part not at all
    dealt = fit.repartition(-(-fit.count() // PART), *FEATURES).sortWithinPartitions("label", "weight", *FEATURES)
    table = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(dealt).select("label", "weight", "x")
    fitted = GBTClassifier(labelCol="label", featuresCol="x", weightCol="weight", maxIter=trees, maxDepth=depth, maxBins=SPLITS, stepSize=0.3,
                           seed=1).fit(table)
    parts = [f"{float(w)!r}D * ({_tree(t._call_java('rootNode'), FEATURES)})" for w, t in zip(fitted.treeWeights, fitted.trees)]
    margin = " + ".join(parts)
    scored = rows.where("held").select(F.struct(*FEATURES).alias("f"), "label", "weight")
    # in a lambda, as where texts are scanned: the trees are too long for one compiled method
    bins = scored.select("label", "weight", F.col("f").alias("c"), F.floor(F.expr(f"get(transform(array(f), c -> {margin.format(c='c')}), 0)") * 20).alias("bin")).groupBy(F.col("c.generator").cast("int").alias("g"), "bin") \
        .agg(F.sum(F.col("label") * F.col("weight")).alias("good"), F.sum("weight").alias("n")).orderBy(F.col("bin").desc()).collect()
    thresholds, held_out = {}, {}
    for i, name in enumerate(GENERATORS):
        g, good, n, best = len(KINDS) + i, 0.0, 0.0, None
        mine = [r for r in bins if r["g"] == g]
        total = sum(r["good"] for r in mine)
        for r in mine:                                  # the lowest bin down to which precision holds
            good, n = good + r["good"], n + r["n"]
            if good >= precision * n and good > 0:
                best = (r["bin"] / 20, good / n, good / total)
        if best:
            thresholds[g] = best[0]
            held_out[name] = (sum(r["n"] for r in mine), best[1], best[2])
    return Model(margin, thresholds, held_out)


# -------------------------------------------------------------------------- scan

_SHORT = "struct<start:bigint,end:bigint,rank:int,kind:string,margin:double>"


def _likely(model: Model) -> Column:
    """Candidates (column ``cands``, with their features) at or above their generator's threshold."""
    if not model.thresholds:
        return F.expr(f"cast(array() as array<{_SHORT}>)")
    cases = " ".join(f"WHEN {g} THEN {t!r}D" for g, t in model.thresholds.items())
    return F.expr("filter(transform(cands, c -> named_struct('start', c.start, 'end', c.end, 'rank', c.rank, 'kind', c.kind, 'margin', "
                  f"{model.margin.format(c='c.f')})), c -> c.margin >= CASE c.rank {cases} END)")


def _fold(items: str, state: str, step: str, out: str = f"array<{_SHORT}>") -> str:
    """SQL: fold of an array column by ``step`` over (acc.state, acc.out, x), in chunks; gives (state, out)."""
    size = f"cast(ceil(sqrt(size({items}))) as int)"
    chunks = f"transform(sequence(0, cast(floor((size({items}) - 1) / {size}) as int)), j -> slice({items}, j * {size} + 1, {size}))"
    inner = f"aggregate(chunk, named_struct('state', big.state, 'out', cast(array() as {out})), (acc, x) -> {step})"
    return (f"aggregate({chunks}, named_struct('state', {state}, 'outs', cast(array() as array<{out}>)), (big, chunk) -> "
            f"get(transform(array({inner}), r -> named_struct('state', r.state, 'outs', concat(big.outs, array(r.out)))), 0), "
            f"big -> named_struct('state', big.state, 'out', flatten(big.outs)))")


def _settled(found: DataFrame, spans: str) -> DataFrame:
    """``spans`` holds base spans and likely candidates, by start: candidates that touch a base span go, then of two
    that overlap the one of lower margin."""
    n = len(KINDS)
    forward = (f"named_struct('state', if(x.rank < {n}, greatest(acc.state, x.end), acc.state), "
               f"'out', if(x.rank >= {n} and acc.state > x.start, acc.out, concat(acc.out, array(x))))")
    backward = (f"named_struct('state', if(x.rank < {n}, least(acc.state, x.start), acc.state), "
                f"'out', if(x.rank >= {n} and acc.state < x.end, acc.out, concat(acc.out, array(x))))")
    better = "x.margin > acc.state.margin or (x.margin = acc.state.margin and x.end - x.start > acc.state.end - acc.state.start)"
    best = (f"CASE WHEN x.rank < {n} THEN named_struct('state', acc.state, 'out', concat(acc.out, array(x))) "
            f"WHEN acc.state IS NULL THEN named_struct('state', x, 'out', acc.out) "
            f"WHEN x.start < acc.state.end THEN named_struct('state', if({better}, x, acc.state), 'out', acc.out) "
            f"ELSE named_struct('state', x, 'out', concat(acc.out, array(acc.state))) END")
    steps = [("after", f"reverse({_fold(spans, '-1L', forward)}.out)"), ("clear", f"reverse({_fold('after', f'{1 << 62}L', backward)}.out)"),
             ("best", _fold("clear", f"cast(null as {_SHORT})", best))]
    for name, sql in steps:
        found = found.withColumn(name, F.expr(f"if(size(likely) > 0, {sql}, null)"))
    return found.withColumn("settled", F.expr(f"CASE WHEN size(likely) = 0 THEN {spans} WHEN best.state IS NULL THEN best.out "
                                              "ELSE concat(best.out, array(best.state)) END"))


def scan(docs: DataFrame, model: Model, id_col: str | None = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row: id, text (and the kept columns), base and spans: arrays of (start, end, rank, kind, ...).

    ``base`` holds the patterns' spans, ``spans`` these and the added ones, in code points, end exclusive, by start and
    then kind.  Added spans overlap neither base ones nor each other.  A null text is an empty one.  Null ids and
    repeated rows keep rows of their own; no other columns are read; an empty table gives none.
    """
    src = docs.select(*([docs[f"`{id_col}`"].alias("id")] if id_col else []), F.coalesce(docs[f"`{text_col}`"], F.lit("")).alias("text"),
                      *[docs[f"`{c}`"] for c in keep])
    cands = F.transform(candidates(F.col("text")), lambda c: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), c["rank"].alias("rank"), c["kind"].alias("kind"),
        F.struct(*[v.alias(n) for n, v in features(c).items()]).alias("f")))
    found = src.withColumn("base", base_spans(F.col("text"))).withColumn("cands", cands).withColumn("likely", _likely(model))
    short = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["rank"].alias("rank"),
                                                   s["kind"].alias("kind"), F.lit(0.0).alias("margin")))
    done = _settled(found.withColumn("short", short).withColumn("every", F.array_sort(F.concat("short", "likely"))), "every")
    order = F.array_sort(F.transform("settled", lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"),
                                                                 s["kind"].alias("kind"))))
    by_kind = F.array_sort(F.transform("short", lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"),
                                                                   s["kind"].alias("kind"))))
    return done.select(*(["id"] if id_col else []), "text", *keep, by_kind.alias("base"), order.alias("spans"))
