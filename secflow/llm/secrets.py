"""Secret scans: three fixed patterns, and strings that look random to character Markov models.

DataFrame functions only. Two Markov models over characters, one of random strings and one of ordinary
identifiers, are compared by the log-likelihood ratio of a string's characters, each given the one
before it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secflow.llm import common

#: Kinds in order, and their patterns.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: Strings that the models judge: so many of these characters in a row, with a letter, outside the spans of the patterns.
LEAST_CANDIDATE = 20
CANDIDATE = "[A-Za-z0-9+/_-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-.="
#: Log-likelihood ratio per character that a random string must exceed.
LEAST_RATIO = 1.0


def _let(value: Column, use) -> Column:
    """``use`` applied to ``value``, which is evaluated once."""
    return F.get(F.transform(F.array(value), use), 0)


def _matches(text: Column, pattern: str, group: int) -> Column:
    """(start, matched, group value) of all matches, from the lengths of what lies between them.

    Lengths are added up inside runs of about the square root of their number, then over the runs, so no
    array is copied at every match.
    """
    parts = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
                     F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("values"), F.split(text, pattern, -1).alias("between"))
    places = "array<struct<start:int,match:string,value:string>>"

    def steps(p: Column) -> Column:
        return F.transform(p["found"], lambda m, i: F.struct(
            F.length(F.get(p["between"], i)).alias("gap"), F.length(m).alias("size"), m.alias("match"), F.get(p["values"], i).alias("value")))

    def runs(s: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(s))).cast("int"), F.lit(1))
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(s) - 1) / width).cast("int")), lambda r: F.slice(s, r * width + 1, width))

    def placed(run: Column) -> Column:
        """The run's matches from its own start, and its length."""
        return F.aggregate(
            run, F.struct(F.lit(0).alias("at"), F.array().cast(places).alias("out")),
            lambda acc, x: F.struct((acc.at + x.gap + x["size"]).alias("at"), F.concat(acc.out, F.array(F.struct(
                (acc.at + x.gap).alias("start"), x.match.alias("match"), x.value.alias("value")))).alias("out")))

    def moved(found: Column) -> Column:
        """The matches of all runs, each run behind the lengths of those before it."""
        before = F.aggregate(found, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
                             lambda acc, r: F.struct((acc.at + r["at"]).alias("at"), F.concat(acc.out, F.array(acc.at)).alias("out")), lambda acc: acc.out)
        return _let(before, lambda b: F.flatten(F.transform(found, lambda r, i: F.transform(r["out"], lambda m: F.struct(
            (m["start"] + F.get(b, i)).alias("start"), m["match"].alias("match"), m["value"].alias("value"))))))

    return _let(_let(parts, steps), lambda s: F.when(F.size(s) == 0, F.array().cast(places)).otherwise(
        _let(F.transform(runs(s), placed), moved)))


_NONE = "array<struct<start:int,match:string,value:string>>"


def _spans(text: Column) -> dict[str, Column]:
    none = F.array().cast(_NONE)
    return {
        "assign": F.when(text.rlike("(?i:password|passwd|secret|token|api_?key)"), F.filter(
            _matches(text, ASSIGN, 1), lambda m: F.length(m["value"]) >= LEAST["assign"])).otherwise(none),
        "access": F.when(text.contains("AKIA"), F.filter(_matches(text, ACCESS, 0), lambda m: F.length(m["match"]) >= LEAST["access"])).otherwise(none),
        "hex": F.when(text.rlike("[0-9a-f]{24}"), _matches(text, "[0-9a-f]{24,}", 0)).otherwise(none),
        "random": F.when(text.rlike(CANDIDATE), _matches(text, CANDIDATE, 0)).otherwise(none),
    }


def _pairs(strings: DataFrame) -> DataFrame:
    """Counts of (character before, character) over a column ``s``; the first follows '^'. Equal strings are counted first."""
    known = F.regexp_replace("s", r"[^A-Za-z0-9+/_.=-]", "")
    two = F.explode(F.transform(F.sequence(F.lit(1), F.length("t") - 1), lambda i: F.substring(F.col("t"), i, F.lit(2))))
    distinct = strings.groupBy("s").agg(F.count("*").alias("n"))
    return (distinct.select(F.concat(F.lit("^"), known).alias("t"), "n").where("length(t) > 1").select(two.alias("pair"), "n")
            .groupBy("pair").agg(F.sum("n").alias("n")))


def log_ratios(random: dict[str, int], ordinary: dict[str, int]) -> dict[str, float]:
    """Log-likelihood ratio of each character pair, with one added to every count."""

    def model(counts: dict[str, int]) -> dict[str, float]:
        before: dict[str, int] = {}
        for pair, n in counts.items():
            before[pair[0]] = before.get(pair[0], 0) + n
        return {a + b: math.log((counts.get(a + b, 0) + 1) / (before.get(a, 0) + len(ALPHABET))) for a in "^" + ALPHABET for b in ALPHABET}

    r, o = model(random), model(ordinary)
    return {pair: r[pair] - o[pair] for pair in sorted(r)}


def train_ratios(found: DataFrame, identifiers: DataFrame) -> dict[str, float]:
    """Pair ratios from labelled samples: ``found`` (s) of random strings, ``identifiers`` (s) of ordinary ones.

    Each sample is counted in the cluster; what reaches the driver is bounded by the alphabet. An empty
    sample leaves its model uniform.
    """
    return log_ratios({r.pair: r.n for r in _pairs(found).collect()}, {r.pair: r.n for r in _pairs(identifiers).collect()})


def _mean_ratio(s: Column, ratios: dict[str, float]) -> Column:
    """Log-likelihood ratio per character of a string of the alphabet, the table being one literal."""
    befores, width = "^" + ALPHABET, len(ALPHABET)
    table = F.array(*[F.lit(float(ratios.get(a + b, 0.0))) for a in befores for b in ALPHABET])

    def ratio(i: Column) -> Column:
        before = F.instr(F.lit(befores), F.substring(F.concat(F.lit("^"), s), i, F.lit(1))) - 1
        after = F.instr(F.lit(ALPHABET), F.substring(s, i, F.lit(1))) - 1
        return F.get(table, before * width + after)

    return F.aggregate(F.sequence(F.lit(1), F.length(s)), F.lit(0.0), lambda acc, i: acc + ratio(i)) / F.length(s)


def _outside(m: Column, base: Column) -> Column:
    """(start, match) of the parts of a candidate that lie outside all ``base`` spans and are long enough, with a letter."""
    end = m["start"] + F.length(m["match"])
    met = F.filter(base, lambda b: (b["start"] < end) & (m["start"] < b["end"]))

    def parts(near: Column) -> Column:
        starts = F.array_distinct(F.concat(F.array(m["start"]), F.transform(near, lambda b: b["end"])))
        free = F.filter(starts, lambda p: (p < end) & ~F.exists(near, lambda b: (b["start"] <= p) & (p < b["end"])))
        cut = F.transform(free, lambda p: F.struct(p.alias("start"), F.substring(m["match"], p - m["start"] + 1, F.coalesce(F.array_min(
            F.transform(F.filter(near, lambda b: b["start"] >= p), lambda b: b["start"])), end) - p).alias("match")))
        return F.filter(cut, lambda c: (F.length(c["match"]) >= LEAST_CANDIDATE) & c["match"].rlike("[A-Za-z]"))

    return _let(met, parts)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_ratio: float = LEAST_RATIO) -> DataFrame:
    """Spans of secrets in every row: ``doc_id`` and ``spans``, an array of (kind, start, end, value).

    Kinds are assign, access and hex, by pattern, and random, by the models; spans are sorted by start,
    then kind, in code points, the end exclusive. A random span never overlaps one of the patterns: of a longer
    string the parts outside them are judged. The labelled samples are what the patterns matched anywhere
    (random strings) and the shorter words of all documents that no pattern
    matched (ordinary ones).

    Null and empty texts have no spans. Null ids stay null, repeated rows give repeated equal rows, other
    columns are ignored whatever their names, and an empty table gives an empty result. Texts are read
    whole and once; only matches are stored in between.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = common.stored(rows.select("doc_id", *[c.alias(k) for k, c in _spans(F.col("text")).items()]), "secret-spans")
    known = found.select(F.explode(F.concat("assign", "access", "hex")).alias("m")).select(F.col("m.value").alias("s"))
    calm = rows.where(~F.col("text").rlike("(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{24}"))
    # Strings long enough to be judged do not teach the model that they are judged by.
    words = calm.select(F.explode(F.split("text", r"[^A-Za-z0-9+/_.=-]+")).alias("s")).where(F.length("s") < LEAST_CANDIDATE)
    ratios = train_ratios(known, words)

    def placed(kind: int, spans: Column | str) -> Column:
        return F.transform(spans, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("order"),
                                                     (m["start"] + F.length(m["match"])).alias("end"), m["value"].alias("value")))

    base = found.withColumn("base", F.concat(*[placed(i, k) for i, k in enumerate(KINDS[:3])]))
    parts = base.withColumn("parts", F.flatten(F.transform("random", lambda m: _outside(m, F.col("base")))))
    judged = F.filter("parts", lambda m: _mean_ratio(m["match"], ratios) > least_ratio)
    more = F.transform(judged, lambda m: F.struct(m["start"].alias("start"), F.lit(3).alias("order"),
                                                  (m["start"] + F.length(m["match"])).alias("end"), m["match"].alias("value")))
    names = F.array(*[F.lit(k) for k in KINDS])
    return parts.select("doc_id", F.transform(F.array_sort(F.concat("base", more)), lambda x: F.struct(
        F.get(names, x["order"]).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"))).alias("spans"))
