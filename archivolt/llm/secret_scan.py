"""Secret scan: base patterns, and a randomness test battery with false-discovery control; DataFrame functions only.

Candidates are maximal runs of 20 or more characters of ``[A-Za-z0-9+/_-]`` with up to two ``=`` behind, which overlap no
base span; a run that mixes signs of both base-64 alphabets is cut at its signs. The encoding is inferred from the characters
(decimal, hexadecimal, base 32, upper or lower base 36, base 62, base 64, letters alone). A secret looks uniform over its
encoding's alphabet, so three tests of that are made: chi-squared uniformity, runs above and below the alphabet's middle, and
serial correlation at lag one. Their squared z-scores are summed (chi-squared with three degrees of freedom, by the
Wilson-Hilferty cube root). Candidates that fail at the level ``alpha`` are not random and never reported.

Not to be told from random isn't enough, least of all for short strings, so what is reported is controlled too. The null
hypothesis there is a plain string: its letters, in either case, come from written words. Its p-value is the lower tail of the
letters' likelihood under the frequencies of letters in text against uniform ones (a normal law with the mean and deviation
of as many letters of text), so it depends on the length. Within each band of lengths the Benjamini-Hochberg rule at ``q``
bounds the share of plain strings among the reported candidates. Strings almost without letters have no power and are left
to the base patterns.

Scale: one pass over the texts, without an exchange; it leaves spans and candidates, which are few, in a table in the
shared folder. Ranks are not computed by sorting: p-values are counted in ``STEPS`` steps for each band, a table of bounded
size, from which the thresholds follow. Spans are found from the pieces between matches, in order, and meet the base spans in
one pass over both, so the time is near linear in a text's matches.

Defined results: a null text is empty. Rows that agree in id and text share their spans, and each is returned; their
candidates count once for each row. Other columns, whatever their names, are not read. A very long text or token is a row
like any other. No documents give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivolt.llm._common import written

#: The base patterns; letters of key names in either case.
ASSIGN = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
RUN = "[A-Za-z0-9+/_-]{20,}={0,2}"
KEY_NAMES = ("passw", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "random")
BANDS = (28, 40, 64)
STEPS = 400
PER_STEP = 0.05  # of the base-10 logarithm of p

_D, _U, _L = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Encodings in order of preference: name, what the characters must be, what must occur, and the alphabet.
ENCODINGS = (
    ("decimal", "^[0-9]+$", "[0-9]", _D),
    ("hex", "^[0-9a-f]+$", "[0-9]", _D + "abcdef"),
    ("HEX", "^[0-9A-F]+$", "[0-9]", _D + "ABCDEF"),
    ("base32", "^[A-Z2-7]+$", "[2-7]", _U + "234567"),
    ("base36", "^[A-Z0-9]+$", "[0-9]", _D + _U),
    ("base36l", "^[a-z0-9]+$", "[0-9]", _D + _L),
    ("base62", "^[A-Za-z0-9]+$", "[0-9]", _D + _U + _L),
    ("base64", "^[A-Za-z0-9+/]+$", "[0-9+]", _U + _L + _D + "+/"),
    ("base64url", "^[A-Za-z0-9_-]+$", "[0-9]", _U + _L + _D + "-_"),
    ("lower", "^[a-z]+$", "[a-z]", _L),
    ("upper", "^[A-Z]+$", "[A-Z]", _U),
    ("letters", "^[A-Za-z]+$", "[A-Za-z]", _U + _L),
)
#: The published frequencies of the letters a to z in English text, per cent.
LETTER_PERCENT = (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4, 6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.074)


def letter_scores(letters: str = _L) -> tuple[list[float], float, float]:
    """Of each letter the logarithm of its frequency in text against a uniform one; the score's mean and deviation in text."""
    own = [LETTER_PERCENT[ord(c) - ord("a")] for c in letters]
    share = [x / sum(own) for x in own]
    scores = [math.log(x * len(own)) for x in share]
    mean = sum(p * x for p, x in zip(share, scores, strict=True))
    return scores, mean, math.sqrt(sum(p * (x - mean) ** 2 for p, x in zip(share, scores, strict=True)))


def _normal_tail(z: Column) -> Column:
    """Probability of a standard normal value below ``z``, by a logistic approximation."""
    return F.lit(1.0) / (1 + F.exp(F.greatest(F.least(-1.5976 * z - 0.07056 * z * z * z, F.lit(700.0)), F.lit(-700.0))))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value made once, however often it stands in the body."""
    return F.transform(F.array(value), body)[0]


def _before(values: Column, none: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Of each element of an array ``join`` over all elements before it, ``none`` for the first.

    An accumulator that grows is copied at every step; so each of n elements looks back within its block of some n^(1/3), and
    each block at the blocks before it: n^(4/3) steps in all.
    """

    def within(block: Column, first: Column) -> Column:
        return F.transform(block, lambda x, i: F.aggregate(F.slice(block, 1, i), first, join))

    def blocks(own: Column) -> Column:
        size = F.greatest(F.ceil(F.cbrt(F.size(own).cast("double"))).cast("int"), F.lit(8))
        last = F.floor((F.greatest(F.size(own), F.lit(1)) - 1) / size).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(own, i * size + 1, size))

    def joined(parts: Column) -> Column:
        totals = F.transform(parts, lambda b: F.aggregate(b, none, join))
        firsts = _let(totals, lambda t: within(t, none))
        return F.flatten(F.zip_with(parts, firsts, within))

    return _let(_let(values, blocks), joined)


_SPAN = "struct<s:int,e:int,v:string,g:string>"


def _span(s: Column, e: Column, v: Column, g: Column) -> Column:
    return F.struct(s.alias("s"), e.alias("e"), v.alias("v"), g.alias("g"))


def _spans(text: Column, pattern: str, group: int | None = None, least: int = 0) -> Column:
    """Leftmost non-overlapping matches as structs (s, e, v) in code points; matches whose ``group`` is shorter than ``least``
    are dropped."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    size = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group is not None else found
    pieces = F.split(text, pattern)
    parts = F.zip_with(F.zip_with(found, size, lambda m, g: F.struct(m.alias("m"), g.alias("g"))), pieces, lambda x, p: F.struct(x.m.alias("m"), x.g.alias("g"), F.length(p).alias("p")))
    found = F.filter(parts, lambda x: x["m"].isNotNull())

    def placed(own: Column) -> Column:
        behind = F.transform(own, lambda x: x["p"] + F.length(x["m"]))
        starts = _let(behind, lambda steps: _before(steps, F.lit(0), lambda p, q: p + q))
        return F.zip_with(own, starts, lambda x, at: _span(at + x["p"], at + x["p"] + F.length(x["m"]), x["m"], x["g"]))

    every = _let(found, placed)
    return F.filter(every, lambda x: F.length(x["g"]) >= least) if least else every


def _apart(runs: Column, base: Column) -> Column:
    """The runs that overlap no base span: in order of start, no span before a run ends behind its start, and none behind it
    starts before its end."""

    def marked(x: Column, kind: int) -> Column:
        return F.struct(x["s"].alias("s"), F.lit(kind).alias("run"), x["e"].alias("e"), x["v"].alias("v"))

    both = F.sort_array(F.concat(F.transform(base, lambda x: marked(x, 0)), F.transform(runs, lambda x: marked(x, 1))))
    far = F.lit(2**31 - 1)

    def free(own: Column) -> Column:
        ends = F.transform(own, lambda x: F.when(x["run"] == 0, x["e"]).otherwise(0))
        starts = F.reverse(F.transform(own, lambda x: F.when(x["run"] == 0, x["s"]).otherwise(far)))
        reach = _let(ends, lambda e: _before(e, F.lit(0), lambda p, q: F.greatest(p, q)))
        ahead = F.reverse(_let(starts, lambda e: _before(e, far, lambda p, q: F.least(p, q))))
        around = F.zip_with(reach, ahead, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        tested = F.zip_with(own, around, lambda x, y: F.struct(x.alias("x"), ((x["run"] == 1) & (y["a"] <= x["s"]) & (y["b"] >= x["e"])).alias("free")))
        return F.transform(F.filter(tested, lambda z: z["free"]), lambda z: _span(z["x"]["s"], z["x"]["e"], z["x"]["v"], z["x"]["v"]))

    return F.when((F.size(base) == 0) | (F.size(runs) == 0), runs).otherwise(_let(both, free))


def _unmixed(run: Column) -> Column:
    """A run as an array; one with signs of both base-64 alphabets is cut at its signs."""
    v = run["v"]
    parts = F.transform(_spans(v, "[A-Za-z0-9]{20,}"), lambda x: _span(run["s"] + x["s"], run["s"] + x["e"], x["v"], x["v"]))
    whole = F.array(_span(run["s"], run["e"], v, v))
    return F.when(v.rlike("[+/]") & v.rlike("[_-]"), parts).otherwise(whole)


def _none() -> Column:
    return F.array().cast(f"array<{_SPAN}>")


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, th, assign, access, hex, runs): base spans and candidate runs of whole texts; ``th`` is the text's hash."""
    df = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    t, low = F.col("t"), F.lower("t")
    named = F.lit(False)
    for name in KEY_NAMES:  # cheap tests first: most texts have no key name
        named = named | F.contains(low, F.lit(name))
    run = F.flatten(F.transform(_spans(t, RUN), _unmixed))
    df = df.select(
        "id",
        F.xxhash64("t").alias("th"),
        F.when(named, _spans(t, ASSIGN, 2, 6)).otherwise(_none()).alias("assign"),
        F.when(F.contains(t, F.lit("AKIA")), _spans(t, ACCESS)).otherwise(_none()).alias("access"),
        _spans(t, HEX).alias("hex"),
        run.alias("runs"),
    )
    base = F.concat("assign", "access", "hex")
    apart = _apart(F.col("runs"), base)
    return df.select("id", "th", "assign", "access", "hex", F.transform(apart, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["v"].alias("v"))).alias("runs"))


def battery(runs: DataFrame) -> DataFrame:
    """Adds encoding, bits, z-scores (chi, wald, serial), p of a random string and p of a plain one to rows with a string
    ``v``; rows without an encoding go."""
    body = F.regexp_replace("v", "=+$", "")
    name, alphabet = F.lit(None).cast("string"), F.lit(None).cast("string")
    for enc, form, needs, symbols in reversed(ENCODINGS):
        fits = F.col("body").rlike(form) & F.col("body").rlike(needs)
        name, alphabet = F.when(fits, F.lit(enc)).otherwise(name), F.when(fits, F.lit(symbols)).otherwise(alphabet)
    df = runs.withColumn("body", body).withColumns({"encoding": name, "alphabet": alphabet}).where("encoding is not null")
    df = df.withColumns({"n": F.length("body").cast("double"), "k": F.length("alphabet").cast("double")})
    df = df.withColumn("codes", F.expr("transform(filter(split(body, ''), c -> c <> ''), c -> cast(instr(alphabet, c) - 1 as double))"))
    squares = F.expr("aggregate(filter(split(alphabet, ''), a -> a <> ''), 0d, (s, a) -> s + pow(n - length(replace(body, a, '')), 2))")
    chi2 = F.col("k") / F.col("n") * squares - F.col("n")
    df = df.withColumn("chi", (chi2 - (F.col("k") - 1)) / F.sqrt(2 * (F.col("k") - 1) * (F.col("n") - 1) / F.col("n")))
    df = df.withColumn("above", F.expr("transform(codes, c -> if(c >= k / 2, 1, 0))"))
    df = df.withColumns({"n1": F.expr("aggregate(above, 0d, (s, x) -> s + x)"), "next": F.expr("filter(codes, (x, i) -> i > 0)")})
    df = df.withColumn("turns", F.expr("1 + aggregate(zip_with(above, filter(above, (x, i) -> i > 0), (x, y) -> if(y is not null and x <> y, 1, 0)), 0d, (s, x) -> s + x)"))
    n, n1 = F.col("n"), F.col("n1")
    mean = 2 * n1 * (n - n1) / n + 1
    spread = (mean - 1) * (mean - 2) / (n - 1)
    df = df.withColumn("wald", F.when(spread > 0, (F.col("turns") - mean) / F.sqrt(spread)).otherwise(F.sqrt(n)))
    df = df.withColumn("m", F.expr("aggregate(codes, 0d, (s, x) -> s + x) / n"))
    df = df.withColumns(
        {
            "own": F.expr("aggregate(codes, 0d, (s, x) -> s + (x - m) * (x - m))"),
            "lag": F.expr("aggregate(zip_with(codes, next, (x, y) -> coalesce((x - m) * (y - m), 0d)), 0d, (s, x) -> s + x)"),
        }
    )
    df = df.withColumn("serial", F.when(F.col("own") > 0, (F.col("lag") / F.col("own") + 1 / (n - 1)) * F.sqrt(n - 1)).otherwise(F.sqrt(n)))
    total = F.pow(F.greatest("chi", F.lit(0.0)), 2) + F.pow("wald", 2) + F.pow("serial", 2)
    z = (F.pow(total / 3, F.lit(1 / 3)) - (1 - 2 / 27)) / (2 / 27) ** 0.5
    upper = F.lit(1.0) / (1 + F.exp(F.least(1.5976 * z + 0.07056 * z * z * z, F.lit(700.0))))
    scores, plain = {}, F.lit(1.0)
    for letters in (_L, "abcdef"):
        values, mean, spread_ = letter_scores(letters)
        found = F.transform(F.filter(F.split(F.lower("body"), ""), lambda c: c.between("a", letters[-1])), lambda c: F.element_at(F.array(*map(F.lit, values)), F.ascii(c) - 96))
        scores[letters] = (found, mean, spread_)
    hexes = F.col("encoding").isin("hex", "HEX")
    df = df.withColumn("scores", F.when(hexes, scores["abcdef"][0]).otherwise(scores[_L][0]))
    m = F.size("scores").cast("double")
    mean, spread_ = (F.when(hexes, scores["abcdef"][i]).otherwise(scores[_L][i]) for i in (1, 2))
    likely = F.aggregate("scores", F.lit(0.0), lambda acc, x: acc + x)
    plain = F.when(m > 0, _normal_tail((likely - m * mean) / (spread_ * F.sqrt(m)))).otherwise(1.0)
    df = df.withColumns({"bits": n * F.log2("k"), "p": upper, "plain": plain})
    return df.drop("scores", "body", "alphabet", "k", "codes", "above", "n1", "next", "turns", "m", "own", "lag")


def discovery_thresholds(tested: DataFrame, q: float) -> dict[int, int]:
    """For each band of lengths the least step of -log10 p from which candidates are reported, by Benjamini and Hochberg."""
    counted: dict[int, dict[int, int]] = {}
    for band, step, n in tested.groupBy("band", "step").count().collect():  # at most bands x steps rows
        counted.setdefault(band, {})[step] = n
    out = {}
    for band, steps in counted.items():
        total, seen, best = sum(steps.values()), 0, STEPS + 1
        for step in sorted(steps, reverse=True):
            seen += steps[step]
            if 10 ** (-step * PER_STEP) <= q * seen / total:
                best = step
        out[band] = best
    return out


def scan_secrets(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", q: float = 0.05, alpha: float = 0.001, min_bits: float = 66.0
) -> DataFrame:
    """One row per document: id, and arrays of (s, e) spans for each of assign, access, hex and random, in order of start.

    Candidates of fewer than ``min_bits`` bits are not considered.
    """
    scanned = written(scan(docs, id_col, text_col), "secret_spans")
    runs = scanned.select("id", "th", F.explode("runs").alias("r")).select("id", "th", "r.*")
    tested = battery(runs).where(F.col("bits") >= min_bits)
    band = F.lit(0)
    for edge in BANDS:
        band = band + F.when(F.col("n") >= edge, 1).otherwise(0)
    p = F.when(F.col("p") >= alpha, F.col("plain")).otherwise(1.0)
    step = F.least(F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) / PER_STEP), F.lit(STEPS)).cast("int")
    tested = written(tested.withColumns({"band": band.cast("int"), "step": step}), "tested_runs")
    limits = discovery_thresholds(tested, q)
    limit = F.lit(STEPS + 1)
    for b, least in limits.items():
        limit = F.when(F.col("band") == b, least).otherwise(limit)
    found = tested.where((F.col("step") >= limit) & (F.col("p") >= alpha))
    found = found.groupBy("id", "th").agg(F.sort_array(F.collect_set(F.struct("s", "e"))).alias("random"))
    a, b = scanned.alias("a"), found.alias("b")
    both = a.join(b, F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.th") == F.col("b.th")), "left")
    bare = [F.transform(f"a.{k}", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))).alias(k) for k in KINDS[:3]]
    none = F.array().cast("array<struct<s:int,e:int>>")
    return both.select(F.col("a.id").alias(id_col), *bare, F.coalesce("random", none).alias("random"))


def span_text(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the columns of spans, by start, then by kind in the given order, joined by commas."""

    def named(rank: int, kind: str) -> Column:
        def one(x: Column) -> Column:
            return F.struct(x["s"].alias("s"), F.lit(rank).alias("k"), x["e"].alias("e"), F.concat_ws(":", F.lit(kind), x["s"], x["e"]).alias("t"))

        return F.transform(kind, one)

    every = F.sort_array(F.concat(*(named(i, k) for i, k in enumerate(kinds))))
    return F.array_join(F.transform(every, lambda x: x["t"]), ",")
