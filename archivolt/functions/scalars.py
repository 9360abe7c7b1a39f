"""Scalar functions: labels, numbers, keys, digests, boxes and probabilities.

Built-in expressions wherever they can express the semantics; vectorised UDFs only for Unicode normalisation, collation,
string similarity and exact tests. UDFs travel by value, so workers need no installed copy of the package.
"""

from __future__ import annotations

import math
import sys
import unicodedata
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from archivolt.operators.tasks import bounded_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: File-name endings of per-document files; the longest that fits is cut off.
KNOWN_SUFFIXES = tuple(
    ".document.json .categories.json .teitok.xml .alto.xml .udpipe.conllu .conllu .xml .json .md .csv .txt .pdf .docx .docm .dotx .odt .ods .odp"
    " .xlsx .xlsm .pptx .pptm .epub .rtf .html .htm .xhtml .hocr .tei .jsonl .ndjson .tsv .tab .markdown".split()
)
#: The letters of the Czech alphabet in order, and letters that differ from another by an accent only.
CZECH_LETTERS = "a b c č d e f g h ch i j k l m n o p q r ř s š t u v w x y z ž".split()
CZECH_ACCENTS = {"á": "a", "é": "e", "ě": "e", "í": "i", "ó": "o", "ú": "u", "ů": "u", "ý": "y", "ď": "d", "ť": "t", "ň": "n"}


def _norm(value: str | None) -> str:
    if not value:
        return ""
    return " ".join(unicodedata.normalize("NFC", value).replace("\xa0", " ").casefold().split())


@F.pandas_udf(T.StringType())
def _norm_labels(value: pd.Series) -> pd.Series:
    return value.map(_norm, na_action=None)


def norm_label(value: Column | str) -> Column:
    """NFC, no-break spaces as spaces, case folded, white space collapsed; null gives the empty string."""
    bounded_batches(SparkSession.active())
    return _norm_labels(value)


def _latin_bases() -> tuple[str, str]:
    """Accented Latin letters beyond the Czech alphabet, and the letters that they are without accents."""
    own = set(CZECH_LETTERS) | set(CZECH_ACCENTS)
    pairs = [(chr(i), unicodedata.normalize("NFKD", chr(i))[0]) for i in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00))]
    pairs = [(c, b) for c, b in pairs if c != b and c not in own]
    return "".join(c for c, _ in pairs), "".join(b for _, b in pairs)


#: Private code points: of the alphabet's first letter, before what is no letter, and for a letter with an accent.
_FIRST_LETTER, _NO_LETTER, _ACCENTED = 0xE000, "\uf8ff", "\ue800"


def czech_order(label: Column) -> Column:
    """Sort key by Czech rules: "ch" is a letter and so are letters with a caron that the alphabet lists; other accents break
    ties only, then the label itself; what is no letter of the alphabet comes after it.

    Letters become code points in the alphabet's order, so that strings compare as words do.
    """
    point = {c: chr(_FIRST_LETTER + i) for i, c in enumerate(CZECH_LETTERS)}
    low, accents = F.lower(label), "".join(CZECH_ACCENTS)
    single = [c for c in CZECH_LETTERS if len(c) == 1]
    letters = F.translate(F.replace(low, F.lit("ch"), F.lit(point["ch"])), "".join(single) + accents, "".join(point[c] for c in [*single, *CZECH_ACCENTS.values()]))
    last = chr(_FIRST_LETTER + len(CZECH_LETTERS) - 1)
    words = F.translate(F.regexp_replace(letters, f"(?s)([^{chr(_FIRST_LETTER)}-{last}])", f"{_NO_LETTER}$1"), *_latin_bases())
    return F.concat(words, F.lit("\x00"), F.translate(low, accents, _ACCENTED * len(accents)), F.lit("\x00"), label)


def similarity(a: str | None, b: str | None) -> float:
    """Larger of the character ratio and the word overlap of two normalised glosses; symmetric."""
    x, y = sorted((_norm(a), _norm(b)))
    if x == y:
        return 1.0
    left, right = set(x.split()), set(y.split())
    words = len(left & right) / len(left | right) if left or right else 0.0
    return max(SequenceMatcher(None, x, y).ratio(), words)


@F.pandas_udf(T.DoubleType())
def _similarities(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([similarity(x, y) for x, y in zip(a, b, strict=True)], dtype=float)


def gloss_similarity(a: Column | str, b: Column | str) -> Column:
    """See ``similarity``."""
    bounded_batches(SparkSession.active())
    return _similarities(a, b)


#: Nodes and weights of Gauss and Legendre on [0, 1], which integrate polynomials up to a degree of 127 exactly.
_NODES = [((x + 1) / 2, w / 2) for x, w in zip(*(v.tolist() for v in np.polynomial.legendre.leggauss(64)), strict=True)]
#: How far Stirling's formula is from log n!, for n below 16.
_STIRLING = [0.0, *(math.lgamma(n + 1) - (n + 0.5) * math.log(n) + n - 0.5 * math.log(2 * math.pi) for n in range(1, 16))]


def _stirling_error(n: Column) -> Column:
    r = 1 / n
    series = r * (1 / 12 - r * r * (1 / 360 - r * r * (1 / 1260 - r * r * (1 / 1680 - r * r / 1188))))
    return F.when(n < 16, F.get(F.array(*map(F.lit, _STIRLING)), n.cast("int"))).otherwise(series)


def lower_half_tail(n: Column, k: Column) -> Column:
    """P(X <= k) of a binomial X of n fair trials, for 0 <= 2 k < n, as doubles; n may have any size.

    It is (n - k) times the probability of k, times the integral of (1 - u)^(n - k - 1) (1 + u)^k over [0, 1] (the regularised
    incomplete beta function at a half). The integrand falls from 1; it is integrated by fixed nodes to where it is below
    e^-45. The probability of k is by its deviance, so that large terms don't cancel.
    """
    e = (n - 2 * k) / n
    deviance = n / 2 * ((1 + e) * F.log1p(e) + (1 - e) * F.log1p(-e))
    log_p = _stirling_error(n) - _stirling_error(k) - _stirling_error(n - k) - deviance + F.log(n / (2 * math.pi * k * (n - k))) / 2
    d, m = n - 2 * k - 1, F.greatest(n - 1, F.lit(1.0))
    upto = F.least(F.lit(1.0), 90 / (d + F.sqrt(d * d + 90 * m)))  # where d u + m u^2 / 2 is 45
    nodes = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(w).alias("w")) for x, w in _NODES))
    integral = F.aggregate(
        nodes, F.lit(0.0), lambda s, t: s + t["w"] * F.exp((n - k - 1) * F.log1p(-F.least(upto * t["x"], F.lit(1 - 1e-16))) + k * F.log1p(upto * t["x"]))
    )
    return F.when(k == 0, F.pow(F.lit(2.0), -n)).otherwise(F.exp(log_p) * (n - k) * upto * integral)


def mcnemar_exact(b: str, c: str) -> Column:
    """Two-sided exact binomial test of two discordant counts, in built-in expressions; 1 without any, null where one is."""
    x, y = F.col(b).cast("double"), F.col(c).cast("double")
    n, k = x + y, F.least(x, y)
    both = F.col(b).isNotNull() & F.col(c).isNotNull()
    return F.when(both, F.when(2 * k >= n, F.lit(1.0)).otherwise(F.least(F.lit(1.0), 2 * lower_half_tail(n, k))))


def safe_double(value: Column) -> Column:
    """A number, or null where the text is blank or none: missing quality is unknown, not zero."""
    return F.nullif(F.trim(value.cast("string")), F.lit("")).try_cast("double")


def safe_int(value: Column, default: int = 0) -> Column:
    """An integer, or the default."""
    return F.coalesce(value.try_cast("int"), F.lit(default))


def words_of(text: Column) -> Column:
    """Words between white space, Unicode's included; none for a blank text."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"(?U)\s+"))


def letter_ratio(text: Column) -> Column:
    """Share of letters among the characters; 0 for an empty text."""
    n = F.length(text)
    return F.when(n > 0, F.length(F.regexp_replace(text, r"[^\p{L}]", "")) / n).otherwise(F.lit(0.0))


def stems(text: Column, length: int = 5, least: int = 3) -> Column:
    """Distinct first letters of folded words of three letters or more."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(?U)(\w+)"), F.lit(1))
    return F.array_distinct(F.transform(F.filter(words, lambda w: F.length(w) >= least), lambda w: F.substring(w, 1, length)))


def doc_id_of(path: Column, suffixes: tuple[str, ...] = KNOWN_SUFFIXES) -> Column:
    """Document id of a file name: the name without its longest known ending, else up to the first dot."""
    name = F.regexp_extract(path, r"([^/\\]*)$", 1)
    out = F.split_part(name, F.lit("."), F.lit(1))
    for s in sorted(suffixes, key=len):
        out = F.when(F.lower(name).endswith(s), name.substr(F.lit(1), F.length(name) - len(s))).otherwise(out)
    return out


def keyword_entries(pairs: Column, method: str) -> Column:
    """Array of (phrase, score) to array of (keyword, score, method, rank)."""
    return F.transform(
        pairs, lambda p, i: F.struct(p["phrase"].alias("keyword"), p["score"].alias("score"), F.lit(method).alias("method"), (i + 1).alias("rank"))
    )


def key_text(value: Column, kind: str) -> Column:
    """Text under which a merge key is compared: whole floats as integers, null and booleans as JSON words."""
    if kind == "boolean":
        text = value.cast("string")
    elif kind in ("double", "float"):
        text = F.when(value == F.floor(value), F.floor(value).cast("string")).otherwise(value.cast("string"))
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit("null"))


def stable_unit(*parts: Column) -> Column:
    """Deterministic number in [0, 1) from the first 64 bits of the parts' SHA-256."""
    digest = F.sha2(F.concat_ws("\x1f", *(p.cast("string") for p in parts)), 256)
    high, low = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double"), F.conv(F.substring(digest, 9, 8), 16, 10).cast("double")
    return high / 2.0**32 + low / 2.0**64


def lane(probability: Column, accept_at: float, review_below: float) -> Column:
    """accept, escalate or review by two thresholds."""
    if review_below > accept_at:
        raise ValueError("review_below must not exceed accept_at")
    return F.when(probability >= accept_at, "accept").when(probability < review_below, "review").otherwise("escalate")


def ece_bin(confidence: Column, bins: int) -> Column:
    """Equal-width bin, upper edges inclusive; 0 falls in the first."""
    return F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.ceil(confidence * bins) - 1)).cast("int")


def scale_box(box: Column, sx: float, sy: float, dx: float = 0.0, dy: float = 0.0) -> Column:
    """Four coordinates scaled, moved and rounded (halves to even)."""
    return F.transform(box, lambda v, i: F.bround(F.when(i % 2 == 0, v * sx + dx).otherwise(v * sy + dy), 0).cast("int"))


def units_per_inch(unit: Column) -> Column:
    """Units of a page description in one inch: tenths of millimetres, 1/1200 inches; null for pixels."""
    return F.when(F.lower(unit) == "mm10", F.lit(254.0)).when(F.lower(unit) == "inch1200", F.lit(1200.0))


def normalise_licence(name: Column, aliases: dict[str, str]) -> Column:
    """Canonical licence name by its folded spelling; unknown names stay."""
    table = F.create_map(*(F.lit(x) for kv in aliases.items() for x in kv))
    return F.coalesce(F.get(F.array(table[F.lower(F.trim(name))]), F.lit(0)), name)


def content_digest(content: Column, bits: int = 256) -> Column:
    """SHA-2 of a text or of bytes, in lower-case hexadecimal."""
    return F.sha2(content, bits)


def canonical_json(entries: Column) -> Column:
    """A map's JSON with its keys in order and no spaces, so that equal maps have equal digests."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(entries))))
