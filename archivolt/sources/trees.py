"""Readers of tree-shaped files: annotated XML documents, harvested XML pages and label trees.

Mixed content and ordered state need Python; each file is one row, so it bounds a task. Document types with a DTD or entities
are refused.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator
from typing import Any
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from archivolt.operators.tasks import bounded_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BROKEN = re.compile(r"</name\s*(?=<)")


def parse_xml(text: str) -> ElementTree.Element:
    """Root of a document; a DTD or an entity declaration is refused, one known broken close tag is repaired."""
    if re.search(r"<!DOCTYPE|<!ENTITY", text):
        raise ValueError("document types and entities are refused")
    return ElementTree.fromstring(_BROKEN.sub("</name>", text).encode())


def _name(e: ElementTree.Element) -> str:
    return e.tag.rsplit("}", 1)[-1]


#: Elements that are blocks of text, and whose end also ends a line.
BLOCK_TAGS = frozenset("p head ab item cell l note figDesc".split())
_JOINED = re.compile(r"\s+")


def _walk(root: ElementTree.Element) -> Iterator[tuple[str, ElementTree.Element]]:
    """(start or end, element) in document order, without recursion, so any depth will do; headers are left out."""
    stack: list[tuple[ElementTree.Element, bool]] = [(root, False)]
    while stack:
        e, ends = stack.pop()
        if ends:
            yield "end", e
        elif _name(e) != "teiHeader":
            yield "start", e
            stack.append((e, True))
            stack.extend((child, False) for child in reversed(e))


class Place:
    """Page and line while a document is read: the label as it stands, a number, an index from 1, and the line."""

    def __init__(self) -> None:
        self.label, self.number, self.index, self.breaks = "", 1, 1, 0
        self.seen = self.written = self.above = False

    def page(self, e: ElementTree.Element) -> None:
        """A page break; labels that are no number advance the count, and the first one is page 1."""
        if self.seen or self.written:
            self.index += 1
        self.label = (e.get("n") or "").strip()
        self.number = int(self.label) if re.fullmatch(r"[+-]?\d+", self.label) else self.number + 1 if self.seen else 1
        self.seen, self.breaks, self.above = True, 0, False

    def content(self) -> None:
        """Text stands here; text before a page's first line break is a line of its own."""
        self.written = True
        if not self.breaks:
            self.above = True

    @property
    def line(self) -> int:
        return max(1, self.breaks + self.above)

    def row(self, text: str, line: int | None = None) -> tuple[str, int, str, int]:
        return str(self.number), self.line if line is None else line, text, self.index


def _spaced(tokens: list[ElementTree.Element]) -> str:
    """Tokens with their spacing: a space after each but those that join the next."""
    parts = []
    for t in tokens:
        text = "".join(t.itertext()).strip() or t.get("form", "")
        parts += [text, "" if t.get("join") == "right" or "SpaceAfter=No" in (t.get("misc") or "") else " "]
    return "".join(parts).strip()


def _sentence(e: ElementTree.Element) -> str:
    """A sentence's own text, else its tokens with their spacing, else all that stands in it, also between tokens."""
    tokens = [t for t in e.iter() if _name(t) == "tok"]
    whole = _JOINED.sub("", "".join(e.itertext()))
    spaced = _spaced(tokens) if whole == _JOINED.sub("", "".join("".join(t.itertext()) for t in tokens)) else ""
    return e.get("text") or spaced or _JOINED.sub(" ", "".join(e.itertext())).strip()


def xml_rows(root: ElementTree.Element) -> Iterator[tuple[str, int, str, int]]:
    """(page, line, text, page index) in document order: sentences where there are any (one that goes over a page break has a
    row for each page), else lines of tokens, else leaf blocks.

    A page is its break's number, or one more than the last. Lines are counted from 1 in each page; text before a page's
    first line break is line 1.
    """
    names = {_name(e) for e in root.iter()}
    place = Place()
    if "s" in names:
        yield from _sentence_rows(root, place)
    elif "tok" in names:
        yield from _line_rows(root, place)
    else:
        yield from _block_rows(root, place)


def _sentence_rows(root: ElementTree.Element, place: Place) -> Iterator[tuple[str, int, str, int]]:
    inside, parts = None, []
    for kind, e in _walk(root):
        name = _name(e)
        if kind == "start" and name == "pb":
            place.page(e)
            if inside is not None:
                parts.append((place.row(""), []))
        elif kind == "start" and name == "lb":
            place.breaks += 1
        elif kind == "start" and name == "s" and inside is None:
            inside, parts = e, [(place.row(""), [])]
        elif kind == "start" and name == "tok":
            place.content()
            if inside is not None:
                at, tokens = parts[-1]
                parts[-1] = (at if tokens else place.row(""), [*tokens, e])
        elif kind == "end" and e is inside:
            full = [(at, tokens) for at, tokens in parts if tokens]
            shown = [(at, _spaced(tokens)) for at, tokens in full] if len(full) > 1 else [((full or parts)[0][0], _sentence(e))]
            for (page, line, _, index), text in shown:
                if text:
                    yield page, line, text, index
                    place.content()
            inside = None


def _line_rows(root: ElementTree.Element, place: Place) -> Iterator[tuple[str, int, str, int]]:
    tokens: list[ElementTree.Element] = []
    for kind, e in _walk(root):
        name = _name(e)
        if kind == "start" and name == "tok":
            tokens.append(e)
            place.content()
        elif (kind == "start" and name in ("pb", "lb")) or (kind == "end" and (name in BLOCK_TAGS or e is root)):
            if text := _spaced(tokens):
                yield place.row(text)
            tokens = []
            if name == "pb":
                place.page(e)
            elif name == "lb":
                place.breaks += 1


def _block_rows(root: ElementTree.Element, place: Place) -> Iterator[tuple[str, int, str, int]]:
    line = 0
    for kind, e in _walk(root):
        name = _name(e)
        if kind == "start" and name == "pb":
            place.page(e)
            line = 0
        elif kind == "start" and name in BLOCK_TAGS and not any(_name(d) in BLOCK_TAGS for d in e.iter() if d is not e):
            if text := _JOINED.sub(" ", "".join(e.itertext())).strip():
                line += 1
                yield place.row(text, line)
                place.content()


def xml_tokens(root: ElementTree.Element) -> Iterator[tuple[str, str, str]]:
    """(form, lemma, upos) of annotated tokens; words between spaces where nothing is annotated."""
    tokens = [e for e in root.iter() if _name(e) == "tok"]
    if not tokens:
        for word in " ".join("".join(root.itertext()).split()).split():
            yield word, "", ""
    for e in tokens:
        yield "".join(e.itertext()).strip() or e.get("form", ""), e.get("lemma", ""), e.get("upos", "")


#: Rows that a worker holds before it hands them on; a file's rows stay together, so the largest file bounds them.
PIECE_ROWS = 5_000


def _mapped(files: DataFrame, schema: str, rows) -> DataFrame:
    bounded_batches(files.sparkSession)
    columns = [part.split()[0] for part in schema.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for path, text in zip(pdf["path"], pdf["text"], strict=True):
                try:
                    out += [(path, i, *r, None) for i, r in enumerate(rows(text))]
                except (ValueError, TypeError, AttributeError, ElementTree.ParseError) as problem:
                    out.append((path, -1, *[None] * (len(columns) - 3), str(problem)))
                if len(out) >= PIECE_ROWS:
                    yield pd.DataFrame(out, columns=columns)
                    out = []
            yield pd.DataFrame(out, columns=columns)

    return files.select("path", "text").mapInPandas(run, schema)


def read_xml_rows(files: DataFrame) -> DataFrame:
    """(path, pos, page, line, text, page_index, problem); an unreadable file has one row with its problem."""
    schema = "path string, pos long, page string, line double, text string, page_index double, problem string"
    return _mapped(files, schema, lambda t: xml_rows(parse_xml(t)))


def read_xml_tokens(files: DataFrame) -> DataFrame:
    """(path, pos, form, lemma, upos, problem)."""
    return _mapped(files, "path string, pos long, form string, lemma string, upos string, problem string", lambda t: xml_tokens(parse_xml(t)))


def harvested(root: ElementTree.Element) -> Iterator[tuple[str, str, str, str]]:
    """(id, cs, en, token) of a saved page of a metadata harvest: identifier, Czech and English labels, the resumption token."""
    token = next(((e.text or "").strip() for e in root.iter() if _name(e) == "resumptionToken"), "")
    for record in (e for e in root.iter() if _name(e) == "record"):
        ident, labels = "", {}
        for e in record.iter():
            name = _name(e)
            if name in ("ident_cely", "identifier") and not ident:
                ident = (e.text or "").strip()
            elif name == "heslo" or name == "heslo_en":
                lang = "en" if name.endswith("_en") else e.get("{http://www.w3.org/XML/1998/namespace}lang", "cs")
                labels.setdefault(lang, (e.text or "").strip())
        yield ident, labels.get("cs", ""), labels.get("en", ""), token


def read_harvest(files: DataFrame) -> DataFrame:
    """Records of saved pages, the first of each id in page order: (path, pos, id, cs, en, token, problem)."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    rows = _mapped(files, "path string, pos long, id string, cs string, en string, token string, problem string", lambda t: harvested(parse_xml(t)))
    first = Window.partitionBy("id").orderBy("path", "pos")
    good = rows.where("problem is null").withColumn("k", F.row_number().over(first)).where("k = 1").drop("k")
    return good.unionByName(rows.where("problem is not null"))


def flatten_tree(tree: Any, children: str = "children") -> Iterator[tuple[str, str, str, list[str], str]]:
    """(id, cs, en, ancestors, sub) of a label tree, parents first; the first of equal ids wins; sub is the label at depth two."""
    seen: set[str] = set()
    stack: list[tuple[Any, list[str], str]] = [(n, [], "") for n in reversed(tree if isinstance(tree, list) else [tree])]
    while stack:
        node, above, sub = stack.pop()
        ident = str(node.get("id") or "").strip()
        if not ident:
            continue
        cs = str(node.get("cs") or node.get("cz") or "").strip()
        if cs and ident not in seen:
            seen.add(ident)
            yield ident, cs, str(node.get("en") or "").strip(), above, sub
        kids = [c for c in node.get(children) or [] if isinstance(c, dict)]
        for child in reversed(kids):
            stack.append((child, [*above, ident], sub if above else str(child.get("cs") or child.get("cz") or "").strip()))


def read_label_tree(files: DataFrame, children: str = "children") -> DataFrame:
    """(path, pos, id, cs, en, broader, sub, problem) of JSON label trees."""
    schema = "path string, pos long, id string, cs string, en string, broader array<string>, sub string, problem string"
    return _mapped(files, schema, lambda t: flatten_tree(json.loads(t), children))


def read_any(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sentences, lemmas) of annotated files of either kind, XML or CoNLL-U: (path, pos, text) and (path, pos, form, lemma).

    An unreadable file has no rows in either; its problem is in ``read_xml_rows``.
    """
    from pyspark.sql import functions as F

    from archivolt.sources import text_files

    kind = text_files.input_kind(F.col("path"), F.col("text"))
    xml, conllu = files.where(kind == "xml"), files.where(kind == "conllu")
    tokens = text_files.conllu_tokens(conllu.withColumn("path", F.col("path")))
    ids = conllu.select("path", text_files.doc_id_of(F.col("path")).alias("doc_id"))
    own = text_files.surface_sentences(tokens).join(ids, "doc_id").select("path", F.col("sent").cast("long").alias("pos"), "text")
    sentences = read_xml_rows(xml).where("problem is null").select("path", "pos", "text").union(own)
    words = tokens.join(ids, "doc_id").select("path", F.col("pos").cast("long").alias("pos"), "form", "lemma")
    return sentences, read_xml_tokens(xml).where("problem is null").select("path", "pos", "form", "lemma").union(words)
