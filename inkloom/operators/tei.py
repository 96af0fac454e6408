"""TEI XML to chunks, references and figure references.

Mixed content and nested divisions need a tree, so each document is parsed once in
an Arrow batch; what can be done on the parts afterwards is.  TEI is not
trusted: document type declarations are refused, and what can't be parsed gets
an error instead of failing the job.
"""

from __future__ import annotations

import re
import unicodedata
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkloom.operators.chunking import MAX_WORDS, MIN_WORDS, packed_paragraphs

_T = "{http://www.tei-c.org/ns/1.0}"
_ID = "{http://www.w3.org/XML/1998/namespace}id"


@dataclass(frozen=True)
class TeiOptions:
    """What goes into the chunks; skip holds normalised headings."""

    max_words: int = MAX_WORDS
    min_words: int = MIN_WORDS
    authors: bool = True
    title: bool = True
    abstract: bool = True
    references: bool = True
    back_matter: bool = True
    skip: frozenset = field(default_factory=frozenset)


def _root(xml: str) -> ET.Element:
    if "<!DOCTYPE" in xml or "<!ENTITY" in xml:
        raise ValueError("document type declarations are refused")
    return ET.fromstring(xml.encode("utf-8"))


def _strings(el: ET.Element) -> Iterator[str]:
    """Text in order, without what is inside figures and notes."""
    todo: list[ET.Element | str] = [el]
    while todo:
        top = todo.pop()
        if isinstance(top, str):
            yield top
            continue
        after: list[ET.Element | str] = []
        for child in top:
            if child.tag not in (f"{_T}figure", f"{_T}note"):
                after.append(child)
            if child.tail:
                after.append(child.tail)
        todo.extend(reversed(after))
        if top.text:
            yield top.text


def text_of(el: ET.Element | None) -> str:
    if el is None:
        return ""
    return " ".join(unicodedata.normalize("NFKC", " ".join(_strings(el))).split())


def author_text(author: ET.Element) -> str:
    person = author.find(f"{_T}persName")
    places = []
    for place in author.findall(f"{_T}affiliation"):
        inside = ", ".join(filter(None, map(text_of, place.findall(f"{_T}orgName"))))
        places.append(inside or text_of(place))
    places = [p for p in places if p]
    mail = text_of(author.find(f"{_T}email"))
    return " ".join(filter(None, [text_of(author if person is None else person), f"({'; '.join(places)})" if places else "", f"<{mail}>" if mail else ""]))


def reference_text(entry: ET.Element) -> str:
    article, volume = entry.find(f"{_T}analytic"), entry.find(f"{_T}monogr")
    titles = [x.find(f"{_T}title") for x in (article, volume) if x is not None]
    title = next((t for t in titles if t is not None), None)
    source = article if article is not None else volume
    names = []
    for author in source.findall(f"{_T}author") if source is not None else ():
        person = author.find(f"{_T}persName")
        names.append(text_of(author if person is None else person))
    venue = volume.find(f"{_T}title") if volume is not None else None
    when = volume.find(f"{_T}imprint/{_T}date") if volume is not None else None
    date = "" if when is None else when.get("when") or text_of(when)
    parts = [", ".join(filter(None, names)), text_of(title), "" if venue is None or venue is title else text_of(venue), f"({date})" if date else ""]
    return ". ".join(filter(None, parts)).strip()


def _division(div: ET.Element, above: str, opt: TeiOptions) -> Iterator[tuple[str, int, str]]:
    heading = text_of(div.find(f"{_T}head")) or above
    if re.sub(r"^[\d.]+\s*", "", heading).strip().lower() in opt.skip:
        return
    own = [t for t in map(text_of, div.findall(f"{_T}p")) if t]
    for i, chunk in enumerate(packed_paragraphs(own, opt.max_words, opt.min_words)):
        yield heading, i, chunk
    for inner in div.findall(f"{_T}div"):
        yield from _division(inner, heading, opt)


def chunks_of(xml: str, opt: TeiOptions = TeiOptions()) -> list[tuple[str, int, str]]:
    """(section, chunk, content) of a document: authors, title, abstract, body, references, other back matter."""
    root = _root(xml)
    out: list[tuple[str, int, str]] = []

    def listed(section: str, lines: list[str], least: int) -> None:
        out.extend((section, i, c) for i, c in enumerate(packed_paragraphs([x for x in lines if x], opt.max_words, least)))

    if opt.authors:
        described = f".//{_T}sourceDesc/{_T}biblStruct/{_T}"
        listed("authors", [author_text(a) for a in root.findall(f"{described}analytic/{_T}author") or root.findall(f"{described}monogr/{_T}author")], 1)
    if opt.title and (title := text_of(root.find(f".//{_T}titleStmt/{_T}title"))):
        out.append(("title", 0, title))
    if opt.abstract and (abstract := root.find(f".//{_T}profileDesc/{_T}abstract")) is not None:
        listed("abstract", [text_of(p) for p in abstract.iter(f"{_T}p")], opt.min_words)
    for div in root.findall(f".//{_T}text/{_T}body[1]/{_T}div"):
        out.extend(_division(div, "body", opt))
    if opt.references and (listing := root.find(f".//{_T}text/{_T}back//{_T}listBibl")) is not None:
        listed("references", [reference_text(b) for b in listing.findall(f"{_T}biblStruct")], 1)
    if opt.back_matter and (back := root.find(f".//{_T}text/{_T}back")) is not None:
        for div in back.findall(f"{_T}div"):
            if div.find(f"{_T}listBibl") is None and div.get("type") != "references":
                out.extend(_division(div, "body", opt))
    return out


def parse_tei_to_chunks(xml: str, **options) -> list[dict]:
    """Chunks of one document as dictionaries."""
    return [dict(zip(("section", "chunk", "content"), c, strict=True)) for c in chunks_of(xml, TeiOptions(**options))]


def tei_chunks(docs: DataFrame, opt: TeiOptions = TeiOptions(), key: str = "doc_id", xml: str = "tei_xml") -> DataFrame:
    """(key, ord, section, chunk, content, error): a row for each chunk, or one with the error; `ord` keeps (section, chunk) apart where nested sections share a heading."""

    @F.pandas_udf("struct<chunks:array<struct<section:string,chunk:int,content:string>>,error:string>")
    def parse(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            try:
                rows.append(([dict(zip(("section", "chunk", "content"), c, strict=True)) for c in chunks_of(t or "", opt)], None))
            except (ET.ParseError, ValueError) as e:
                rows.append(([], str(e)))
        return pd.DataFrame(rows, columns=["chunks", "error"])

    parsed = docs.select(key, parse(xml).alias("p"))
    return parsed.select(key, F.posexplode_outer("p.chunks").alias("ord", "c"), F.col("p.error").alias("error")).where("c is not null or error is not null").select(key, "ord", "c.section", "c.chunk", "c.content", "error")


_CAPTION = re.compile(r"^((?:Figure|Fig\.|Table)\s*\d+)\s*[:.]\s*(.*)", re.IGNORECASE | re.DOTALL)


def _plain(el: ET.Element | None) -> str | None:
    """Text of an element for the fusion, None if there is none."""
    return None if el is None else "".join(el.itertext()).strip() or None


def document_of(xml: str) -> dict:
    """Title, abstract, authors, sections, references and figure references of a document.

    Figure references come in four passes, whose order breaks ties later: figures,
    captions outside of figures, inline references to figures and to tables.
    """
    root = _root(xml)
    find = lambda el, path: el.find(path.replace("t:", _T))
    name = lambda p: {"first_name": _plain(find(p, "t:persName/t:forename")), "last_name": _plain(find(p, "t:persName/t:surname"))}
    abstract = find(root, ".//t:abstract")
    body = find(root, ".//t:body")
    sections = []
    for div in body.findall(f"{_T}div") if body is not None else ():
        texts = [" ".join(p.itertext()).strip() for p in div.findall(f"{_T}p")]
        sections.append({"heading": _plain(div.find(f"{_T}head")), "text": "\n\n".join(filter(None, texts))})
    references = []
    listing = find(root, ".//t:listBibl")
    for entry in listing.findall(f"{_T}biblStruct") if listing is not None else ():
        titled = find(entry, ".//t:title[@level='a']")
        if titled is None or not len(titled):  # an article title that is plain text is passed over for the first title
            titled = find(entry, ".//t:title")
        date = find(entry, ".//t:date")
        references.append(
            {
                "ref_id": entry.get(_ID), "title": _plain(titled), "authors": [name(p) for p in entry.findall(f".//{_T}author")], "year": None if date is None else date.get("when"),
                "journal": _plain(find(entry, ".//t:title[@level='j']")), "volume": _plain(find(entry, ".//t:biblScope[@unit='volume']")),
                "pages": _plain(find(entry, ".//t:biblScope[@unit='page']")), "doi": _plain(find(entry, ".//t:idno[@type='DOI']")), "raw_text": " ".join(entry.itertext()).strip() or None,
            }
        )
    figures = [{"fig_id": f.get(_ID), "label": _plain(f.find(f"{_T}head")), "caption": _plain(f.find(f"{_T}figDesc")), "coords": f.get("coords")} for f in root.iter(f"{_T}figure")]
    if body is not None:
        inside = {id(x) for f in body.iter(f"{_T}figure") for x in f.iter()}
        for el in body.iter():
            if id(el) not in inside and el.tag in (f"{_T}s", f"{_T}head") and (m := _CAPTION.match(_plain(el) or "")):
                figures.append({"fig_id": None, "label": " ".join(m[1].split()), "caption": m[2].strip(), "coords": el.get("coords")})
    for kind, label in (("figure", "Figure"), ("table", "Table")):
        for ref in root.iter(f"{_T}ref"):
            if ref.get("type") == kind and (number := _plain(ref)):
                figures.append({"fig_id": ref.get(_ID), "label": f"{label} {number}", "caption": None, "coords": ref.get("coords")})
    authors = [name(p) | {"affiliation": _plain(find(p, ".//t:affiliation/t:orgName")), "email": _plain(find(p, ".//t:email"))} for d in root.iter(f"{_T}sourceDesc") for p in d.iter(f"{_T}author")]
    return {"title": _plain(find(root, ".//t:titleStmt/t:title")), "abstract": None if abstract is None else " ".join(abstract.itertext()).strip() or None, "authors": authors, "sections": sections, "references": references, "figure_refs": figures}


_PERSON = "first_name:string,last_name:string"
DOCUMENT_TYPE = (
    f"struct<title:string,abstract:string,authors:array<struct<{_PERSON},affiliation:string,email:string>>,sections:array<struct<heading:string,text:string>>,"
    f"references:array<struct<ref_id:string,title:string,authors:array<struct<{_PERSON}>>,year:string,journal:string,volume:string,pages:string,doi:string,raw_text:string>>,"
    "figure_refs:array<struct<fig_id:string,label:string,caption:string,coords:string>>,error:string>"
)


def tei_document(xml: Column) -> Column:
    """DOCUMENT_TYPE of a column of TEI; `coords` stay text for vectors.coords_box."""

    @F.pandas_udf(DOCUMENT_TYPE)
    def parse(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            try:
                rows.append(document_of(t or "") | {"error": None})
            except (ET.ParseError, ValueError) as e:
                rows.append({"title": None, "abstract": None, "authors": [], "sections": [], "references": [], "figure_refs": [], "error": str(e)})
        return pd.DataFrame(rows, columns=["title", "abstract", "authors", "sections", "references", "figure_refs", "error"])

    return parse(xml)
