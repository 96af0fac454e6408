"""Column functions on text, with the white space, word and line rules of Python strings."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Inside of a regex class: what Python's str.split and \s take for white space.
WS = r"\t\n\x0B\f\r\x1c-\x1f \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_S = f"[{WS}]"
#: Inside of a class: all other characters, the commonest first, so that most are told at once.
NOT_WS = r"!-\x84\x86-\x9f\xa1-\u167f\u1681-\u1fff\u200b-\u2027\u202a-\u202e\u2030-\u205e\u2060-\u2fff\u3001-\x{10ffff}\x00-\x08\x0e-\x1b"
_LINE_END = r"[\n\r\x0B\f\x1c-\x1e\x85\u2028\u2029]"
_IN_LINE = r"[\t\x1f \xa0\u1680\u2000-\u200a\u202f\u205f\u3000]"
#: The same characters one by one.
_WS_CHARS = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"

# What counts as noise in the text of a paper.
HYPHEN_BREAK = r"(?U)(\w)-\n(\w)"
REFERENCES = rf"(?iu)\n{_S}*(?:References|Bibliography|Works{_S}+Cited){_S}*\n"
ACKNOWLEDGEMENTS = rf"(?iu)\n{_S}*Acknowledge?ments?{_S}*\n"
ARXIV_HEADER = rf"(?iuU)arXiv:\d{{4}}\.\d{{4,5}}v\d+{_S}+\[[\w.]+\]{_S}+\d{{1,2}}{_S}+\w+{_S}+\d{{4}}"
PAGE_NUMBER = rf"(?mdU)^{_S}*(?:Page{_S}*)?\d{{1,4}}{_S}*$"
CITATION = rf"(?U)\[\d[\d,{WS}–\-]*\]|\([A-Z][a-z]+(?:{_S}+et{_S}+al\.?)?,{_S}*\d{{4}}[a-z]?(?:;{_S}*[A-Z][a-z]+(?:{_S}+et{_S}+al\.?)?,{_S}*\d{{4}}[a-z]?)*\)"
CAPTION = rf"(?iuU)(?:Figure|Fig\.|Table|Algorithm|Listing){_S}+\d+[.:]"
LATEX = r"\\[a-zA-Z]+\{[^}]*\}|\\[a-zA-Z]+"
MIN_CHARS = 100
CHARS_PER_TOKEN = 4


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def drop(text: Column, pattern: str) -> Column:
    if pattern not in _NEEDS:
        return F.regexp_replace(text, pattern, "")
    return _bound(text, lambda x: F.when(_NEEDS[pattern](x), F.regexp_replace(x, pattern, "")).otherwise(x))


#: What a text must hold for a pattern to match at all; quicker to look for than the pattern.
_NEEDS = {
    ARXIV_HEADER: lambda text: F.contains(text, F.lit("[")) & F.contains(text, F.lit(":")),
    CITATION: lambda text: F.contains(text, F.lit("[")) | F.contains(text, F.lit("(")),
    CAPTION: lambda text: F.regexp_like(text, F.lit(r"(?U)[.:](?<=\d[.:])")),
    LATEX: lambda text: F.contains(text, F.lit("\\")),
}


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(_WS_CHARS))


def squeeze(text: Column) -> Column:
    """Runs of white space become one blank; none at the ends."""
    return strip(F.regexp_replace(text, rf"{_S}+", " "))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"[{NOT_WS}]+"), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(rf"[{NOT_WS}]+"))


def nfkc(text: Column) -> Column:
    """Compatibility normal form; Spark has none of its own.  ASCII is its own form and does not go to Python."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None or unicodedata.is_normalized("NFKC", t) else unicodedata.normalize("NFKC", t))

    return F.coalesce(run(F.when(F.octet_length(text) != F.length(text), text)), text)


def join_hyphens(text: Column) -> Column:
    return _bound(text, lambda x: F.when(F.contains(x, F.lit("-\n")), F.regexp_replace(x, HYPHEN_BREAK, "$1$2")).otherwise(x))


def _before(text: Column, pattern: str) -> Column:
    return F.get(F.split(text, pattern, 2), F.lit(0))


def cut_references(text: Column) -> Column:
    return _before(text, REFERENCES)


def cut_acknowledgements(text: Column) -> Column:
    return _before(text, ACKNOWLEDGEMENTS)


def squeeze_blanks(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"[ \t]{2,}", " "), r"\n{3,}", "\n\n")


def tidy_lines(text: Column) -> Column:
    """Lines without white space at their ends; empty ones go."""

    def tidied(x: Column) -> Column:
        plain = F.array_join(F.filter(F.transform(F.split(x, "\n"), strip), lambda line: line != ""), "\n")
        # white space with any kind of line end in it becomes one line feed
        other = strip(F.regexp_replace(x, rf"{_IN_LINE}*{_LINE_END}{_S}*", "\n"))
        return F.when(F.regexp_like(x, F.lit(rf"(?=[^ -~\n]){_LINE_END}")), other).otherwise(plain)

    return _bound(text, tidied)


def clean(text: Column, normalise: bool = True) -> Column:
    """All cleaning steps in their order; null becomes empty.  Without `normalise` it stays inside code generation."""
    out = F.coalesce(text, F.lit(""))
    out = nfkc(out) if normalise else out
    out = cut_acknowledgements(cut_references(join_hyphens(out)))
    for pattern in (ARXIV_HEADER, PAGE_NUMBER, CITATION, CAPTION, LATEX):
        out = drop(out, pattern)
    return tidy_lines(squeeze_blanks(out))


def truncate_tokens(text: Column, tokens: int, chars: int = CHARS_PER_TOKEN) -> Column:
    """At most tokens * chars characters, back to the last '. ' if that is beyond four fifths."""
    most = tokens * chars
    cut = F.substring(text, 1, most)
    last = F.length(cut) - F.instr(F.reverse(cut), " .") - 1
    return F.when(F.length(text) <= most, text).when((F.instr(F.reverse(cut), " .") > 0) & (last > most * 0.8), F.substring(cut, F.lit(1), last + 1)).otherwise(cut)


def token_estimate(text: Column) -> Column:
    return F.floor(F.length(text) / CHARS_PER_TOKEN).cast("int")


def content_hash(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def strip_version(arxiv_id: Column) -> Column:
    """What stands before the last 'v', if there is one."""
    return F.when(F.instr(arxiv_id, "v") > 0, F.regexp_extract(arxiv_id, r"(?s)^(.*)v", 1)).otherwise(arxiv_id)


def entry_id(url: Column) -> Column:
    return F.try_element_at(F.split(url, "/"), F.lit(-1))


def canonical_id(url: Column) -> Column:
    """Identifier without version that keeps the archive of old-style ids."""
    tail = F.regexp_extract(url, r"(?:.*/(?:abs|pdf)/)?(.*)$", 1)
    return F.regexp_replace(tail, r"v\d+$", "")


def section_key(heading: Column) -> Column:
    """Heading without leading numbers, for the skip list alone."""
    return F.lower(strip(F.regexp_replace(heading, rf"^[\d.]+{_S}*", "")))


def full_name(first: Column, last: Column) -> Column:
    return F.concat_ws(" ", F.nullif(first, F.lit("")), F.nullif(last, F.lit("")))


def author_line(name: Column, affiliations: Column, email: Column) -> Column:
    """Name (affiliation; affiliation) <email>, without what is missing."""
    places = F.filter(affiliations, lambda a: a.isNotNull() & (a != ""))
    return F.concat_ws(" ", F.nullif(name, F.lit("")), F.when(F.size(places) > 0, F.concat(F.lit("("), F.array_join(places, "; "), F.lit(")"))), F.when(email != "", F.concat(F.lit("<"), email, F.lit(">"))))


def reference_line(authors: Column, title: Column, venue: Column, date: Column) -> Column:
    """authors. title. venue. (date), without what is missing."""
    return F.concat_ws(". ", F.nullif(F.array_join(authors, ", "), F.lit("")), F.nullif(title, F.lit("")), F.nullif(venue, F.lit("")), F.when(date != "", F.concat(F.lit("("), date, F.lit(")"))))


#: Words that say nothing about a caption.
CAPTION_STOPS = ["figure", "fig", "table", "tab", "the", "a", "an", "of", "in", "and", "is", "are", "for"]


def caption_words(text: Column) -> Column:
    found = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"(?U)(\w+)"), F.lit(1)))
    return F.array_except(found, F.array(*map(F.lit, CAPTION_STOPS)))


def caption_similarity(a: Column, b: Column) -> Column:
    """Jaccard similarity of caption words; 0 if either has none."""
    x, y = caption_words(a), caption_words(b)
    return F.when((F.size(x) > 0) & (F.size(y) > 0), F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))).otherwise(F.lit(0.0))


def ordinals(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(?U)(\d+)"), F.lit(1))


def caption_parts(text: Column) -> Column:
    """struct(label, caption) of a text that starts like a caption, else null."""
    pattern = rf"(?isuU)^((?:Figure|Fig\.|Table){_S}*\d+){_S}*[:.]{_S}*(.*)"
    return F.when(F.regexp_like(text, F.lit(pattern)), F.struct(squeeze(F.regexp_extract(text, pattern, 1)).alias("label"), strip(F.regexp_extract(text, pattern, 2)).alias("caption")))


def image_link(caption: Column, path: Column) -> Column:
    return F.format_string("![%s](%s) %s", caption, path, caption)


def model_text(title: Column, content: Column) -> Column:
    """Input of a title-aware embedding model."""
    return F.when(F.coalesce(title, F.lit("")) != "", F.concat(title, F.lit(" [SEP] "), content)).otherwise(content)


def one_line(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit(" "))


def trigrams(text: Column) -> Column:
    """Distinct three-letter strings of the lower-cased words, two blanks before and one after each."""
    padded = F.transform(F.regexp_extract_all(F.lower(text), F.lit(r"([a-z0-9]+)"), F.lit(1)), lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    grams = F.transform(padded, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substring(w, i, F.lit(3))))
    return F.array_distinct(F.flatten(grams))


def trigram_similarity(a: Column, b: Column) -> Column:
    x, y = trigrams(a), trigrams(b)
    both = F.size(F.array_union(x, y))
    return F.when(both > 0, F.size(F.array_intersect(x, y)) / both).otherwise(F.lit(0.0))
