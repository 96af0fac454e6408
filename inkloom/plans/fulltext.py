"""Queries over TEI, layout items, assets and feeds that are made from the tables within the plan."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from inkloom.functions import text as t
from inkloom.operators import embed, fusion, layout, lifecycle, tei, validate
from inkloom.plans import papers
from inkloom.plans.registry import query
from inkloom.sources import arxiv, files

_CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"
_INNER = "An inner part without a heading that has ten words or more"
_ANNEX = "What stands in the annex has ten words or more too"
_ABSTRACT = "The abstract has ten words or more and is about"


def _escaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(F.regexp_replace(text, _CONTROL, ""), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _joined(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _tei(read):
    """Documents as TEI: lines as paragraphs, with an author, an abstract, an inner division, references and an annex."""
    source, lang = F.col("source"), F.col("lang")
    body = F.array_join(F.transform(F.split("text", "\n"), lambda p: F.concat(F.lit("<p>"), _escaped(p), F.lit("</p>"))), "")
    xml = _joined(
        '<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><titleStmt><title level="a">On  ', source, "</title></titleStmt><sourceDesc><biblStruct><analytic><author><persName><forename>", lang,
        "</forename><surname>Doe</surname></persName><affiliation><orgName>", source, "</orgName></affiliation><email>x@y.org</email></author></analytic></biblStruct></sourceDesc></fileDesc><profileDesc><abstract><p>",
        f"{_ABSTRACT} ", source, "</p></abstract></profileDesc></teiHeader><text><body><div><head>1. Body</head>", body, f"<div><p>{_INNER} <note>gone</note>", lang,
        '</p></div></div><div><head>2 Acknowledgements</head><p>We thank all who have read this far and even beyond that.</p></div><figure xml:id="f0" coords="', F.col("doc_id").cast("string"),
        ',1,2,3,4"><head>Figure 7</head><figDesc>A figure on ', source, '</figDesc></figure><div><head>Table 9: of ', source, '</head><p>See <ref type="figure" xml:id="r1">3</ref> and <ref type="table">4</ref>.</p></div></body>',
        '<back><div type="references"><listBibl><biblStruct xml:id="b0"><analytic><title level="a">', source, ' studied</title><author><persName><forename>A</forename><surname>B</surname></persName></author><idno type="DOI">10.1/', F.col("doc_id").cast("string"),
        '</idno></analytic><monogr><title level="j">J</title><imprint><biblScope unit="volume">5</biblScope><biblScope unit="page">1-2</biblScope><date when="', F.col("n_chars").cast("string"), f'"/></imprint></monogr></biblStruct></listBibl></div><div><head>Annex</head><p>{_ANNEX}</p></div></back></text></TEI>',
    )
    return read("documents").select("doc_id", xml.alias("tei_xml"))


_PACKED = r"""
src AS (SELECT doc_id, i, trim(regexp_replace(regexp_replace(x, '[\x00-\x08\x0b\x0c\x0e-\x1f]', '', 'g'), '\s+', ' ', 'g')) AS p FROM (SELECT doc_id, generate_subscripts(s, 1) AS i, unnest(s) AS x FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents))),
weighed AS (SELECT doc_id, i, p, len(string_split(p, ' ')) AS w FROM src WHERE p <> ''),
parts AS (
  SELECT doc_id, i, 1 AS j, 0 AS run, p FROM weighed WHERE w <= 80
  UNION ALL
  SELECT doc_id, i, generate_subscripts(s, 1) AS j, i AS run, unnest(s) AS p FROM (SELECT doc_id, i, string_split(regexp_replace(p, '([.!?]) ', '\1' || chr(1), 'g'), chr(1)) AS s FROM weighed WHERE w > 80)),
sized AS MATERIALIZED (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i, j) AS i, run, p, len(string_split(p, ' ')) AS w FROM parts),
walk AS (
  SELECT doc_id, i, run, w AS n, 0 AS c FROM sized WHERE i = 1
  UNION ALL
  SELECT k.doc_id, s.i, s.run, CASE WHEN s.run <> k.run OR k.n + s.w > 80 THEN s.w ELSE k.n + s.w END, CASE WHEN s.run <> k.run OR k.n + s.w > 80 THEN k.c + 1 ELSE k.c END FROM walk k JOIN sized s ON s.doc_id = k.doc_id AND s.i = k.i + 1),
packed AS (SELECT k.doc_id, k.c, string_agg(s.p, ' ' ORDER BY s.i) AS content, sum(s.w) AS w FROM walk k JOIN sized s ON s.doc_id = k.doc_id AND s.i = k.i GROUP BY k.doc_id, k.c)
"""


@query(f"""WITH RECURSIVE {_PACKED.strip()}
SELECT doc_id, '1. Body' AS section, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY c) - 1 AS INT) AS chunk, content FROM packed WHERE w >= 10
UNION ALL SELECT doc_id, 'authors', 0, lang || ' Doe (' || source || ') <x@y.org>' FROM documents
UNION ALL SELECT doc_id, 'title', 0, 'On ' || source FROM documents
UNION ALL SELECT doc_id, 'abstract', 0, '{_ABSTRACT} ' || source FROM documents
UNION ALL SELECT doc_id, '1. Body', 0, '{_INNER} ' || lang FROM documents
UNION ALL SELECT doc_id, 'references', 0, 'A B. ' || source || ' studied. J. (' || n_chars || ')' FROM documents
UNION ALL SELECT doc_id, 'Annex', 0, '{_ANNEX}' FROM documents""")
def tei_chunks(read, spark):
    return tei.tei_chunks(_tei(read), tei.TeiOptions(max_words=80, skip=frozenset({"acknowledgements"}))).select("doc_id", "section", "chunk", "content")


@query("""SELECT doc_id, 'On  ' || source AS title, ['1. Body', '2 Acknowledgements', 'Table 9: of ' || source] AS headings, lang AS first_name, 'Doe' AS last_name, source AS affiliation, 'x@y.org' AS email,
'b0' AS ref_id, source || ' studied' AS ref_title, CAST(n_chars AS VARCHAR) AS year, 'J' AS journal, '5' AS volume, '1-2' AS pages, '10.1/' || doc_id AS doi,
['Figure 7', 'Table 9', 'Figure 3', 'Table 4'] AS labels, ['A figure on ' || source, 'of ' || source, NULL, NULL] AS captions, ['f0', NULL, 'r1', NULL] AS fig_ids, CAST(doc_id AS VARCHAR) || ',1,2,3,4' AS coords FROM documents""")
def tei_documents(read, spark):
    d = _tei(read).select("doc_id", tei.tei_document(F.col("tei_xml")).alias("d"))
    every = lambda items, name: F.transform(F.col(items), lambda x: x[name])
    return d.select(
        "doc_id", "d.title", every("d.sections", "heading").alias("headings"), *[F.col("d.authors")[0][c].alias(c) for c in ("first_name", "last_name", "affiliation", "email")],
        F.col("d.references")[0]["ref_id"].alias("ref_id"), F.col("d.references")[0]["title"].alias("ref_title"), *[F.col("d.references")[0][c].alias(c) for c in ("year", "journal", "volume", "pages", "doi")],
        every("d.figure_refs", "label").alias("labels"), every("d.figure_refs", "caption").alias("captions"), every("d.figure_refs", "fig_id").alias("fig_ids"), F.col("d.figure_refs")[0]["coords"].alias("coords"),
    )


@query("SELECT doc_id, true AS failed FROM documents WHERE doc_id % 3 <> 0")
def tei_errors(read, spark):
    """What is cut off, or declares a document type, gets an error and ends nothing."""
    xml = F.when(F.col("doc_id") % 3 == 1, F.substring("tei_xml", 1, 200)).when(F.col("doc_id") % 3 == 2, F.concat(F.lit("<!DOCTYPE x>"), "tei_xml")).otherwise(F.col("tei_xml"))
    return tei.tei_chunks(_tei(read).withColumn("tei_xml", xml)).where("error is not null").select("doc_id", (F.length("error") > 0).alias("failed"))


def _item(kind: str, content: Column) -> Column:
    return F.concat(F.lit(f'{{"type":"{kind}","content":'), F.to_json(content), F.lit("}"))


def _piece(kind: str, content: Column) -> Column:
    return F.struct(F.lit(kind).alias("type"), content.alias("content"))


@query("""SELECT doc_id, 0 AS group_order, 'Untitled' AS title, ['A paragraph before any title.'] AS paragraphs, CAST([] AS VARCHAR[]) AS assets FROM documents
UNION ALL SELECT doc_id, 1, 'On ' || source, list_filter(list_transform(string_split(text, chr(10)), lambda p: trim(p || ' x=1')), lambda p: length(p) > 15), ['![Cap of ' || source || '](a.png) Cap of ' || source, '![A chart](b.png) A chart'] FROM documents""")
def layout_groups(read, spark):
    """Documents as pages of layout items, read, cleaned and grouped under their titles."""
    paragraph = lambda c: _item("paragraph", F.struct(F.array(_piece("text", c), _piece("equation_inline", F.lit("x=1")), _piece("footnote", F.lit("no"))).alias("paragraph_content")))
    first = F.array(_item("page_header", F.struct(F.lit("h").alias("x"))), _item("paragraph", F.struct(F.array(_piece("text", F.lit("A paragraph before any title."))).alias("paragraph_content"))), _item("title", F.struct(F.array(_piece("text", F.concat(F.lit("On\xa0"), "source"))).alias("title_content"))))
    image = _item("image", F.struct(F.array(_piece("text", F.concat(F.lit("Cap of "), "source"))).alias("image_caption"), F.struct(F.lit("a.png").alias("path")).alias("image_source")))
    chart = _item("chart", F.struct(F.lit("A chart").alias("chart_caption"), F.struct(F.lit("b.png").alias("path")).alias("image_source")))
    last = F.array(image, chart, _item("page_number", F.struct(F.lit("9").alias("x"))))
    page = lambda items: F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))
    docs = read("documents").select("doc_id", F.concat(F.lit(" ["), page(first), F.lit(","), page(F.transform(F.split("text", "\n"), paragraph)), F.lit(","), page(last), F.lit("]")).alias("layout"))
    return layout.group_by_title(layout.clean_items(layout.items(docs)))


_STOPS = "['figure','fig','table','tab','the','a','an','of','in','and','is','are','for']"


def _words(x: str) -> str:
    return f"list_distinct(list_filter(regexp_extract_all(lower({x}), '\\w+'), lambda w: NOT list_contains({_STOPS}, w)))"


def _alike(a: str, b: str) -> str:
    """The caption signal of two texts."""
    both, whole = f"len(list_intersect({_words(a)}, {_words(b)}))", f"len(list_distinct(list_concat({_words(a)}, {_words(b)})))"
    return f"CASE WHEN {both} > 0 AND {both} / {whole} >= 0.1 THEN 0.35 + 0.55 * ({both} / {whole}) ELSE 0 END"


def _assets(read):
    """(assets, refs) of every part: a picture without a place and a table with one; a reference without coordinates and one beside the table."""
    part = read("part").withColumn("doc_id", F.col("p_partkey"))
    box = F.struct(F.lit(10.0).alias("x1"), F.lit(700.0).alias("y1"), F.lit(110.0).alias("x2"), F.lit(800.0).alias("y2"))
    asset = lambda i, kind, caption, page, bbox: part.select("doc_id", F.lit(i).alias("ai"), F.lit(kind).alias("asset_type"), caption.alias("caption"), F.lit("").alias("text"), F.lit(page).alias("page_number"), bbox.alias("bbox"))
    assets = asset(0, "picture", F.concat(F.lit("Figure "), "p_size", F.lit(". "), "p_name"), 1, F.lit(None).cast("struct<x1:double,y1:double,x2:double,y2:double>")).unionByName(asset(1, "table", F.col("p_type"), 2, box))
    x = F.col("p_size").cast("double")
    place = F.struct(F.lit(2).alias("page"), (x + 10).alias("x1"), F.lit(841.89 - 800).alias("y1"), (x + 110).alias("x2"), F.lit(841.89 - 700).alias("y2"))
    ref = lambda i, label, caption, coords: part.select("doc_id", F.lit(i).alias("ri"), F.lit(f"f{i}").alias("fig_id"), label.alias("label"), caption.alias("caption"), coords.alias("coords"))
    refs = ref(0, F.concat(F.lit("Figure "), F.col("p_size") % 20), F.col("p_name"), F.lit(None).cast("struct<page:int,x1:double,y1:double,x2:double,y2:double>")).unionByName(ref(1, F.lit("Table"), F.concat("p_type", F.lit(" of the house")), place))
    return assets, refs


_CAPTION = "'Figure ' || p_size || '. ' || p_name"
_SCORES = f"""scores AS (
  SELECT p_partkey AS doc_id, 0 AS ai, 0 AS ri, greatest(0.1, CASE WHEN p_size % 20 = p_size THEN 0.55 ELSE 0 END, {_alike(_CAPTION, 'p_name')}) AS score FROM part
  UNION ALL SELECT p_partkey, 0, 1, {_alike(_CAPTION, "p_type || ' of the house'")} FROM part
  UNION ALL SELECT p_partkey, 1, 0, greatest(0.1, {_alike('p_type', 'p_name')}) FROM part
  UNION ALL SELECT p_partkey, 1, 1, least(1.0, 0.6 + 0.4 * ((100.0 - p_size) / (100.0 + p_size))) FROM part)"""


@query(f"WITH {_SCORES} SELECT doc_id, ai, ri, round(CAST(score AS DOUBLE), 5) AS score FROM scores")
def fusion_scores(read, spark):
    assets, refs = _assets(read)
    pairs = assets.select("doc_id", "ai", F.struct("asset_type", "caption", "text", "page_number", "bbox").alias("a")).join(refs.select("doc_id", "ri", F.struct("fig_id", "label", "caption", "coords").alias("r")), "doc_id")
    return pairs.select("doc_id", "ai", "ri", F.round(fusion.match_score(F.col("a"), F.col("r")), 5).alias("score"))


_FUSED = f"""{_SCORES},
best AS (SELECT * FROM scores WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, ai, ri) = 1),
matched AS (SELECT * FROM best UNION ALL SELECT s.* FROM scores s JOIN best b ON s.doc_id = b.doc_id AND s.ai = 1 - b.ai AND s.ri = 1 - b.ri WHERE s.score > 0),
fused AS (SELECT p_partkey AS doc_id, a.ai, m.ri, coalesce(m.score, 0) AS score, CASE a.ai WHEN 0 THEN 'picture' ELSE 'table' END AS asset_type, CASE a.ai WHEN 0 THEN {_CAPTION} ELSE p_type END AS caption,
  CASE m.ri WHEN 0 THEN 'Figure ' || (p_size % 20) WHEN 1 THEN 'Table' END AS label FROM part CROSS JOIN (VALUES (0), (1)) a(ai) LEFT JOIN matched m ON m.doc_id = p_partkey AND m.ai = a.ai)"""


@query(f"WITH {_FUSED} SELECT doc_id, ai, ri, round(CAST(score AS DOUBLE), 5) AS match_confidence, asset_type, caption, label FROM fused")
def fused_assets(read, spark):
    return fusion.fuse(*_assets(read)).withColumn("match_confidence", F.round("match_confidence", 5))


@query(f"WITH {_FUSED} SELECT doc_id, count(*) AS assets, count_if(asset_type = 'picture')::BIGINT AS figures, count_if(asset_type = 'table')::BIGINT AS tables, 0::BIGINT AS formulas, count(ri) AS matched, count_if(ri IS NULL)::BIGINT AS unmatched FROM fused GROUP BY doc_id")
def fused_reports(read, spark):
    return fusion.fused_report(fusion.fuse(*_assets(read)))


@query(f"WITH {_FUSED} SELECT doc_id, ai, ri FROM fused WHERE doc_id % 2 = 0 AND doc_id % 3 = 0")
def fused_ready(read, spark):
    """Only parts for which both services succeeded are fused."""
    assets, refs = _assets(read)
    listed = lambda rows, at, name, *columns: rows.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct(at, *columns))), lambda x: F.struct(*[x[c].alias(c) for c in columns])).alias(name))
    found = listed(assets, "ai", "assets", "asset_type", "caption", "text", "page_number", "bbox").withColumn("ok", F.col("doc_id") % 2 == 0)
    named = listed(refs, "ri", "figure_refs", "fig_id", "label", "caption", "coords").withColumn("ok", F.col("doc_id") % 3 == 0)
    return fusion.fuse_ready(named, found).select("doc_id", "ai", "ri")


def _feed(read):
    name = lambda c: F.array(F.struct(c.alias("name")))
    return arxiv.metadata(
        read("documents").select(
            F.concat(F.lit("http://arxiv.org/abs/2401."), F.lpad(F.col("doc_id").cast("string"), 7, "0"), F.lit("v3")).alias("id"), F.concat(F.lit("  On\n "), "source").alias("title"), F.col("text").alias("summary"),
            F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("doc_id") % 97).cast("int")), "yyyy-MM-dd").alias("published"), F.lit(None).cast("string").alias("updated"), name(F.col("source")).alias("author"),
            F.array(F.struct(F.col("lang").alias("_term")), F.struct(F.col("source").alias("_term"))).alias("category"), F.array(F.struct(F.lit("http://x/1").alias("_href"), F.lit("doi").alias("_title")), F.struct(F.concat(F.lit("http://x/"), "doc_id").alias("_href"), F.lit("pdf").alias("_title"))).alias("link"),
            F.lit("10.1/x").alias("doi"), F.lit(None).cast("string").alias("journal_ref"),
        )
    )


_ID = "'2401.' || lpad(CAST(doc_id AS VARCHAR), 7, '0')"


@query(f"SELECT {_ID} || 'v3' AS raw_id, {_ID} AS arxiv_id, 'On ' || source AS title, [source] AS authors, [lang, source] AS categories, strftime(DATE '2020-01-01' + CAST(doc_id % 97 AS INT), '%Y-%m-%d') AS published, '' AS updated, 'http://x/' || doc_id AS pdf_url, '10.1/x' AS doi, '' AS journal_ref FROM documents")
def feed_metadata(read, spark):
    return _feed(read).drop("abstract", "primary_category")


@query(f"SELECT {_ID} AS arxiv_id, strftime(DATE '2020-01-01' + CAST(doc_id % 97 AS INT), '%Y-%m-%d') AS published FROM documents WHERE lang = 'en' OR source = 'en' ORDER BY published DESC, arxiv_id LIMIT 50")
def topic_search(read, spark):
    return arxiv.search(_feed(read), "en", 50).select("arxiv_id", "published")


@query("SELECT '2401.0000007' AS arxiv_id, 'On ' || source AS title FROM documents WHERE doc_id = 7")
def paper_look_up(read, spark):
    return arxiv.look_up(_feed(read), "2401.0000007").select("arxiv_id", "title")


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN '<TEI>' || event_type END AS tei_xml, CASE event_id % 4 WHEN 1 THEN 'no content could be extracted' WHEN 2 THEN repeat('b', 500) WHEN 3 THEN '' END AS error, event_id % 4 = 0 AS ok FROM events")
def service_outcomes(read, spark):
    kind = F.col("event_id") % 4
    body = F.when(kind == 0, F.concat(F.lit("<TEI>"), "event_type")).when(kind == 2, F.repeat(F.lit("b"), 900))
    out = files.service_outcome(F.when(kind == 0, 200).when(kind == 1, 204).otherwise(503), body)
    return read("events").select("event_id", out.alias("o")).select("event_id", "o.tei_xml", "o.error", "o.ok")


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber % 2 = 0 THEN l_linenumber END AS page_number, CASE WHEN l_linenumber % 2 = 0 THEN l_quantity END AS x1, CASE WHEN l_linenumber % 2 = 0 THEN l_quantity + 3 END AS y2, CASE WHEN l_linenumber % 3 = 0 THEN l_returnflag ELSE l_linestatus END AS text FROM lineitem")
def asset_places(read, spark):
    corner = lambda k: F.col("l_quantity") + k
    spot = F.struct(F.col("l_linenumber").alias("page_no"), corner(0).alias("l"), corner(1).alias("t"), corner(2).alias("r"), corner(3).alias("b"))
    other = F.struct(F.lit(99).cast("long").alias("page_no"), corner(9).alias("l"), corner(9).alias("t"), corner(9).alias("r"), corner(9).alias("b"))
    lines = read("lineitem").withColumn("l_linenumber", F.col("l_linenumber").cast("long"))
    place = files.asset_place(F.when(F.col("l_linenumber") % 2 == 0, F.array(spot, other)))
    picked = files.picked_asset_text(F.when(F.col("l_linenumber") % 3 == 0, F.col("l_returnflag")).otherwise(""), F.lit(None).cast("string"), F.col("l_linestatus"))
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", place.alias("p"), picked.alias("text")).select("l_orderkey", F.col("l_linenumber").cast("int").alias("l_linenumber"), "l_partkey", "p.page_number", "p.bbox.x1", "p.bbox.y2", "text")


@query("SELECT count_if(event_type = 'view')::BIGINT AS n_ok, count(*) AS n_total FROM events")
def convert_summary(read, spark):
    return files.convert_summary(read("events").select((F.col("event_type") == "view").alias("ok")))


@query("SELECT l_orderkey, count_if(l_quantity > 40)::BIGINT AS stored, CASE WHEN count_if(l_quantity > 40) > 0 THEN 'ok' ELSE 'skipped' END AS status FROM lineitem GROUP BY l_orderkey")
def stored_summary(read, spark):
    return lifecycle.stored_summary(read("lineitem").select("l_orderkey", F.when(F.col("l_quantity") > 40, F.array(F.col("l_quantity"))).otherwise(F.array().cast("array<double>")).alias("embedding")), "l_orderkey")


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'Fig. ' || p_size END AS label, CASE WHEN p_partkey % 2 = 0 THEN p_name END AS caption FROM part")
def caption_parts(read, spark):
    text = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("Fig.  "), "p_size", F.lit(" :  "), "p_name")).otherwise(F.concat(F.lit("See Fig. "), "p_size", F.lit(": "), "p_name"))
    return read("part").select("p_partkey", t.caption_parts(text).alias("c")).select("p_partkey", "c.label", "c.caption")


@query("""SELECT o_orderkey, list_filter([CASE WHEN o_orderstatus = 'P' THEN 'processing_status' END, CASE WHEN o_orderkey % 7 = 0 THEN 'venue_type' END, CASE WHEN o_orderkey % 5 = 0 THEN 'title' END], lambda x: x IS NOT NULL) AS broken
FROM orders WHERE o_orderstatus = 'P' OR o_orderkey % 7 = 0 OR o_orderkey % 5 = 0""")
def paper_violations(read, spark):
    key = F.col("o_orderkey")
    papers_ = read("orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "P", "lost").otherwise("done").alias("processing_status"), F.when(key % 7 == 0, "pamphlet").when(key % 7 == 1, F.lit(None)).otherwise("journal").alias("venue_type"), F.when(key % 5 != 0, F.lit("t")).alias("title"), F.lit("p").alias("paper_id"))
    return validate.paper_violations(papers_).select("o_orderkey", "broken")


@query("SELECT event_id, unnest(['reset', 'queued']) AS event, unnest([ts, ts + INTERVAL 1 SECOND]) AS at FROM events")
def forced_events(read, spark):
    return read("events").select("event_id", F.explode(papers.forced(F.col("event_id"), F.col("ts"))).alias("e")).select("event_id", "e.event", F.col("e.ts").alias("at"))


@query("SELECT doc_id, 'fi A 1 ' || text || ' ...' AS normal FROM documents")
def normal_form(read, spark):
    return read("documents").select("doc_id", t.nfkc(F.concat(F.lit("ﬁ Ａ ¹ "), "text", F.lit(" …"))).alias("normal"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity >= 25 AS was_truncated FROM lineitem")
def truncated_chunks(read, spark):
    return embed.truncated(read("lineitem").withColumn("token_count", F.col("l_quantity")), 25).select("l_orderkey", "l_linenumber", "l_partkey", "was_truncated")


@query("SELECT l_orderkey, l_partkey, l_linenumber, row_number() OVER (ORDER BY l_orderkey, l_partkey, l_linenumber) AS place FROM (SELECT DISTINCT l_orderkey, l_partkey, l_linenumber FROM lineitem)")
def reading_order(read, spark):
    """Chunks in the order of reading, numbered over the sorted table: places within partitions and what the partitions before them hold."""
    rows = read("lineitem").select("l_orderkey", F.col("l_partkey").alias("section_order"), F.col("l_linenumber").alias("chunk")).distinct()
    spread = lifecycle.reading_order(rows, "l_orderkey").select("*", F.monotonically_increasing_id().alias("m"))
    part, inside = F.shiftright("m", 33), F.expr("m & 8589934591L")
    counts = spread.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    until = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    before = counts.select("part", F.coalesce(F.sum("n").over(until), F.lit(0)).alias("before"))
    return spread.withColumn("part", part).join(before, "part").select("l_orderkey", F.col("section_order").alias("l_partkey"), F.col("chunk").alias("l_linenumber"), (F.col("before") + inside + 1).alias("place"))


@query("""SELECT CAST(p_partkey AS VARCHAR) AS doc_id, ai, CASE ai WHEN 0 THEN 'picture' WHEN 1 THEN 'table' ELSE 'formula' END AS asset_type, CASE ai WHEN 0 THEN p_name WHEN 1 THEN 'see ' || p_name END AS caption,
CASE ai WHEN 1 THEN '| a |' WHEN 2 THEN 'x = ' || p_name END AS text, CAST(CASE WHEN ai < 2 THEN ai + 1 END AS INT) AS page_number, CAST(CASE WHEN ai < 2 THEN 4.0 END AS DOUBLE) AS y2 FROM part CROSS JOIN (VALUES (0), (1), (2)) a(ai) WHERE p_partkey % 4 <> 0""")
def converted_assets(read, spark):
    """Files through a converter that fails on every fourth, and the assets of the others."""

    def converter(content: bytes) -> list[dict]:
        key, name = content.decode().split("|")
        if int(key) % 4 == 0:
            raise ValueError("broken file")
        place = lambda page: [{"page_no": page, "l": 1.0, "t": 2.0, "r": 3.0, "b": 4.0}, {"page_no": 99, "l": 0.0, "t": 0.0, "r": 0.0, "b": 0.0}]
        none = {"caption": None, "refs": None, "orig": None, "text": None, "latex": None, "prov": None}
        return [
            none | {"kind": "PictureItem", "caption": name, "refs": ["unused"], "prov": place(1)}, none | {"kind": "TextItem", "text": "no asset"},
            none | {"kind": "TableItem", "caption": "", "refs": ["see", name], "text": "| a |", "prov": place(2)}, none | {"kind": "EquationItem", "orig": "", "text": f"x = {name}", "latex": "y"},
        ]

    pdfs = read("part").select(F.col("p_partkey").cast("string").alias("doc_id"), F.encode(F.concat_ws("|", "p_partkey", "p_name"), "UTF-8").alias("content"), F.lit(None).cast("string").alias("skip_reason"))
    return files.assets_of(files.convert(pdfs, converter)).withColumn("y2", F.col("bbox.y2")).drop("bbox")


@query("SELECT CAST(event_id AS VARCHAR) AS doc_id, CASE WHEN event_id % 5 <> 0 THEN '<date>' || event_type || '</date>' END AS tei_xml, event_id % 5 <> 0 AS ok, CASE WHEN event_id % 5 = 0 THEN 0 ELSE 200 END AS status_code FROM events")
def text_services(read, spark):
    """Texts through a service that never answers every fifth."""

    def call(service: str, content: bytes, options: dict) -> tuple[int, str]:
        number, text = content.decode().split("|")
        if int(number) % 5 == 0:
            raise TimeoutError("no answer")
        return 200, f"<date>{text}</date>"

    texts = read("events").select(F.col("event_id").cast("string").alias("doc_id"), F.concat_ws("|", "event_id", "event_type").alias("text"))
    return files.call_text_service(texts, call, "processDate", pause=lambda k: 0.0).select("doc_id", "tei_xml", "ok", "status_code")


@query("SELECT doc_id, CAST(least(n, 512) AS INT) AS token_count, CAST(least(n, 512) AS INT) AS ratio, 1.0::DOUBLE AS length FROM (SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) + 1 AS n FROM documents)")
def window_embeddings(read, spark):
    """A toy token model, (token, tokens of the text) for each token, which shows the window, the vector of the first token and unit length."""
    model = lambda: embed.WindowEmbedder("toy", 2, lambda text: [1, *(2 for _ in text.split())], lambda ids: [np.array([[float(x), float(len(row))] for x in row]) for row in ids])
    x, y = F.col("embedding")[0].cast("double"), F.col("embedding")[1].cast("double")
    chunks = embed.with_token_counts(embed.with_embeddings(read("documents"), model), model)
    return chunks.select("doc_id", "token_count", F.round(y / x).cast("int").alias("ratio"), F.round(x * x + y * y, 4).alias("length"))


@query("SELECT event_id, 'parse_pdf' AS task, [CAST(user_id AS VARCHAR), event_type] AS args, event_id % 3 AS retries FROM events WHERE event_id % 2 = 0")
def task_messages(read, spark):
    """Tasks as JSON and back; what isn't a task is null."""
    message = lifecycle.task_message(F.lit("parse_pdf"), F.array(F.col("user_id").cast("string"), "event_type"), retries=(F.col("event_id") % 3).cast("int"))
    found = read("events").select("event_id", lifecycle.task_of(F.when(F.col("event_id") % 2 == 0, message).otherwise(F.lit("{not json"))).alias("t")).where("t is not null")
    return found.select("event_id", "t.task", "t.args", F.col("t.retries").cast("long").alias("retries"))
