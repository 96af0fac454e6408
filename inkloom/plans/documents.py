"""Queries over texts: cleaning, splitting, packing and hashing."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkloom.functions import text as t
from inkloom.operators import chunking, dedup, lifecycle, sections
from inkloom.plans.registry import query

_DUCK_LINES = "array_to_string(list_filter(list_transform(string_split({x}, chr(10)), lambda l: trim(l, ' ' || chr(9))), lambda l: l <> ''), chr(10))"
_SENTENCES = "string_split(regexp_replace(text, '([.!?])[ \\n]+', '\\1' || chr(1), 'g'), chr(1))"
_WORDS = "len(list_filter(regexp_split_to_array({x}, '[ \\n]+'), lambda w: w <> ''))"


@query("SELECT doc_id, split_part(split_part(text || chr(10) || 'Acknowledgments' || chr(10) || lang || chr(10) || ' References ' || chr(10) || source || chr(10), chr(10) || ' References ' || chr(10), 1), chr(10) || 'Acknowledgments' || chr(10), 1) AS kept FROM documents")
def clean_refs_cut(read, spark):
    text = F.concat("text", F.lit("\nAcknowledgments\n"), "lang", F.lit("\n References \n"), "source", F.lit("\n"))
    return read("documents").select("doc_id", t.cut_acknowledgements(t.cut_references(text)).alias("kept"))


# Steps over whole texts with the pattern before, within and after them.
_CITED = r"\[\d[\d,\s–\-]*\]|\([A-Z][a-z]+(?:\s+et\s+al\.?)?,\s*\d{4}[a-z]?(?:;\s*[A-Z][a-z]+(?:\s+et\s+al\.?)?,\s*\d{4}[a-z]?)*\)"


@query(f"SELECT doc_id, regexp_replace('See [1, 2] ' || text || ' and [3-5] ' || text || ' (Smith et al., 2020; Doe, 1999a) end', '{_CITED}', '', 'g') AS cleaned FROM documents")
def clean_citations(read, spark):
    text = F.concat(F.lit("See [1, 2] "), "text", F.lit(" and [3-5] "), "text", F.lit(" (Smith et al., 2020; Doe, 1999a) end"))
    return read("documents").select("doc_id", t.drop(text, t.CITATION).alias("cleaned"))


@query("SELECT doc_id, regexp_replace('Figure 3: ' || text || ' fig. 12. ' || text || ' Table 4: x Algorithm 1. y', '(?i)(Figure|Fig\\.|Table|Algorithm|Listing)\\s+\\d+[.:]', '', 'g') AS cleaned FROM documents")
def clean_captions(read, spark):
    text = F.concat(F.lit("Figure 3: "), "text", F.lit(" fig. 12. "), "text", F.lit(" Table 4: x Algorithm 1. y"))
    return read("documents").select("doc_id", t.drop(text, t.CAPTION).alias("cleaned"))


@query(r"SELECT doc_id, regexp_replace('a \mathbf{x}' || text || ' \alpha b ' || text || ' \beta', '\\[a-zA-Z]+\{[^}]*\}|\\[a-zA-Z]+', '', 'g') AS cleaned FROM documents")
def clean_latex(read, spark):
    text = F.concat(F.lit(r"a \mathbf{x}"), "text", F.lit(r" \alpha b "), "text", F.lit(r" \beta"))
    return read("documents").select("doc_id", t.drop(text, t.LATEX).alias("cleaned"))


@query("SELECT doc_id, regexp_replace(text || chr(10) || '12' || chr(10) || 'Page 7' || chr(10) || text || chr(10) || '12345' || chr(10) || '9', '(?m)^\\s*(?:Page\\s*)?\\d{1,4}\\s*$', '', 'g') AS cleaned FROM documents")
def clean_page_numbers(read, spark):
    text = F.concat_ws("\n", "text", F.lit("12"), F.lit("Page 7"), "text", F.lit("12345"), F.lit("9"))
    return read("documents").select("doc_id", t.drop(text, t.PAGE_NUMBER).alias("cleaned"))


@query("SELECT doc_id, regexp_replace('pro-' || chr(10) || 'cess ' || text || ' a- b re-' || chr(10) || 'sult ' || text, '([\\p{L}\\p{N}_])-\\n([\\p{L}\\p{N}_])', '\\1\\2', 'g') AS cleaned FROM documents")
def clean_hyphen(read, spark):
    text = F.concat(F.lit("pro-\ncess "), "text", F.lit(" a- b re-\nsult "), "text")
    return read("documents").select("doc_id", t.join_hyphens(text).alias("cleaned"))


@query("SELECT doc_id, trim(regexp_replace(regexp_replace(text || ' arXiv:2401.12345v2  [cs.CL]  3 Jan 2024 ' || text, '(?i)arXiv:\\d{4}\\.\\d{4,5}v\\d+\\s+\\[[\\w.]+\\]\\s+\\d{1,2}\\s+\\w+\\s+\\d{4}', '', 'g'), '\\s+', ' ', 'g')) AS cleaned FROM documents")
def clean_arxiv_header(read, spark):
    text = F.concat("text", F.lit(" arXiv:2401.12345v2  [cs.CL]  3 Jan 2024 "), "text")
    return read("documents").select("doc_id", t.squeeze(t.drop(text, t.ARXIV_HEADER)).alias("cleaned"))


@query(f"SELECT doc_id, {_DUCK_LINES.format(x='''regexp_replace(regexp_replace('  ' || lang || chr(9) || chr(9) || source || chr(10) || chr(10) || chr(10) || chr(10) || text || '   ', '[ ' || chr(9) || ']{2,}', ' ', 'g'), chr(10) || '{3,}', chr(10) || chr(10), 'g')''')} AS cleaned FROM documents")
def clean_whitespace(read, spark):
    text = F.concat(F.lit("  "), "lang", F.lit("\t\t"), "source", F.lit("\n\n\n\n"), "text", F.lit("   "))
    return read("documents").select("doc_id", t.tidy_lines(t.squeeze_blanks(text)).alias("cleaned"))


@query(f"SELECT doc_id, {_DUCK_LINES.format(x='''regexp_replace(text || '  ' || lang, '[ ' || chr(9) || ']{2,}', ' ', 'g')''')} AS cleaned FROM documents")
def clean_full_nfkc(read, spark):
    text = F.concat("text", F.lit(" [1, 2] "), "lang", F.lit("\n42\n\nReferences\n"), "source")
    return read("documents").select("doc_id", t.clean(text).alias("cleaned"))


@query("SELECT doc_id, CAST(length(text) AS INT) AS chars, CAST(length(text) // 4 AS INT) AS token_count FROM documents WHERE length(text) >= 100")
def min_length_filter(read, spark):
    return read("documents").where(F.length("text") >= t.MIN_CHARS).select("doc_id", F.length("text").alias("chars"), t.token_estimate(F.col("text")).alias("token_count"))


@query("""SELECT doc_id, CASE WHEN length(text) <= 400 THEN text
  WHEN instr(reverse(text[:400]), ' .') > 0 AND 400 - instr(reverse(text[:400]), ' .') - 1 > 320 THEN text[:400 - instr(reverse(text[:400]), ' .')] ELSE text[:400] END AS cut FROM documents""")
def truncate_tokens(read, spark):
    return read("documents").select("doc_id", t.truncate_tokens(F.col("text"), 100).alias("cut"))


@query(f"SELECT doc_id, CAST(generate_subscripts(s, 1) - 1 AS INT) AS pos, unnest(s) AS sentence FROM (SELECT doc_id, {_SENTENCES} AS s FROM documents)")
def sentence_split(read, spark):
    return read("documents").select("doc_id", F.posexplode(chunking.sentences(F.col("text"))).alias("pos", "sentence"))


_PACK = f"""
WITH RECURSIVE parts AS (SELECT doc_id, CAST(generate_subscripts(s, 1) AS INT) AS i, unnest(s) AS p FROM (SELECT doc_id, {_SENTENCES} AS s FROM documents)),
sized AS MATERIALIZED (SELECT doc_id, i, p, {_WORDS.format(x="p")} AS w FROM parts),
walk AS (
  SELECT doc_id, i, w AS n, 0 AS c FROM sized WHERE i = 1
  UNION ALL
  SELECT k.doc_id, s.i, CASE WHEN k.n + s.w > 60 THEN s.w ELSE k.n + s.w END, CASE WHEN k.n + s.w > 60 THEN k.c + 1 ELSE k.c END FROM walk k JOIN sized s ON s.doc_id = k.doc_id AND s.i = k.i + 1),
packed AS (SELECT k.doc_id, k.c, string_agg(s.p, ' ' ORDER BY s.i) AS chunk FROM walk k JOIN sized s ON s.doc_id = k.doc_id AND s.i = k.i GROUP BY k.doc_id, k.c)
"""


@query(_PACK + "SELECT doc_id, CAST(c AS INT) AS pos, chunk FROM packed WHERE trim(chunk) <> ''")
def sentence_pack(read, spark):
    return read("documents").select("doc_id", F.posexplode(chunking.pack_sentences(F.col("text"), 60)).alias("pos", "chunk"))


_LINES = f"""
lines AS (SELECT doc_id, CAST(generate_subscripts(s, 1) AS INT) AS i, unnest(s) AS p FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)),
weighed AS (SELECT doc_id, i, p, {_WORDS.format(x="p")} AS w FROM lines),
parts AS (
  SELECT doc_id, i, 1 AS j, p, w > 80 AS long FROM weighed WHERE w <= 80
  UNION ALL
  SELECT doc_id, i, generate_subscripts(s, 1) AS j, unnest(s) AS p, true FROM (SELECT doc_id, i, {_SENTENCES.replace("text", "p")} AS s FROM weighed WHERE w > 80)),
sized AS MATERIALIZED (
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i, j) AS INT) AS i, CASE WHEN long THEN i ELSE 0 END AS run, p, {_WORDS.format(x="p")} AS w FROM parts)"""


@query(f"""
WITH RECURSIVE {_LINES},
walk AS (
  SELECT doc_id, i, run, w AS n, 0 AS c FROM sized WHERE i = 1
  UNION ALL
  SELECT k.doc_id, s.i, s.run, CASE WHEN s.run <> k.run OR k.n + s.w > 80 THEN s.w ELSE k.n + s.w END, CASE WHEN s.run <> k.run OR k.n + s.w > 80 THEN k.c + 1 ELSE k.c END FROM walk k JOIN sized s ON s.doc_id = k.doc_id AND s.i = k.i + 1),
packed AS (SELECT k.doc_id, k.c, string_agg(s.p, ' ' ORDER BY s.i) AS chunk, sum(s.w) AS w FROM walk k JOIN sized s ON s.doc_id = k.doc_id AND s.i = k.i GROUP BY k.doc_id, k.c)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY c) - 1 AS INT) AS pos, chunk FROM packed WHERE w >= 10
""")
def paragraph_pack(read, spark):
    """Lines of more than 80 words are packed by sentences, between runs of the others."""
    return read("documents").select("doc_id", F.posexplode(chunking.pack_paragraphs(F.split("text", "\n"), 80, 10)).alias("pos", "chunk"))


@query()
def recursive_chunks(read, spark):
    return chunking.chunk_rows(read("documents").select("doc_id", F.lit(0).alias("section_order"), F.lit("Body").alias("title"), "text"), "doc_id")


@query(_PACK + "SELECT CAST(doc_id AS VARCHAR) || '_0_' || CAST(c AS VARCHAR) AS chunk_id, CAST(length(chunk) // 4 AS INT) AS token_count, sha256(chunk) AS content_hash FROM packed WHERE length(chunk) >= 100")
def chunk_ids(read, spark):
    cut = read("documents").select("doc_id", F.posexplode(chunking.pack_sentences(F.col("text"), 60)).alias("pos", "chunk")).where(F.length("chunk") >= t.MIN_CHARS)
    return cut.select(F.concat_ws("_", "doc_id", F.lit(0), "pos").alias("chunk_id"), t.token_estimate(F.col("chunk")).alias("token_count"), t.content_hash(F.col("chunk")).alias("content_hash"))


_CLEANED = f"cleaned AS MATERIALIZED (SELECT doc_id, lang, text FROM (SELECT doc_id, lang, {_DUCK_LINES.format(x="regexp_replace(text, '[ ' || chr(9) || ']{2,}', ' ', 'g')")} AS text FROM documents) WHERE length(text) >= 100)"


@query(_PACK.replace("FROM documents", "FROM cleaned").replace("WITH RECURSIVE", f"WITH RECURSIVE {_CLEANED},") + """SELECT lang, count(DISTINCT doc_id) AS docs, count(*) AS chunks, CAST(floor(sum(length(chunk) // 4) / count(*)) AS BIGINT) AS avg_tokens
FROM packed JOIN cleaned USING (doc_id) WHERE length(chunk) >= 100 GROUP BY lang""")
def chunk_stats_by_lang(read, spark):
    """Clean, keep texts of some length, pack sentences, count: the slice from end to end."""
    cleaned = read("documents").select("doc_id", "lang", t.clean(F.col("text"), normalise=False).alias("text")).where(F.length("text") >= t.MIN_CHARS)
    cut = cleaned.select("doc_id", "lang", F.explode(chunking.pack_sentences(F.col("text"), 60)).alias("chunk")).where(F.length("chunk") >= t.MIN_CHARS)
    sized = cut.select("doc_id", "lang", t.token_estimate(F.col("chunk")).alias("token_count"))
    by_doc = sized.groupBy("lang", "doc_id").agg(F.count("*").alias("n"), F.sum("token_count").alias("tokens"))
    return by_doc.groupBy("lang").agg(F.count("*").alias("docs"), F.sum("n").alias("chunks"), F.floor(F.sum("tokens") / F.sum("n")).cast("long").alias("avg_tokens"))


@query("SELECT lang, count(*) AS chunks, CAST(sum(n_chars // 4) // count(*) AS BIGINT) AS avg_tokens FROM documents GROUP BY lang")
def average_tokens(read, spark):
    return lifecycle.average_tokens(read("documents").select("lang", F.floor(F.col("n_chars") / 4).alias("token_count")), "lang")


@query("SELECT sha256(text) AS content_hash, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY sha256(text)")
def content_hash_dedup(read, spark):
    return dedup.first_by_hash(read("documents"), "text", "doc_id")


@query("SELECT doc_id, source, sha256(text) AS content_hash FROM documents d WHERE NOT EXISTS (SELECT 1 FROM documents e WHERE e.doc_id % 2 = 0 AND e.source = d.source AND sha256(e.text) = sha256(d.text))")
def hash_skip_existing(read, spark):
    docs = read("documents").withColumn("content", F.col("text"))
    stored = docs.where("doc_id % 2 = 0").select("source", t.content_hash(F.col("text")).alias("content_hash"), F.array(F.lit(1.0)).alias("embedding"))
    return dedup.skip_embedded(docs.select("doc_id", "source", "content"), stored, "source").select("doc_id", "source", "content_hash")


@query("SELECT source, CAST(list_sort(list(n_chars))[len(list(n_chars)) // 2 + 1] AS BIGINT) AS median FROM documents GROUP BY source")
def upper_median(read, spark):
    return sections.upper_median(read("documents"), "source", "n_chars")


def _lines(read):
    lines = read("documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("span_idx", "text"))
    return lines.withColumn("size", F.when(F.length("text") < 60, 14.0).otherwise(10.0)).withColumn("page", F.floor(F.col("span_idx") / 3).cast("int"))


_SPANS = """
spans AS (SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INT) AS i, unnest(l) AS t FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
solid AS (SELECT doc_id, i, trim(t) AS t, i // 3 AS page, CASE WHEN length(t) < 60 THEN 14.0 ELSE 10.0 END AS size FROM spans WHERE trim(t) <> ''),
med AS (SELECT doc_id, list_sort(list(size))[len(list(size)) // 2 + 1] AS m FROM solid GROUP BY doc_id),
flag AS (SELECT s.*, size >= 1.2 * m AND length(t) < 120 AND NOT ends_with(t, ',') AS h FROM solid s JOIN med USING (doc_id)),
step AS (SELECT *, CASE WHEN h IS DISTINCT FROM lag(h) OVER (PARTITION BY doc_id ORDER BY i) OR lag(h) OVER (PARTITION BY doc_id ORDER BY i) IS NULL THEN 1 ELSE 0 END AS b FROM flag),
run AS (SELECT *, sum(b) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM step),
pos AS (SELECT *, row_number() OVER (PARTITION BY doc_id, r ORDER BY i) AS k FROM run),
op AS (SELECT *, h AND ((r = 1 AND k % 2 = 0) OR (r <> 1 AND k % 2 = 1)) AS o FROM pos),
sec AS (SELECT *, sum(CASE WHEN o THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS s FROM op),
grp AS (SELECT doc_id, s, max(CASE WHEN o THEN t END) AS title, string_agg(CASE WHEN NOT o THEN t END, ' ' ORDER BY i) AS body, max(CASE WHEN o THEN page END) AS first, arg_max(page, i) AS last FROM sec GROUP BY doc_id, s),
nxt AS (SELECT *, lead(first) OVER (PARTITION BY doc_id ORDER BY s) AS n FROM grp)
SELECT doc_id, CAST(s AS INT) AS section_order, coalesce(title, 'Introduction') AS title, body || ' ' AS text, CAST(coalesce(first, 0) AS INT) AS page_start, CAST(coalesce(n, last) AS INT) AS page_end FROM nxt WHERE body IS NOT NULL
"""


@query("WITH " + _SPANS.strip())
def section_segment(read, spark):
    return sections.segment(_lines(read))


@query("SELECT page_id, CAST(len(regexp_extract_all(html, '<p>([^<]*)')) AS INT) AS paragraphs, coalesce(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title FROM pages")
def html_paragraphs(read, spark):
    return read("pages").select("page_id", F.size(F.regexp_extract_all("html", F.lit("<p>([^<]*)"), F.lit(1))).alias("paragraphs"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))


@query("SELECT doc_id, text, 'Abstract' AS title FROM documents WHERE text <> ''")
def abstract_sections(read, spark):
    """Every document once with its text as the abstract and once with none, which gives no section."""
    docs = read("documents").withColumn("abstract", F.col("text"))
    none = docs.limit(0).select("doc_id", F.lit(0).alias("section_order"), F.lit("").alias("title"), "text", F.lit(0).alias("page_start"), F.lit(0).alias("page_end"))
    return sections.with_abstract(none, docs.unionByName(docs.withColumn("abstract", F.lit(None).cast("string")))).select("doc_id", "text", "title")


@query("SELECT doc_id, array_to_string(list_filter(string_split(text, chr(10)), lambda l: l <> ''), chr(10) || chr(10)) AS full_text FROM documents")
def full_text(read, spark):
    rows = read("documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("section_order", "text"))
    return sections.full_text(rows)


@query("SELECT doc_id, CAST(length(text) // 4 AS INT) AS token_count, lang || ' [SEP] ' || replace(text, chr(10), ' ') AS model_text FROM documents")
def model_input(read, spark):
    return read("documents").select("doc_id", t.token_estimate(F.col("text")).alias("token_count"), t.model_text(F.col("lang"), t.one_line(F.col("text"))).alias("model_text"))
