"""PDF, TEI and layout files, and the services that make one from another."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkloom.operators.lifecycle import skip_reason

#: What the TEI service can be asked for.
TEI_SERVICES = ("processFulltextDocument", "processHeaderDocument", "processReferences", "processCitationList", "processAffiliations", "processDate", "processHeaderNames", "processCitationNames", "processCitationPatentST36", "processCitationPatentPDF")
#: Those that take a text instead of a file.
TEXT_SERVICES = ("processCitationList", "processAffiliations", "processDate")
SPAN_TYPE = "doc_id string, span_idx int, page int, text string, size double, font string, is_bold boolean"


def read_pdfs(spark: SparkSession, path: str, content: bool = True) -> DataFrame:
    """(path, doc_id, length, modificationTime, skip_reason[, content]); the reason is null for files of a usable size."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", "true").load(path)
    named = files.withColumn("doc_id", F.regexp_extract("path", r"([^/]+)\.pdf$", 1)).withColumn("skip_reason", skip_reason(F.col("length")))
    return named.select("path", "doc_id", "length", "modificationTime", "skip_reason", *(["content"] if content else []))


def read_whole(spark: SparkSession, path: str, out: str, suffix: str) -> DataFrame:
    """(doc_id, <out>): whole text files, such as TEI or layout JSON."""
    text = spark.read.option("wholetext", "true").option("pathGlobFilter", f"*{suffix}").text(path)
    return text.select(F.regexp_extract(F.input_file_name(), rf"([^/]+?){suffix.replace('.', '[.]')}$", 1).alias("doc_id"), F.col("value").alias(out))


def read_spans(pdfs: DataFrame, extract: Callable[[bytes], list[tuple]]) -> DataFrame:
    """SPAN_TYPE of PDFs without a skip_reason; `extract` gives (page, text, size, font, is_bold) of the text blocks of one file."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(d, i, *s) for d, c in zip(pdf["doc_id"], pdf["content"], strict=True) for i, s in enumerate(extract(bytes(c)))]
            yield pd.DataFrame(rows, columns=["doc_id", "span_idx", "page", "text", "size", "font", "is_bold"])

    return pdfs.where("skip_reason is null").select("doc_id", "content").mapInPandas(run, SPAN_TYPE)


def service_outcome(status: Column, body: Column) -> Column:
    """struct(tei_xml, error, ok) of an answer: 200 is a document, 204 an empty one, anything else the start of its body."""
    return F.struct(
        F.when(status == 200, body).alias("tei_xml"),
        F.when(status == 200, None).when(status == 204, F.lit("no content could be extracted")).otherwise(F.substring(F.coalesce(body, F.lit("")), 1, 500)).alias("error"),
        ((status == 200) & body.isNotNull()).alias("ok"),
    )


def backoff(attempt: int, least: float = 4.0, most: float = 30.0) -> float:
    """Seconds to wait after an attempt, the first being 0."""
    return min(most, max(least, 2.0**attempt))


def call_service(
    pdfs: DataFrame, call: Callable[[str, bytes, dict], tuple[int, str]], service: str = "processFulltextDocument", options: dict | None = None, defaults: dict | None = None,
    concurrency: int = 4, attempts: int = 3, pause: Callable[[int], float] = backoff,
) -> DataFrame:
    """(doc_id, tei_xml, error, ok, status_code) of every file, with `concurrency` requests at a time.

    call(service, content, options) gives status and body and may raise
    ConnectionError or TimeoutError, which are tried again after a pause.  An option given here goes
    before its default.  A failure is a row, not an end of the job.
    """
    if service not in TEI_SERVICES:
        raise ValueError(f"unknown service {service!r}")
    asked = {k: v for k, v in {**(defaults or {}), **{k: v for k, v in (options or {}).items() if v is not None}}.items()}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc, content in zip(pdf["doc_id"], pdf["content"], strict=True):
                status, body = 0, "not tried"
                for k in range(attempts):
                    try:
                        status, body = call(service, bytes(content), asked)
                        break
                    except (ConnectionError, TimeoutError) as e:
                        status, body = 0, str(e)
                        time.sleep(pause(k) if k + 1 < attempts else 0)
                rows.append((doc, status, body))
            yield pd.DataFrame(rows, columns=["doc_id", "status_code", "body"])

    answers = pdfs.where("skip_reason is null").select("doc_id", "content").repartition(concurrency).mapInPandas(run, "doc_id string, status_code int, body string")
    return answers.withColumn("o", service_outcome(F.col("status_code"), F.col("body"))).select("doc_id", "o.tei_xml", "o.error", "o.ok", "status_code")


def call_in_order(pdfs: DataFrame, call: Callable[[str, bytes, dict], tuple[int, str]], order: str, **options) -> DataFrame:
    """The answers of call_service in the order of a column of the files, which they get too."""
    return call_service(pdfs, call, **options).join(pdfs.select("doc_id", order), "doc_id").orderBy(order)


def call_text_service(texts: DataFrame, call: Callable[[str, bytes, dict], tuple[int, str]], service: str, **options) -> DataFrame:
    """As call_service for (doc_id, text): citations, affiliations or dates as the text of a document has them."""
    if service not in TEXT_SERVICES:
        raise ValueError(f"{service!r} does not take a text")
    return call_service(texts.select("doc_id", F.encode("text", "UTF-8").alias("content"), F.lit(None).cast("string").alias("skip_reason")), call, service, **options)


#: What a converter gives of each item of a document.
ITEM_TYPE = "struct<kind:string,caption:string,refs:array<string>,orig:string,text:string,latex:string,prov:array<struct<page_no:int,l:double,t:double,r:double,b:double>>>"
#: The kinds of items that are assets.
ASSET_KINDS = {"PictureItem": "picture", "TableItem": "table", "EquationItem": "formula"}


def convert(pdfs: DataFrame, converter: Callable[[bytes], list[dict]]) -> DataFrame:
    """(doc_id, items, error, ok) of files without a skip_reason; converter(content) gives ITEM_TYPE as dictionaries, and what it raises is the row's error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc, content in zip(pdf["doc_id"], pdf["content"], strict=True):
                try:
                    rows.append((doc, list(converter(bytes(content))), None, True))
                except Exception as e:  # noqa: BLE001
                    rows.append((doc, [], f"{type(e).__name__}: {e}", False))
            yield pd.DataFrame(rows, columns=["doc_id", "items", "error", "ok"])

    return pdfs.where("skip_reason is null").select("doc_id", "content").mapInPandas(run, f"doc_id string, items array<{ITEM_TYPE}>, error string, ok boolean")


def assets_of(converted: DataFrame) -> DataFrame:
    """(doc_id, ai, asset_type, caption, text, page_number, bbox) of the pictures, tables and formulas, in order.

    Without a caption of its own an asset has the joined texts that it refers to.
    """
    kinds = F.create_map(*[F.lit(x) for kv in ASSET_KINDS.items() for x in kv])
    found = F.filter("items", lambda i: i["kind"].isin(list(ASSET_KINDS)))
    one = converted.select("doc_id", F.posexplode(found).alias("ai", "i")).select("doc_id", "ai", "i.*")
    text = F.when(F.col("kind") == "EquationItem", picked_asset_text(F.col("orig"), F.col("text"), F.col("latex"))).when(F.col("kind") == "TableItem", F.col("text"))
    caption = F.coalesce(F.nullif("caption", F.lit("")), F.nullif(F.array_join("refs", " "), F.lit("")))
    return one.select("doc_id", "ai", F.try_element_at(kinds, F.col("kind")).alias("asset_type"), caption.alias("caption"), text.alias("text"), asset_place(F.col("prov")).alias("p")).select("doc_id", "ai", "asset_type", "caption", "text", "p.page_number", "p.bbox")


def convert_summary(converted: DataFrame) -> DataFrame:
    """(n_ok, n_total) of conversions with a boolean `ok`."""
    return converted.agg(F.count_if("ok").alias("n_ok"), F.count("*").alias("n_total"))


def picked_asset_text(orig: Column, text: Column, latex: Column) -> Column:
    """The first of a formula's texts that isn't empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in (orig, text, latex)])


def asset_place(prov: Column) -> Column:
    """struct(page_number, bbox) of the first place of an asset given as array<struct<page_no,l,t,r,b>>."""
    first = F.get(prov, F.lit(0))
    box = F.when(first.isNotNull(), F.struct(first["l"].cast("double").alias("x1"), first["t"].cast("double").alias("y1"), first["r"].cast("double").alias("x2"), first["b"].cast("double").alias("y2")))
    return F.struct(first["page_no"].cast("int").alias("page_number"), box.alias("bbox"))


def fetch_pdfs(papers: DataFrame, present: DataFrame, fetch: Callable[[str], bytes], key: str = "arxiv_id", concurrency: int = 4, attempts: int = 3, most_mb: int = 50, pause: Callable[[int], float] = backoff) -> DataFrame:
    """(key, content, skip_reason) of the papers whose file isn't there yet; fetch(url) gives the bytes.

    A failed download, tried again after pauses, `attempts` times in all, or a file that is too large is
    a row with a reason and without content.  Papers in `present` are left out.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for paper, url in zip(pdf["key"], pdf["url"], strict=True):
                content, reason = None, "no address"
                for k in range(attempts if url else 0):
                    try:
                        content, reason = fetch(url), None
                        break
                    except (ConnectionError, TimeoutError, OSError) as e:
                        reason = f"download failed: {e}"
                        time.sleep(pause(k) if k + 1 < attempts else 0)
                if content is not None and len(content) / 1048576 > most_mb:
                    content, reason = None, f"PDF too large ({len(content) / 1048576:.1f} MB)"
                rows.append((paper, content, reason))
            yield pd.DataFrame(rows, columns=["key", "content", "skip_reason"])

    wanted = papers.join(present.select(key), key, "left_anti").select(F.col(key).alias("key"), F.col("pdf_url").alias("url"))
    return wanted.repartition(concurrency).mapInPandas(run, "key string, content binary, skip_reason string").withColumnRenamed("key", key)


def wait_until_ready(probe: Callable[[], bool], attempts: int = 30, pause: float = 2.0) -> None:
    """Ask a service until it answers; an error after `attempts`."""
    for _ in range(attempts):
        if probe():
            return
        time.sleep(pause)
    raise TimeoutError(f"no answer after {attempts} attempts")


def remove(spark: SparkSession, paths: list[str]) -> int:
    """Delete files on any file system that Spark reaches; gives how many were there."""
    jvm, done = spark.sparkContext._jvm, 0
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        done += bool(where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, False))
    return done
