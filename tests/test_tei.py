import pytest
from pyspark.sql import functions as F

from inkloom.operators import tei

NS = 'xmlns="http://www.tei-c.org/ns/1.0"'
LONG = "one two three four five six seven eight nine ten eleven"


def paper(body="", header="", back="", abstract=f"<abstract><div><p>{LONG} twelve.</p></div></abstract>"):
    return f'<TEI {NS}><teiHeader><fileDesc><titleStmt><title level="a">A  Title</title></titleStmt>{header}</fileDesc><profileDesc>{abstract}</profileDesc></teiHeader><text><body>{body}</body><back>{back}</back></text></TEI>'


BODY = f"<div><head>1 Introduction</head><p>{LONG}</p><p>Second {LONG}.</p></div><div><head>2 Background</head><p>{LONG}</p></div><div><head>Acknowledgements</head><p>We thank the reviewers.</p></div>"


def chunks(xml, **options):
    return [tuple(c.values()) for c in tei.parse_tei_to_chunks(xml, **options)]


def test_sections_in_order():
    assert chunks(paper(BODY)) == [("title", 0, "A Title"), ("abstract", 0, f"{LONG} twelve."), ("1 Introduction", 0, f"{LONG} Second {LONG}."), ("2 Background", 0, LONG)]
    assert "abstract" not in {c[0] for c in chunks(paper(BODY), abstract=False)}
    assert {c[0] for c in chunks(paper(BODY), skip=frozenset({"background"}))} == {"title", "abstract", "1 Introduction"}


def test_long_paragraphs_are_cut_at_sentences():
    text = " ".join(f"Sentence {i} has quite a few words in it." for i in range(20))
    found = [c for c in chunks(paper(f"<div><head>X</head><p>{text}</p></div>"), max_words=20) if c[0] == "X"]
    assert len(found) > 5 and all(len(c[2].split()) <= 20 for c in found) and [c[1] for c in found] == list(range(len(found)))


def test_nested_headings_are_inherited():
    found = chunks(paper(f"<div><head>H</head><p>{LONG}</p><div><p>inner {LONG}</p></div></div>"))
    assert found[2:] == [("H", 0, LONG), ("H", 0, f"inner {LONG}")]


def test_authors_and_references():
    author = "<author><persName><forename>Ada</forename><surname>L</surname></persName><affiliation><orgName>X</orgName><orgName>Y</orgName></affiliation><email>a@b</email></author>"
    found = chunks(paper(header=f"<sourceDesc><biblStruct><monogr>{author}</monogr></biblStruct></sourceDesc>", back='<div type="references"><listBibl><biblStruct><analytic><title>T</title><author><persName>Z Q</persName></author></analytic><monogr><title>J</title><imprint><date when="2001"/></imprint></monogr></biblStruct></listBibl></div>' + f"<div><head>Annex</head><p>{LONG}</p></div>"))
    assert found[0] == ("authors", 0, "Ada L (X, Y) <a@b>")
    assert found[-2:] == [("references", 0, "Z Q. T. J. (2001)"), ("Annex", 0, LONG)]


def test_figures_and_notes_are_left_out():
    found = chunks(paper(f"<div><head>H</head><p>{LONG}<figure><head>no</head></figure> tail <note>no</note>end</p></div>"))
    assert found[-1] == ("H", 0, f"{LONG} tail end")


def test_bad_xml_is_a_row(spark):
    rows = spark.createDataFrame([("a", paper(BODY)), ("b", "<TEI"), ("c", "<!DOCTYPE x><TEI/>"), ("d", None)], "doc_id string, tei_xml string")
    found = tei.tei_chunks(rows).collect()
    assert [r["ord"] for r in found if r["doc_id"] == "a"] == [0, 1, 2, 3]
    assert {r["doc_id"] for r in found if r["error"]} == {"b", "c", "d"}


def test_figure_references_in_four_passes(spark):
    body = '<figure xml:id="f1" coords="1,2,3,4,5"><head>Figure 1</head><figDesc>loss</figDesc></figure><div><head>Table 9: orphan</head><p>See <ref type="table" xml:id="t">2</ref> and <ref type="figure" coords="8,1,2,3,4">5</ref>.</p></div>'
    doc = spark.createDataFrame([(paper(body),)], "x string").select(tei.tei_document(F.col("x")).alias("d")).first()["d"]
    assert [(f["fig_id"], f["label"], f["caption"], f["coords"]) for f in doc["figure_refs"]] == [("f1", "Figure 1", "loss", "1,2,3,4,5"), (None, "Table 9", "orphan", None), (None, "Figure 5", None, "8,1,2,3,4"), ("t", "Table 2", None, None)]
    assert doc["title"] == "A  Title" and doc["sections"][0]["heading"] == "Table 9: orphan"


def test_unknown_options():
    with pytest.raises(TypeError):
        tei.parse_tei_to_chunks(paper(), nothing=1)
