import random
import re

from pyspark.sql import functions as F

from inkloom.functions import text as t

WS_TRAPS = ["a\u2003b \x1c c", "\xa0 x \u3000y\u2028z ", "  plain  ", "", "\n\n", "ﬁne Å"]


def column(spark, values, f, *more):
    rows = spark.createDataFrame([(i, v, *m) for i, (v, *m) in enumerate(zip(values, *more, strict=True))], "i int, x string" + "".join(f", y{k} string" for k in range(len(more))))
    return [r[0] for r in rows.orderBy("i").select(f(F.col("x"), *[F.col(f"y{k}") for k in range(len(more))])).collect()]


def test_white_space_is_pythons(spark):
    assert column(spark, WS_TRAPS, t.squeeze) == [" ".join(x.split()) for x in WS_TRAPS]
    assert column(spark, WS_TRAPS, t.strip) == [x.strip() for x in WS_TRAPS]
    assert column(spark, WS_TRAPS, t.word_count) == [len(x.split()) for x in WS_TRAPS]


#: Texts and what is left of them.
CLEANED = [
    ("a pro-\ncess and a semi- colon", "a process and a semi- colon"),
    ("x-\ny-\nz", "xy-\nz"),
    ("body\nReferences\n[1] gone", "body"),
    ("body\n  works   CITED \ngone", "body"),
    ("body\nReferences to others\nstay", "body\nReferences to others\nstay"),
    ("body\nAcknowledgments\nthanks", "body"),
    ("body\nAcknowledgements\nthanks\nBibliography\nx", "body"),
    ("top arXiv:2401.12345v2  [cs.CL] 3 Jan 2024 end", "top end"),
    ("a\n 12 \nb\nPage 7\nc\n12345", "a\nb\nc\n12345"),
    ("as in [1, 2] and [3–5], not [a]", "as in and , not [a]"),
    ("shown (Smith et al., 2020; Doe, 1999a) and (see Smith, 2020)", "shown and (see Smith, 2020)"),
    ("Figure 3: loss, fig. 12. gain, table 4 stays", "loss, gain, table 4 stays"),
    ("let \\mathbf{x} be \\alpha now", "let be now"),
    ("  many\t\tblanks   \n\n\n\n and lines \r\nhere\u2028there\x1cend ", "many blanks\nand lines\nhere\nthere\nend"),
    ("ﬁne Å², Ａ…", "fine Å2, A..."),
    ("1. Figure", "1. Figure"),
    ("", ""),
    (" \n\t\xa0", ""),
]


PARTS = ["word ", "pro-\ncess ", "[1, 2] ", "[3–5]", "(Smith et al., 2020; Doe, 1999a) ", "Figure 3: ", "fig. 1. ", "\\mathbf{x} ", "\\alpha ", "\n", "\n\n\n", "12\n", "\nPage 7\n", "  ", "\t\t", "arXiv:2401.12345v2 [cs.CL] 3 Jan 2024", "\nReferences\n", "\n Works  Cited \n", "\nAcknowledgements\n", "## References\n", "ﬁ", "\u2028", "\r\n", "é", "\x1c"]


def test_cleaned_texts(spark):
    assert column(spark, [x for x, _ in CLEANED], t.clean) == [y for _, y in CLEANED]
    assert column(spark, [None], t.clean) == [""]


def test_what_holds_for_any_cleaned_text(spark):
    """Lines are neither empty nor blank at their ends, blanks are single, nothing that a step removes is left whole, and order stays."""
    rng = random.Random(1)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(300)]
    for before, after in zip(texts, column(spark, texts, t.clean), strict=True):
        assert after == after.strip() and all(line and line == line.strip() for line in after.split("\n") if after)
        assert not any(x in after for x in ("[1, 2]", "\\alpha", "\\mathbf", "\nReferences\n", "\nAcknowledgements\n", "ﬁ", "\u2028", "\r", "\x1c", "\t\t"))
        assert after.count("word") <= before.count("word")


def test_builtin_path_equals_udf_path_on_ascii(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice([p for p in PARTS if p.isascii()]) for _ in range(rng.randint(0, 14))) for _ in range(200)]
    assert column(spark, texts, lambda x: t.clean(x, normalise=False)) == column(spark, texts, t.clean)


def test_truncation_goes_back_to_a_sentence(spark):
    def brute(x, n=5):
        cut = x[: n * 4]
        at = cut.rfind(". ")
        return x if len(x) <= n * 4 else cut[: at + 1] if at > n * 4 * 0.8 else cut

    texts = ["short", "a" * 17 + ". bcdefgh", "a. " + "b" * 30, "x" * 20, "x" * 21, "a" * 18 + ". bcd"]
    assert column(spark, texts, lambda x: t.truncate_tokens(x, 5)) == [brute(x) for x in texts]


def test_identifiers(spark):
    urls = ["http://arxiv.org/abs/2401.12345v2", "2401.12345", "http://arxiv.org/abs/hep-th/9901001v1", "solv-int/9701001"]
    assert column(spark, urls, t.canonical_id) == ["2401.12345", "2401.12345", "hep-th/9901001", "solv-int/9701001"]
    assert column(spark, urls, t.entry_id) == [u.split("/")[-1] for u in urls]
    assert column(spark, urls, t.strip_version) == [u.rsplit("v", 1)[0] if "v" in u else u for u in urls]


def test_captions(spark):
    stops = set(t.CAPTION_STOPS)

    def jaccard(a, b):
        x, y = (set(re.findall(r"\w+", s.lower())) - stops for s in (a, b))
        return len(x & y) / len(x | y) if x and y else 0.0

    a = ["Figure 1: the loss of Model", "table", "α β", ""]
    b = ["Loss model curve", "Table 2", "β γ", "x"]
    assert column(spark, a, t.caption_similarity, b) == [jaccard(*p) for p in zip(a, b, strict=True)]
    found = column(spark, ["Fig. 3 : A\nb", "Table 12.x", "See Figure 1: no"], t.caption_parts)
    assert [f and tuple(f) for f in found] == [("Fig. 3", "A\nb"), ("Table 12", "x"), None]


def test_lines_of_authors_and_references(spark):
    row = spark.range(1).select(
        t.author_line(F.lit("A B"), F.array(F.lit("X"), F.lit(""), F.lit("Y")), F.lit("a@b")),
        t.author_line(F.lit(""), F.array().cast("array<string>"), F.lit("")),
        t.reference_line(F.array(F.lit("A"), F.lit("B")), F.lit("T"), F.lit(""), F.lit("1999")),
        t.section_key(F.lit("3.1  Related Work ")),
        t.image_link(F.lit("c"), F.lit("p.png")),
        t.model_text(F.lit(""), F.lit("x")),
    ).first()
    assert tuple(row) == ("A B (X; Y) <a@b>", "", "A, B. T. (1999)", "related work", "![c](p.png) c", "x")
