import random

from pyspark.sql import functions as F

from ledgerloom.llm import linededup

from .plain import without_boilerplate


def test_against_plain(spark):
    rng = random.Random(7)
    lines = [f"line {k}" for k in range(40)] + ["", "  ", " line 3 ", "line 3"]
    pages = [(i, rng.choice(["a", "b", "c", None]), "\n".join(rng.choices(lines, k=rng.randint(1, 8)))) for i in range(120)]
    pages += [(500, "a", None), (501, "a", ""), (502, "solo", "only one page\nhere")]
    df = spark.createDataFrame([(*p, "x") for p in pages], "doc_id long, source string, text string, line string")
    out = linededup.drop_boilerplate(df, F.col("source"), dropped="n")
    assert out.columns == [*df.columns, "n"]
    rows = out.collect()
    assert {r.doc_id: r.text for r in rows} == without_boilerplate(pages) and len(rows) == len(pages)
    whole = {i: t for i, _, t in pages}
    assert all((r.n or 0) == 0 or r.text != whole[r.doc_id] for r in rows)


def test_short_lines_stay(spark):
    pages = [(i, "h", f"Yes.\nAll rights reserved.\nbody {i}") for i in range(9)]
    df = spark.createDataFrame(pages, "doc_id long, source string, text string")
    out = linededup.drop_boilerplate(df, F.col("source"), min_chars=5, min_pages=9, dropped="n").collect()
    assert {r.doc_id: r.text for r in out} == without_boilerplate(pages, min_chars=5, min_pages=9) and {r.n for r in out} == {1}
    assert out[0].text.startswith("Yes.\nbody")


def test_null_hosts_and_ids_are_told_from_texts(spark):
    """A page without a host keeps its lines, also where a page without an id has that id for its host."""
    text = "shared line\nbody"
    rows = [(None, "x", text), ("x", None, text), ("-", "x", text), (None, "-", text)] + [(f"p{i}", "x", f"shared line\n{i}") for i in range(5)]
    out = linededup.drop_boilerplate(spark.createDataFrame(rows, "doc_id string, source string, text string"), F.col("source"), ratio=0.5).collect()
    assert sorted((r.doc_id or "", r.source or "", r.text) for r in out if r.text.endswith("body")) == [("", "-", text), ("", "x", "body"), ("-", "x", "body"), ("x", "", text)]


def test_copies_of_a_page_keep_their_lines(spark):
    pages = [(i, "h", "nav\nfirst line\nsecond line") for i in range(50)] + [(100 + i, "h", f"nav\nbody {i}") for i in range(9)]
    out = linededup.drop_boilerplate(spark.createDataFrame(pages, "doc_id long, source string, text string"), F.col("source"))
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts == without_boilerplate(pages) and texts[0] == "first line\nsecond line" and texts[100] == "body 0"


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "h", "nav\nbody one")] * 2 + [(None, "h", "nav\nbody two"), (None, "h", "body three")]
    out = linededup.drop_boilerplate(spark.createDataFrame(rows, "doc_id long, source string, text string"), F.col("source"), ratio=0.5, min_pages=2)
    assert sorted(r.text for r in out.collect()) == ["body one", "body one", "body three", "body two"]


def test_empty_and_native(spark, capsys):
    df = spark.createDataFrame([], "doc_id long, source string, text string")
    out = linededup.drop_boilerplate(df, F.col("source"))
    assert out.count() == 0
    out.explain()
    assert "Python" not in capsys.readouterr().out
