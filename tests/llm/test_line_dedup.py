import corpus_pipeline
from clickflow.llm import line_dedup


def cleaned(df, **options):
    return {r.doc_id: (r.text, r["__removed"]) for r in line_dedup.line_dedup(df, **options).collect()}


def test_lines_of_many_pages_go_from_their_host_only(documents):
    pages = [(i, f"menu\nown {i}\n\n  \nmenu", "a", "en") for i in range(6)]
    other = [(10 + i, f"menu\nhere {i}" if i == 0 else f"here {i}", "b", "en") for i in range(6)]
    found = cleaned(documents(*pages, *other), min_pages=3, max_ratio=0.5)
    assert found[0] == ("own 0\n\n  ", 2)
    assert found[10] == ("menu\nhere 0", 0)


def test_ratio_must_be_exceeded_and_a_page_counts_once(documents):
    pages = [(i, "x" if i < 3 else f"y\ny {i}", "a", "en") for i in range(6)]
    assert cleaned(documents(*pages), min_pages=1, max_ratio=0.5)[0] == ("x", 0)
    assert cleaned(documents(*pages), min_pages=1, max_ratio=0.49)[0] == ("", 1)
    repeated = [(i, "z\nz\nz" if i == 0 else f"only {i}", "a", "en") for i in range(4)]
    assert cleaned(documents(*repeated), min_pages=2, max_ratio=0.1)[0] == ("z\nz\nz", 0)


def test_nulls_empty_texts_and_other_columns(documents):
    pages = [(i, "ad", None, "en") for i in range(4)] + [(8, None, None, "en"), (9, "", None, "en")]
    df = documents(*pages)
    found = cleaned(df, min_pages=2, max_ratio=0.5)
    assert found[0] == ("", 1) and found[8] == (None, 0) and found[9] == ("", 0)
    assert line_dedup.line_dedup(df).columns == [*df.columns, "__removed"]
    assert cleaned(documents()) == {}


def test_copies_do_not_make_their_own_lines_boilerplate(spark, documents):
    text = "copied line one\ncopied line two"
    copies = [(i, text, "a", "en") for i in range(20)]
    own = [(100 + i, f"menu\nown {i}", "a", "en") for i in range(40)]
    df = documents(*copies, *own, (200, None, "a", "en"), (201, "", "a", "en"))
    found = cleaned(df, copies_once=True)
    assert all(found[i] == (text, 0) for i in range(20))
    assert all(found[100 + i] == (f"own {i}", 1) for i in range(40))
    assert found[200] == (None, 0) and found[201] == ("", 0)
    staged = corpus_pipeline.dedup_lines(spark, df, "")
    assert {r.text for r in staged.filter("doc_id < 20").collect()} == {text}
