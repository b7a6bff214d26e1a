from pyspark.sql import functions as F

from corpuslab.functions import frontmatter as M
from corpuslab.operators import articles


def parsed(spark, *texts):
    """(path, kind, text) of the entries of each text, in one query."""
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", M.entries(F.col("t")).alias("e")).collect()
    found = {r["i"]: None if r["e"] is None else [(e["path"], e["kind"], e["text"]) for e in r["e"]] for r in rows}
    return [found[i] for i in range(len(texts))]


def items(spark, *texts):
    """Kind and items of key k in each text."""
    e = M.find(M.entries(F.col("t")), "k")
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", e.alias("e")).collect()
    found = {r["i"]: (r["e"]["kind"], None if r["e"]["items"] is None else [tuple(x) for x in r["e"]["items"]]) for r in rows}
    return [found[i] for i in range(len(texts))]


def test_scalars_have_types(spark):
    values = {
        "a b": "str", "12": "int", "-0x1F": "int", "1_000": "int", "1.5": "float", ".inf": "float", "1e5": "str", "yes": "bool", "Off": "bool",
        "y": "str", "~": "null", "": "null", "2024-02-29": "date", "2024-02-30": "str", "2024-01-02T03:04:05Z": "time", "'12'": "str", '"yes"': "str",
        "10:30": "int", "a # note": "str", "# note": "null", "a#b": "str", "http://x/y": "str", "a: b": "error", "'open": "error", '"a" b': "error",
        "@x": "error", "- a": "error", "-a": "str", "[a": "error", "{a: b}": "map", "é": "str",
    }
    rows = spark.createDataFrame([(f"k: {v}",) for v in values], "t string").select(M.entries(F.col("t")).alias("e")).collect()
    assert {v: r["e"][0]["kind"] for v, r in zip(values, rows, strict=True)} == values


def test_quoted_values_and_values_over_lines(spark):
    block = "k: |\n  a\n    b\n\n  # c\nl: >\n  a\n  b\n\n  c\n\nm: |-\n  x\n\nn: |+\n  y\n\no: |\np: 1"
    got = parsed(
        spark, 'k: "a \\"b\\" \\\\n \\t. # no"  # yes', "k: 'it''s'", "k: ''", "'q k': 1\n\"7\": x", "k: a\n  b\n\n  c\nl:\n  d\r\n  e", block,
        "m:\n  a: 1\n  b:\n    - x\n  c:\n    d: e\nn: x", "k: 1\nk: 2", None, "",
    )
    assert got[:5] == [
        [("k", "str", 'a "b" \\n \t. # no')], [("k", "str", "it's")], [("k", "str", "")], [("q k", "int", "1"), ("7", "str", "x")],
        [("k", "str", "a b c"), ("l", "str", "d e")],
    ]
    assert [(p, t) for p, _, t in got[5]] == [("k", "a\n  b\n\n# c\n"), ("l", "a b\nc\n"), ("m", "x"), ("n", "y\n\n"), ("o", ""), ("p", "1")]
    assert [(p, k) for p, k, _ in got[6]] == [("m", "map"), ("m.a", "int"), ("m.b", "list"), ("m.c", "map"), ("n", "str")]
    assert got[7:] == [[("k", "int", "1"), ("k", "int", "2")], None, []]


def test_lists(spark):
    got = items(
        spark, "k: [a, \"b, c\", 'd', 3, yes,]", "k: []  # none", "k: [a] b", "k:\n- a\n- 'b: c'\n-\n  d\n# x\n- e: f\n- [g]",
        "k:\n  - a\n    b\n  - 2024-01-01", "k: 1\nk: [x]",
    )
    assert got[0] == ("list", [("str", "a"), ("str", "b, c"), ("str", "d"), ("int", "3"), ("bool", "yes")])
    assert got[1] == ("list", []) and got[2][0] == "error"
    assert got[3] == ("list", [("str", "a"), ("str", "b: c"), ("str", "d"), ("map", "e: f"), ("list", "[g]")])
    assert got[4] == ("list", [("str", "a b"), ("date", "2024-01-01")]) and got[5] == ("list", [("str", "x")])


def test_what_is_no_mapping(spark):
    cases = [
        ("a: 1", True, True), ("a: 1\noops", False, True), ("- a", True, False), ("", True, False), ("# c", True, False), ("just text", False, False),
        ("m:\n  a: 1\n b: 2", False, True), ("  a: 1\n b: 2", False, True), ("k: [@a]", False, True),
    ]
    rows = spark.createDataFrame(cases, "t string, p boolean, m boolean").select("t", M.entries(F.col("t")).alias("e"))
    got = {(r["t"], r["p"], r["m"]) for r in rows.select("t", M.parses(F.col("e")).alias("p"), M.is_mapping(F.col("e")).alias("m")).collect()}
    assert got == set(cases)


def test_long_front_matter(spark):
    long = 'k: "' + 'x\\"' * 50_000 + '"\nl: |\n' + "  line\n" * 5_000 + "n:\n" + "- a\n" * 5_000 + "m: 1"
    got = parsed(spark, long)[0]
    assert [len(t) for _, _, t in got] == [100_000, 25_000, 19_999, 1] and got[3] == ("m", "int", "1")


FRONT = {"title": "T", "subtitle": "s", "slug": "a-1", "author": "a b", "date": "2024-01-02", "dateline": "CITY", "tags": "[x]", "summary": "z", "image": "i.png"}


def article(name="a-1.md", body="text", **changed):
    fields = {**FRONT, **changed}
    return name, "---\n" + "".join(f"{k}: {v}\n" for k, v in fields.items() if v is not None) + "---\n" + body


def broken(spark, *files):
    rows = spark.createDataFrame(list(files), "name string, content string")
    out = articles.violations(articles.parse_articles(rows))
    return {(r["name"], r["content"]): r["violations"] for r in out.collect()}


def test_values_of_other_types_break_their_field(spark):
    cases = [
        (article(), []), (article(title="12"), ["field title"]), (article(author="yes"), ["field author"]), (article(author="'yes'"), []),
        (article(summary=""), ["field summary"]), (article(subtitle=None), ["field subtitle"]), (article(tags="x"), ["field tags"]),
        (article(tags="[]"), ["field tags"]), (article(tags="[x, 2]"), ["field tags"]), (article(tags="[x, '']"), ["field tags"]), (article(tags="\n- x"), []),
        (article(date="'2024-02-30'"), ["date format"]), (article(date="5"), ["field date", "date format"]), (article(image="{a: b}"), ["field image"]),
        (article(body=" \n"), ["body"]), (article(slug="12"), ["field slug"]), (article(name="b.md"), ["name equals slug"]),
        (article(image="a: b"), ["front matter parses"]), (("a-1.md", "---\n- a\n---\nx"), ["front matter is a mapping"]),
        (("a-1.md", "---\n---\nx"), ["front matter is a mapping"]), (("a-1.md", "---\na: 1\n"), ["front matter closes"]), (("a-1.md", ""), ["front matter opens"]),
    ]
    got = {}
    rows = spark.createDataFrame([(i, *c[0]) for i, c in enumerate(cases)], "i int, name string, content string")
    for r in articles.violations(articles.parse_articles(rows)).collect():
        got[r["i"]] = [v for v in r["violations"] if v != "slug unique"]
    assert got == {i: c[1] for i, c in enumerate(cases)}


def test_slugs_are_unique(spark):
    files = [article(body=f"b{i}") for i in range(40)] + [article(name="c.md", slug="c"), (None, None), ("x.md", "no mark")]
    got = broken(spark, *files)
    assert len(got) == 43 and all(got[f] == ["slug unique"] for f in files[:40]) and got[files[40]] == []
