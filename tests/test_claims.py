import pytest
from pyspark.sql import functions as F

from skein.functions import text as T
from skein.functions.html import strip_html
from skein.functions.markdown import plain_markdown, plain_mdx
from skein.operators import claims as C


def claims(spark, text):
    return C.claim_rows(spark.createDataFrame([(1, text)], "doc_id int, text string"), internal=True).orderBy("para", "sent", "clause").collect()


@pytest.mark.parametrize("text", ["Is this a claim about the world?", "Is it really so?!", "Is that what the data shows?[1]", "Consider the evidence that was given here.", None, ""])
def test_no_claim(spark, text):
    assert claims(spark, text) == []


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        ("Unemployment fell by 5 percent across the region.", "statistical"),
        ("The company should release the figures to everyone.", "normative"),
        ("Consider this: the firm must pay its own way.", "normative"),
        ("Inflation refers to a rise in prices over time.", "definitional"),
        ("The bridge failed because of poor steel and rain.", "causal"),
        ("The clinical trial was run on one site.", "medical"),
        ("The court was silent on the matter of leave.", "legal"),
        ("The stock was sold to a new owner.", "financial"),
        ("The town was rebuilt during the long war.", "historical"),
        ("The system is slow on old machines.", "empirical"),
        ("The cat is asleep on the mat.", "descriptive"),
    ],
)
def test_types(spark, text, kind):
    found = claims(spark, text)
    assert [c["type"] for c in found] == [kind]
    assert 0 <= found[0]["support_in_text"] <= 1


def test_clauses(spark):
    assert len(claims(spark, "Taxes rose sharply in spring, and wages fell across the country.")) == 2
    assert len(claims(spark, "The report was late, but that is fine.")) == 1
    assert len(claims(spark, "The papers were read and show the same thing.")) == 1


def test_attribution_and_citation(spark):
    found = claims(spark, 'The mayor wrongly said "the bridge is safe for all".')
    assert {"attributed_quote", "refuted_in_text"} <= set(found[0]["risk_flags"])
    assert claims(spark, "The reef is dying [1, 2].")[0]["support_in_text"] >= 0.5
    assert claims(spark, "The reef is dying [2].")[0]["type"] != "statistical"


def test_sentences(spark):
    text = "Dr. Smith was there. He saw e.g. Berlin.[2] The 3. Mai was cold. It ended in 1999. Then it rained."
    row = spark.createDataFrame([(text,)], "t string").select(T.sentences(F.col("t"))).first()[0]
    assert row == ["Dr. Smith was there.", "He saw e.g. Berlin.[2]", "The 3. Mai was cold.", "It ended in 1999.", "Then it rained."]


def test_quotes(spark):
    first, second = "The first sentence is here for context.", "The second one is the claim."
    assert claims(spark, f"{first} {second}")[1]["quote"] == f"{first} {second}"
    assert claims(spark, f"{first}\n\n{second}")[1]["quote"] == second
    long = "This is a word " * 30 + "end."
    got = claims(spark, f"{long} {second}")[-1]["quote"]
    assert len(got) <= 300 and got.startswith("…") and got.endswith(second)
    assert len(claims(spark, "x" * 400 + " is long.")[0]["quote"]) == 300


def test_refining_and_headings(spark):
    rows = [("it is what they said to us", True), ("Two words", True), ("This, they said, is what matters", True), ("Taxes rose sharply in the spring", False), ("", False)]
    got = spark.createDataFrame(rows, "t string, e boolean").select(T.needs_refining(F.col("t")).alias("r"), "e").collect()
    assert all(r["r"] == r["e"] for r in got)
    heads = [("# Title", True), ("[Page 3]", True), ("A Short Heading", True), ("LOUD WORDS", True), ("A plain sentence.", False), ("It'S Odd", True)]
    got = spark.createDataFrame(heads, "t string, e boolean").select(T.is_heading(F.col("t")).alias("r"), "e", "t").collect()
    assert all(r["r"] == r["e"] for r in got), got


def test_jaccard(spark):
    rows = [("green apples taste fine", "green apples taste fine", 1.0), ("green apples", "blue pears", 0.0), ("", "x", 0.0), ("the green apples", "green pears", 1 / 3)]
    got = spark.createDataFrame(rows, "a string, b string, e double").select(T.jaccard(T.token_set(F.col("a")), T.token_set(F.col("b"))).alias("j"), "e").collect()
    assert all(r["j"] == pytest.approx(r["e"]) for r in got)


def test_genre(spark):
    told = '"Come in," he said.\n\n"No," she replied and closed the door.'
    cited = "# A\n\n# B\n\nThe study gives data and evidence [1]."
    got = [r[0] for r in spark.createDataFrame([(1, told), (2, cited), (3, "Nothing here")], "k int, t string").orderBy("k").select(T.genre(F.col("t"))).collect()]
    assert got == ["fiction", "nonfiction", "unknown"]


def test_markup():
    assert strip_html("<p>a &amp; b</p><!-- c --><div>d<br>e</div>") == "a & b\n\nd\ne"
    assert strip_html(None) == ""
    assert plain_markdown("**bold** [link](u) ![i](u) `a*b` $5 and $6 x<sup><a>2</a></sup> $x_1$ | t |") == "bold link i a*b $5 and $6 x[2] $x_1$ | t |"
    assert plain_markdown("| a | b |\ntext[^1] <b>x</b>") == "text[1] x"
    assert plain_markdown("x <sup>[1, 2]</sup> y [![a](b)](c) **d `e*f` g** _h_ __i__ <!-- j --> k<br>l \\$5") == "x[1, 2] y a d e*f g h i  k\nl \\$5"
    assert plain_markdown("```\n*a* | b\n```\n$$c_d_e$$ *f*") == "```\n*a* | b\n```\n$$c_d_e$$ f"
    fenced = 'import {\n A,\n B } from "x"\n\n```\nimport a from "b"\n```\n<Box a="1">\n<In>\nhi\n</In>\n<Self x={1} />\n</Box>\n<Open>\nexport const q = {\n a: {b: 1}\n}\nend'
    assert plain_mdx(fenced).split() == ["```", "import", "a", "from", '"b"', "```", "hi", "<Open>", "end"]
    assert plain_mdx('import A from "a"\n<Box>\ntext\n</Box>\nexport const x = {\n a: 1\n}\nend').split() == ["text", "end"]


def test_strip_takes_what_patterns_take(spark):
    """Every character at either end, as by the class of white space; normalised text as by patterns."""
    ends = spark.createDataFrame([(chr(k),) for k in range(1, 0x3100)], "c string")
    x = F.concat("c", F.lit("a b"), "c")
    by_pattern = F.regexp_replace(F.regexp_replace(x, f"{T.FLAGS}^{T.SPACE}+", ""), f"{T.FLAGS}{T.SPACE}+\\z", "")
    assert ends.where(T.strip(x) != by_pattern).collect() == [] and ends.where(T.strip(x) == "a b").count() == len(T.SPACES)
    texts = ["a  \n  \n   b\r\n\r\n\r\n c\rd\te \x0b\n\x0c\n\n f ", None, "", "a \n\n\n\nb", "\n\n a\n b", "x\r"]
    y = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.coalesce("t", F.lit("")), "\\r\\n?", "\n"), "[\\t\\x0b\\x0c]", " "), " *\\n *", "\n")
    y = T.strip(F.regexp_replace(y, "\\n{3,}", "\n\n"))
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert rows.where(T.normalised(F.col("t")) != y).collect() == []


def test_trees_accept_the_same_words():
    import random
    import re

    from skein.functions import lexicon as L

    draw = random.Random(2)
    for name, alternation in vars(L).items():
        if name.isupper() and isinstance(alternation, str) and name not in ("AMOUNT", "QUANTITY_WORDS", "CITATION", "URL", "QUOTED"):
            plain, quick = re.compile(f"\\b(?:{alternation})\\b"), re.compile(f"\\b{T.tree(alternation)}\\b")
            pieces = [w for w in re.sub(r"\\d\{[^}]*\}", "1999", re.sub(r"\(\?:([a-z]+)[^)]*\)\??", r"\1", alternation)).replace("?", "").split("|")]
            assert all(bool(plain.search(w)) == bool(quick.search(w)) for w in pieces) and sum(bool(quick.search(w)) for w in pieces) > len(pieces) * 0.9
            for _ in range(300):
                text = " ".join(draw.choice(pieces)[: draw.randint(1, 12)] + draw.choice(("", "s", "ed", " 19")) for _ in range(3))
                assert bool(plain.search(text)) == bool(quick.search(text)), (name, text)


def test_arrays_are_computed_once(spark):
    """No filter is inferred that cuts text into paragraphs, sentences or clauses once more."""
    docs = spark.createDataFrame([(1, "The cat is asleep. It rained.")], "doc_id int, text string")
    plan = C.claim_rows(docs, internal=True)._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.split("\n") if line.strip(" +-:").startswith("Filter") and "size(" in line]


def test_pages_come_in_small_batches(spark):
    """Workers hold a few hundred pages at once, however many a partition has."""
    from skein.functions import html

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    try:
        rows = spark.range(600).coalesce(1).select(html.html_text(F.concat(F.lit("<p>a &amp; b"), F.col("id").cast("string"))).alias("t"))
        assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 256
        assert {r.t for r in rows.collect()} == {f"a & b{k}" for k in range(600)}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
