"""Golden rows of the scalar functions, from FIXTURES.md."""

import json

import pytest
from pyspark.sql import functions as F

from lexspark.functions import markup as M
from lexspark.functions import nested as N
from lexspark.functions import nulls as U
from lexspark.functions import text as T
from lexspark.operators import apply as A

ONE = "one"
CASES = [
    (lambda c: M.tags(c), "a <b>x</b> <br/> <Foo bar>", ["<b>", "</b>", "<br/>", "<Foo bar>"]),
    (lambda c: M.tag_type(c), '<P class="x">', "valid_html"), (lambda c: M.tag_fix(c), '<P class="x">', None),
    (lambda c: M.tag_fix(c), "<bobl>", "<bibl>"), (lambda c: M.tag_fix(c), "<xbibl>", "<bibl>"), (lambda c: M.tag_fix(c), "</Biblx>", "</bibl>"),
    (lambda c: M.tag_type(c), "<Prairie>", "malformed_html"), (lambda c: M.tag_type(c, strict=True), "<Prairie>", "non_html"), (lambda c: M.tag_fix(c), "<Prairie>", "<Prairie>"),
    (lambda c: M.tag_type(c), "<Wood Stork>", "non_html"), (lambda c: M.tag_type(c), "<>", "non_html"), (lambda c: M.tag_type(c), "< p>", "non_html"),
    (lambda c: M.tag_type(c), "<https://a.b/c>", "malformed_html"),
    (lambda c: M.repair(c), "<bobl>x</bobl> <<bibl>y</bibl>", "<bibl>x</bibl> <bibl>y</bibl>"), (lambda c: M.repair_count(c), "<bobl>x</bobl> <<bibl>y</bibl>", 2),
    (lambda c: M.repair(c), "<b9bl></p>", "</bibl></p>"), (lambda c: M.repair_count(c), "<b9bl></p>", 2),
    (lambda c: M.balance_bibl(c), "<p><bibl>A, 12</p> z", "<p><bibl>A, 12</bibl></p> z"), (lambda c: M.balance_bibl(c), "<bibl>A, 12.", "<bibl>A, 12</bibl>."),
    (lambda c: M.balance_bibl(c), "<bibl>A", "<bibl>A</bibl>"), (lambda c: M.balance_bibl(c), "<bibl>a</p><bibl>b</p>", "<bibl>a</bibl></p><bibl>b</bibl></p>"),
    (lambda c: M.balance_bibl(c), "A, 12</bibl> z", "<bibl>A, 12</bibl> z"), (lambda c: M.balance_bibl(c), "<bibl>foo</bibl> bar</bibl>", "<bibl><bibl>foo</bibl> bar</bibl>"),
    (lambda c: M.anchor_raw_urls(c), "see <http://a.b/c>.", 'see <a href="http://a.b/c">http://a.b/c</a>.'),
    (lambda c: M.without_citations(c), 'a <bibl>B,\n 1</bibl>  c <BIBL x="1"><em>D</em> <i>E</i></BIBL>', "a c"),
    (lambda c: M.citations(c), 'a <bibl>B,\n 1</bibl>  c <BIBL x="1"><em>D</em> <i>E</i></BIBL>', ["<bibl>B, 1</bibl>", '<BIBL x="1"><em>D</em><i>E</i></BIBL>']),
    (lambda c: M.without_citations(c), "no  match ", "no match"),
    (lambda c: F.to_json(M.crossrefs(c)), "atl (see Molina 1571). x", '[{"text":"see Molina 1571","type":"molina_ref"}]'), (lambda c: M.without_crossrefs(c), "atl (see Molina 1571). x", "atl. x"),
    (lambda c: F.to_json(M.crossrefs(c)), "a (see also <b>tlalli</b>.) b", '[{"text":"also tlalli","type":"see"}]'), (lambda c: M.without_crossrefs(c), "a (see also <b>tlalli</b>.) b", "a b"),
    (lambda c: F.to_json(M.crossrefs(c)), "(cf. x) y [see zz]", '[{"text":"zz","type":"see"}]'), (lambda c: M.without_crossrefs(c), "(cf. x) y [see zz]", " y"),
    (lambda c: F.to_json(M.crossrefs(c)), "a (also see q1) (variant of r2) (also s3)", '[{"text":"q1","type":"also_see"},{"text":"r2","type":"variant"},{"text":"s3","type":"also"}]'),
    (lambda c: M.drop_empty_p(c), "<p>a</p> <p> </p> b", "<p>a</p>b"), (lambda c: M.strip_div_br(c), '<div class="x"> <p> a <br/>b </p> </div>', "<p>a b</p>"),
    (lambda c: N.page_number(c), "Molina, f. 5r.", "5r"), (lambda c: N.page_number(c), "Carochi, pp. 12, 13.", "12"), (lambda c: N.page_number(c), "Karttunen (1983), 6.", "6"),
    (lambda c: N.page_number(c), "Lockhart, 214–215", "214–215"), (lambda c: N.page_number(c), "none", ""),
    (lambda c: A.decision_action(c), "Use scraped, update local", "use_scraped_update_local"), (lambda c: A.decision_action(c), "use scraped to update both", "update_both_from_scraped"),
    (lambda c: A.decision_action(c), "Use local; update scraped (check Spanish attestation)", "use_local_update_scraped"), (lambda c: A.checks_spanish(c), "Use local; update scraped (check Spanish attestation)", True),
    (lambda c: A.decision_action(c), "local value is incorrect", "use_scraped_update_local"), (lambda c: A.decision_action(c), "Actual value in both is None", "delete_local"), (lambda c: A.decision_action(c), "", "skip"), (lambda c: A.decision_action(c), None, "skip"),
    (lambda c: U.is_blank(c), None, True), (lambda c: U.is_blank(c), "  \n", True), (lambda c: U.is_blank(c), "None", False), (lambda c: U.is_blank(c, True), "None", True), (lambda c: U.coerce_int(c), " 12.9 ", 12), (lambda c: U.coerce_int(c), "x", 0), (lambda c: U.coerce_int(c), None, 0),
    (lambda c: T.squeeze(c), "a   b\n", "a b"), (lambda c: T.safe_name(c), "a/b: (c)", "a_b_(c)"), (lambda c: T.prefixed_id(c), "/node/12", 12), (lambda c: T.prefixed_id(c), "x", None), (lambda c: T.headword(c), "atl... ", "atl..."), (lambda c: T.headword(c), "atl...", "atl"),
    (lambda c: M.non_html_tags(c), None, []), (lambda c: M.citations(c), None, []), (lambda c: M.mismatches(c), None, []), (lambda c: M.encode_non_html(c), "<Stork> <b>", "&lt;Stork&gt; <b>"), (lambda c: M.legacy_crossref_class(c), "see Molina", "Scholar_Reference"),
    (lambda c: M.tag_context(c, F.lit("<x>")), "ab<x>c<x>", "ab[[[<x>]]]c[[[<x>]]]"), (lambda c: M.tag_context(c, F.lit("<y>")), "ab", ""),
]
TWO = [
    (T.item_diff, "a | b", "b | c", "ADDED: a || REMOVED: c"), (T.item_diff, "a", "b", None), (T.item_diff, "a | b", "b|a", None), (T.item_diff, None, "x|y", "REMOVED: x | y"),
    (T.first_diff, "abc", "abd", 2), (T.first_diff, "ab", "abc", 2), (T.first_diff, "x", "x", None), (T.first_diff, "", "q", 0), (T.first_diff, None, None, None), (T.first_diff, "𝒜b", "𝒜c", 1),
    (T.length_diff, "abc", "a", "+2"), (T.length_diff, "", "", "0"), (T.length_diff, "a", "abc", "-2"),
    (T.diff_context, "abc", "abd", "Scraped: ...abc... | Local: ...abd..."), (T.diff_context, "ab", "abcdef", "Scraped: ...ab... | Local: ...ab..."), (T.diff_context, "x", "x", None),
    (T.punctuation_only, "a, b", "a b", True), (T.punctuation_only, "a", "a", False), (T.same_text, None, " ", True),
]


@pytest.fixture(scope="module")
def results(spark):
    rows = [(x,) for _, x, _ in CASES]
    df = spark.createDataFrame(rows, "x string").coalesce(1)
    out = []
    for at in range(0, len(CASES), 10):
        some = CASES[at : at + 10]
        df = spark.createDataFrame([tuple(x for _, x, _ in some)], ", ".join(f"x{i} string" for i in range(len(some))))
        out += list(df.select(*[f(F.col(f"x{i}")).alias(f"y{i}") for i, (f, _, _) in enumerate(some)]).first())
    return out


@pytest.mark.parametrize("n", range(len(CASES)))
def test_one_text(results, n):
    assert results[n] == CASES[n][2], CASES[n][1]


def test_two_texts(spark):
    df = spark.createDataFrame([tuple(x for _, a, b, _ in TWO for x in (a, b))], ", ".join(f"a{i} string, b{i} string" for i in range(len(TWO))))
    got = df.select(*[f(F.col(f"a{i}"), F.col(f"b{i}")).alias(f"y{i}") for i, (f, *_) in enumerate(TWO)]).first()
    assert [(t[1], t[2], g) for t, g in zip(TWO, got)] == [(t[1], t[2], t[3]) for t in TWO]


def test_gloss(spark):
    g = [[[{"translation": "dog", "hint": "male"}, {"translation": "hound"}], [{"translation": "cur"}]], [[{"hint": "only"}]], [[{"translation": "x"}]]]
    df = spark.createDataFrame([(json.dumps(g),)], "j string").select(F.from_json("j", N.GLOSS).alias("g"))
    assert df.select(N.gloss_text(F.col("g"))).first()[0] == "dog (male), hound; cur | x"


def test_repairing_twice_changes_nothing_more(spark):
    from lexspark.plans.processing import repair_html
    rows = [("<bobl>x <Stork> <http://a.b/c> <<b>y</b>",), ("<p><bibl>A, 12</p> z",), (None,), ("",)]
    once = repair_html(spark.createDataFrame(rows, "t string"), ["t"])
    assert once.collect() == repair_html(once, ["t"]).collect()


def test_resolved_columns():
    assert T.resolve_column(["a", "Lockhart’s Nahuatl"], "Lockhart's nahuatl") == "Lockhart’s Nahuatl" and T.resolve_column(["a"], "b") is None
