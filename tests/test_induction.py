"""Rules learnt from pages and known values."""

import pytest
from pyspark.sql import functions as F

from adgleaner.operators import candidates as cd, induction, pages as pg

SCHEMA = "site string, field string, page string, html string, value string"


def example(site, i, field, html, value):
    return (site, field, f"{site}{i}", html, value)


def test_delimiters_are_what_all_places_share(spark):
    rows = [example("s", i, "name", f"<p>{'x' * i}</p><h1 class='t{i % 2} big'>item {i}</h1><b>{i * 7}", f"item {i}") for i in range(30)]
    learnt = induction.learn(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.site, r.field, r.score) for r in learnt] == [("s", "name", 1.0)]
    assert learnt[0].pattern == r"(?s)\Q big'>\E(.*?)\Q</h1><b>\E" and learnt[0].n_scored > 3


def test_of_several_places_the_one_that_extracts_wins(spark):
    """The value also stands in a list, where the first place is another value's."""
    rows = []
    for i in range(60):
        html = f"<li>other {i}</li><li>v{i}</li><td class=a>w{i}</td><td class=b>v{i}</td>"
        rows.append(example("s", i, "seller", html, f"v{i}"))
    (rule,) = induction.learn(spark.createDataFrame(rows, SCHEMA)).collect()
    got = spark.createDataFrame([("<li>q</li><li>v</li><td class=a>w</td><td class=b>right</td>",)], "html string").select(
        F.regexp_extract("html", rule.pattern, 1)
    )
    assert got.first()[0] == "right"


def test_no_rule_without_a_pattern_and_quotes_are_literal(spark):
    rows = [example("mixed", i, "name", f"<{'abcdefgh'[i % 8] * 9}>v{i}<{'ijklmnop'[i % 8] * 9}><i>no{i}", f"v{i}") for i in range(40)]
    rows += [example("odd", i, "name", rf"a\E.*(+[b v{i} \Q$1|end", f"v{i}") for i in range(40)]
    rows += [example("null", i, "name", None, "x") for i in range(9)] + [example("null", i, "name", "<b>x</b>", v) for i, v in enumerate([None, "", " "])]
    learnt = {r.site: r for r in induction.learn(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(learnt) == {"odd"}
    page = spark.createDataFrame([(r"a\E.*(+[b new \Q$1|end",)], "html string")
    assert page.select(F.regexp_extract("html", learnt["odd"].pattern, 1)).first()[0].strip() == "new"


def test_learnt_rules_serve_as_site_rules(spark):
    rows = [example("s", i, f, f"<h1>n{i}</h1><i class=p>{i}.50 EUR</i>", v) for i in range(40) for f, v in (("name", f"n{i}"), ("price", f"{i}.50 EUR"))]
    rules = induction.as_rules(induction.learn(spark.createDataFrame(rows, SCHEMA)))
    html = "<h1>new</h1><i class=p>7.25 EUR</i>"
    page = spark.createDataFrame([("https://s.com/1", html, "s", "s.com", "t")], "url string, html string, site string, domain string, retrieved string")
    found = cd.candidate_rows(cd.with_candidates(pg.read_pages(page), rules)).where("origin = 'site rules'").collect()
    assert [(r["name"], r.price) for r in found] == [("new", 7.25)]


@pytest.mark.parametrize("a, b, want", [("abc", "abd", "ab"), ("", "x", ""), ("same", "same", "same"), ("x", "y", "")])
def test_common_start(rows, a, b, want):
    assert rows("a string, b string", [(a, b)], induction.common_start(F.col("a"), F.col("b"))) == [(want,)]
