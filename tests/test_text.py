import re

from corpusloom.functions.classify import file_stem, file_suffix, instruction_for, is_error, is_transient, source_type
from corpusloom.functions.text import clean_text, strip, strip_html
from corpusloom.functions.titles import extract_title


def test_strip_knows_unicode_whitespace(evaluate):
    values = ["\xa0 a b　\x1c", "\n\t", "", "x", " y\x85"]
    assert evaluate(values, strip) == [value.strip() for value in values]


def test_clean_text(evaluate):
    values = ["a\r\nb\rc", "a\n \t\n\n\nb", "a  \t b", "  x \n", "a\n\nb", "a\n\n\n\nb", "a\xa0\n\x0b\nb", None, ""]
    expected = [
        re.sub(r"[ \t]+", " ", re.sub(r"\n\s+\n+", "\n\n", (v or "").replace("\r\n", "\n").replace("\r", "\n"))).strip()
        for v in values
    ]
    assert evaluate(values, clean_text) == expected


def test_strip_html_modes(evaluate):
    page = "<!DOCTYPE html><p>a &amp; <b>b</b></p><script>var x='<p>';</script><!-- no --><p> </p>caf&eacute; &#8364; &nope;"
    assert evaluate([page], strip_html) == [re.sub("<[^>]+>", "", page)]
    [dom] = evaluate([page], lambda c: strip_html(c, "dom"))
    assert dom == "a & \nb\n \ncafé € &nope"


def test_dom_mode_hidden_and_preformatted(evaluate):
    page = "<style>p{}</style><template><i>t</i></template><pre>\n\n</pre><p>\n \n</p>z"
    assert evaluate([page], lambda c: strip_html(c, "dom")) == ["\n\n\n\n\nz"]


def test_titles(evaluate):
    long = "word " * 60
    values = [
        "A Proper Title Line\nBody follows here.",
        "# Markdown Header\nText",
        "- ** Starred header line\nText",
        "https://example.org/page\nSecond line as title\nx",
        "\nshort\n\n\nFourth line is never looked at",
        "This is a sentence that ends. More text.",
        "short",
        "",
        None,
        long,
        "Ends with a dot.\n" + long,
        "<b>Bold title of page</b>\nx",
    ]
    assert evaluate(values, extract_title) == [
        "A Proper Title Line",
        "Markdown Header",
        "Starred header line",
        "Second line as title",
        "short\n\n\nFourth line is never looked at",
        "This is a sentence that ends",
        "short",
        "",
        "",
        long[:100].strip() + "...",
        "Ends with a dot",
        "Bold title of page",
    ]


def test_title_in_dom_mode(evaluate):
    assert evaluate(["## A &amp; B together\nx"], lambda c: extract_title(c, html_mode="dom")) == ["A & B together"]


def test_source_types(evaluate):
    names = ["My_Solutions.csv", "experiment.json", "ACTION.md", "explanation.txt", "blog1.txt", "publication.txt", "x"]
    assert evaluate(names, source_type) == [
        "solution", "experiment", "action_plan", "action_plan", "blog", "unknown", "unknown",
    ]
    assert evaluate(names, lambda c: source_type(c, profile=True)) == [
        "solution_platform", "experiment_platform", "action_plan_platform", "unknown", "blogs", "blogs", "unknown",
    ]
    assert evaluate(["nonsense"], instruction_for) == evaluate(["unknown"], instruction_for)


def test_names_and_messages(evaluate):
    names = ["a.b.csv", "plain", ".hidden", "x.TXT"]
    assert evaluate(names, file_stem) == ["a.b", "plain", ".hidden", "x"]
    assert evaluate(names, file_suffix) == [".csv", "", "", ".txt"]
    assert evaluate(["Read Timeout", "bad"], is_transient, "string") == [True, False]
    assert evaluate(["Error: x", "Error in x", None], is_error) == [True, False, False]
