"""Secrets, token counts and page texts against plain Python."""

import random
import re
from collections import Counter

import pytest

from clickstrata.llm import html_text, secrets, tokens

BASE = (
    (
        "assign",
        re.compile(
            r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
        ),
        lambda m: len(m[2]) >= 6,
    ),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
)


def base_spans(text):
    found = [
        (m.start(), i, m.end())
        for i, (_, pattern, ok) in enumerate(BASE)
        for m in pattern.finditer(text)
        if ok(m)
    ]
    return [(BASE[i][0], a, b) for a, i, b in sorted(found)]


def scanned(text):
    kinds = {rule.kind for rule in secrets.BASE_RULES}
    found = secrets.find_secrets(text, secrets.scanner())
    return [(s["kind"], s["start"], s["end"]) for s in found if s["kind"] in kinds]


def test_secrets_are_those_of_the_expressions():
    draw = random.Random(3)
    bits = (
        "password PassWd secret token api_key APIKEY \" ' : = abc abcdef 0123456789abcdef AKIA "
        "ABCDEFGHIJKLMNOP deadbeefdeadbeef é ghp_ x"
    ).split() + [" ", "  ", "\n"]
    for _ in range(3000):
        text = "".join(draw.choices(bits, k=draw.randint(0, 25)))
        assert scanned(text) == base_spans(text), text


def test_a_short_value_hides_what_it_covers():
    text = 'token: "token" = abcdefgh'
    assert scanned(text) == base_spans(text) == []


def test_further_rules_and_places_in_code_points():
    text = "ééé ghp_" + "a1B2" * 9 + " -----BEGIN RSA PRIVATE KEY-----"
    found = secrets.find_secrets(text, secrets.scanner())
    assert [(s["kind"], text[s["start"] : s["end"]]) for s in found] == [
        ("github", "ghp_" + "a1B2" * 9),
        ("keyblock", "-----BEGIN RSA PRIVATE KEY-----"),
    ]


def test_a_rule_that_nests_is_refused():
    with pytest.raises(ValueError, match="inside unfinished"):
        secrets.Scanner((secrets.Rule("odd", "ab*c|b"),))


def test_secrets_of_a_table(spark, rows_of):
    long = "x " * 60_000 + "password=hunter22"
    docs = rows_of([(1, None), (2, ""), (None, "token: abcdef1"), (3, long), (3, long)], ["secrets"])
    found = secrets.scan_secrets(docs).collect()
    assert sorted((r.doc_id or 0, len(r.secrets)) for r in found) == [
        (0, 1),
        (1, 0),
        (2, 0),
        (3, 1),
        (3, 1),
    ]
    clean = {r.doc_id: r.text for r in secrets.redact_secrets(docs).collect()}
    assert clean[None] == "[secret]" and clean[1] is None and clean[2] == ""
    assert clean[3] == "x " * 60_000 + "[secret]"
    assert secrets.scan_secrets(docs.limit(0)).count() == 0


def test_token_counts_are_the_tokenizers(spark, rows_of):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(tokens.TOKENIZER))
    draw = random.Random(4)
    bits = [
        *"Hello world's IT'S 123 ½ ΑΣ İ 中文 🙂 <|endoftext|> <|startoftext|> <|endof é é".split(),
        *" \t\n\x1c\x1f\x85\xa0　​!,",
    ]
    texts = ["".join(draw.choices(bits, k=draw.randint(0, 12))) for _ in range(800)]
    texts += ["", None, "word " * 30_000]
    docs = rows_of(list(enumerate(texts)), ["n_tokens"])
    found = {r.doc_id: r for r in tokens.count_tokens(docs).collect()}
    for i, text in enumerate(texts):
        expected = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        assert found[i].n_tokens == expected, text
        assert found[i].n_bytes == len((text or "").encode())
        assert found[i].over_limit == (expected > 2048)


def test_piece_counts_are_learnt_once():
    counts = tokens.piece_counts(tokens.TOKENIZER)
    counts.learn({"twice"})
    assert counts.total(Counter(["twice", "twice"])) == 2 * counts["twice"]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style>
<script>var a = "</p><p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a><li><a href=/b>B</a></ul></nav>
<div class="cookie-notice">We use cookies, and this is a notice of some length.</div>
<div id=wrap><article><h1>A title</h1><p>First &amp; <b>bold</b>
   text.<p>Second &eacute; paragraph,<br>with a line.</p>{more}
<div class="share">Share this</div></article>
<aside><p>Sidebar words that go on and on.</p></aside></div>
<form><label>Mail</label><input></form>
<section id="comments"><p>A reader says something rather long about all of this.</p></section>
<footer>&copy; site</footer><!-- end --></body></html>"""


def test_main_text_of_a_page():
    assert html_text.main_text(PAGE.format(more="")) == (
        "A title\nFirst & bold text.\nSecond é paragraph, with a line."
    )
    listed = PAGE.format(more="<ul><li>one <a href=x>link</a><li>two</ul><blockquote>Said.</blockquote>")
    assert html_text.main_text(listed).endswith("one link\ntwo\nSaid.")


def test_cut_off_page():
    html = PAGE.format(more="")
    assert html_text.main_text(html[: html.index("Second") + 3]).endswith("First & bold text.\nSec")
    assert html_text.main_text("<p>plain words") == "plain words"
    assert html_text.main_text("no markup at all") == "no markup at all"


def test_links_are_not_main_text():
    links = "".join(f"<li><a href=/{i}>Category number {i}</a></li>" for i in range(40))
    html = f"<body><div><ul>{links}</ul></div><div><p>{'Words of the article. ' * 20}</p></div></body>"
    assert html_text.main_text(html) == ("Words of the article. " * 20).strip()


def test_pages_of_a_table(spark):
    pages = spark.createDataFrame(
        [(1, "u", None, "x"), (2, None, "", "x"), (None, "v", "<p>a  b</p>", "x"), (3, "w", "<nav>n</nav>", "x")],
        "page_id bigint, url string, html string, text string",
    )
    found = html_text.extract_pages(pages).collect()
    assert {(r.page_id, r.text, r.n_chars) for r in found} == {
        (1, "", 0),
        (2, "", 0),
        (None, "a b", 3),
        (3, "", 0),
    }
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    assert html_text.main_text(deep) == "deep"


def test_title_without_head_is_no_text():
    assert html_text.main_text("<title>T</title><p>Words here.") == "Words here."
