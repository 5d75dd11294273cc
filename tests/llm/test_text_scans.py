"""Secret, personal-data, HTML and BPE operators against plain brute force."""

from __future__ import annotations

import hashlib
import html as html_lib
import re

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from salesmart.llm import bpe, html_text, pii, secret_scan
from salesmart.llm import queries as Q

SF_SMALL = "/root/testdata/sf0.01"

EMPTY = hashlib.sha256(b"").hexdigest()


def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def edge_rows(spark):
    """Null text, empty text, null id, repeated rows, a column whose name clashes with a result."""
    rows = [
        (1, None, "x"),
        (2, "", None),
        (None, "token = 'abcdefgh12345678'", "y"),
        (3, "a@b.co 4111 1111 1111 1111", "z"),
        (3, "a@b.co 4111 1111 1111 1111", "z"),
        (4, "x" * 200_000 + "1" * 200_000, "z"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string")


# --- secrets

ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def plain_secrets(text):
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(k, s, e) for s, _, k, e in sorted(out)]


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def test_secret_query_equals_plain_expressions(spark):
    rows = {r.doc_id: r for r in Q.op2_secret_scan(spark, SF_SMALL).collect()}
    docs = documents(spark).collect()
    assert len(rows) == len(docs)
    hits = 0
    for d in docs:
        base = plain_secrets(d.text or "")
        r = rows[d.doc_id]
        hits += len(base)
        assert r.base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(
            sum(x[0] == k for x in base) for k in ("assign", "access", "hex")
        )
        assert set(filter(None, joined(base).split(","))) <= set(filter(None, r.spans.split(",")))
    assert hits > 0


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.sampled_from(
            ["token", "API_KEY", "apikey", "paſſword", "toKen", " ", "=", ":", '"', "'", "abc123", "deadbeef" * 3, "AKIA", "QWERTY0123456789", "\n", "é", "+", "x"]
        ),
        max_size=12,
    )
)
def test_secret_base_spans_of_random_text(parts):
    text = "".join(parts)
    found = [x[:3] for x in secret_scan.find_spans(text)]
    assert [x for x in found if x[0] != "literal"] == plain_secrets(text)
    secret_scan.redact(text)


def test_lexer_propagates_constants_and_scores_names():
    text = 'base = "Zx81kQ"\nclient_secret_value = base + "9fT3wLm2"\ngreeting = "Hello9World7"\n'
    pairs = [(n, text[s:e]) for n, s, e in secret_scan.name_literal_pairs(text)]
    assert ("client_secret_value", "Zx81kQ") in pairs
    assert ("client_secret_value", "9fT3wLm2") in pairs
    found = {text[s:e] for k, s, e, _ in secret_scan.find_spans(text) if k == "literal"}
    assert "9fT3wLm2" in found and "Hello9World7" not in found
    yaml = "private_key: Qm9vZ2llV29vZ2ll7\ncolour: Qm9vZ2llV29vZ2ll7\n"
    assert [x[0] for x in secret_scan.find_spans(yaml)] == ["literal"]
    assert "Qm9v" not in secret_scan.redact(yaml).split("colour")[0]
    assert secret_scan.find_spans("He said: the key: a fine day = good") == []


VALUE = "x9-Kd82!msQ4"


@pytest.mark.parametrize(
    "source",
    [
        'password: str = "@"', 'const apiKey: string = "@";', 'password: Optional[str] = "@"', "let secret: &'static str = \"@\";",
        'var token string = "@"', 'os.environ["API_TOKEN"] = "@"', "db['a:b=c']['password'] = '@'", 'token = b"@"',
        'token = f"@"', 'token = """@"""', "token = '''\n@\n'''", "token = `@`", 'token = ("@" "and the rest")',
        'token = ("and the rest"\n   "@")', 'token = [\n  "one more value", "@"]', 'token = \\\n    "@"', 'token =\n    "@"',
        'token = "and some" \\\n  "@"', 'password = "$@"', 'password = "<@"', 'password = "{@"', 'password = "%@"',
        'password = "two words @"', "x" * 300 + "_password" + "_" * 200 + ' = "@"', "password" + "_x" * 200 + ' = "@"',
        'token = "abcdef @"', 'password ||= "@"', "secret = r#\"@\"#",
    ],
)
def test_lexer_takes_the_forms_of_source_text(source):
    text = "first = 1\n" + source.replace("@", VALUE) + "\nlast = 2\n"
    redacted = secret_scan.redact(text)
    assert VALUE not in redacted and secret_scan.PLACEHOLDER in redacted
    assert redacted.startswith("first = 1\n") and redacted.endswith("\nlast = 2\n")


@pytest.mark.parametrize(
    "source",
    [
        'password = "${DB_PASSWORD}"', 'password = "<your password>"', 'password = "{{ vault.it }}"', 'password = "%DB_PASSWORD%"',
        'password = "$DB_PASSWORD2"', 'colour: str = "@"', 'names["colour"] = "@"', 'secret:\n  "colour": "@"', 'a: str = "@"\ntoken: str\n',
    ],
)
def test_lexer_leaves_placeholders_and_other_names(source):
    text = source.replace("@", VALUE)
    assert [x for x in secret_scan.find_spans(text) if x[0] == "literal"] == []


@pytest.mark.parametrize("unit", ["=", "a=", "]=", "[]=", "a[=", ":a", '="', "a:b=", "=\n", "a=(", "a='''", "a=`\\", "a=b+", 'a="b" ', "[a:"])
def test_lexer_reads_long_runs_once(unit):
    import time

    start = time.process_time()
    secret_scan.find_spans(unit * (200_000 // len(unit)))
    assert time.process_time() - start < 20


def test_redaction_keeps_columns_and_clean_rows(spark):
    rows = [(1, "clean text", 10, "s"), (2, "a token = abcdef123 b", 21, "s"), (3, None, None, None), (4, "", 0, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, source string")
    out = {r.doc_id: r for r in secret_scan.redact_documents(docs).collect()}
    assert secret_scan.redact_documents(docs).columns == docs.columns
    assert out[1] == docs.where("doc_id = 1").first()
    assert out[2].text == "a [SECRET] b" and out[2].n_chars == len("a [SECRET] b")
    assert out[3].text is None and out[4].text == ""


# --- personal data


def plain_pii(text):
    def luhn(ds):
        s = [int(c) for c in ds][::-1]
        return (sum(s[::2]) + sum(sum(divmod(2 * d, 10)) for d in s[1::2])) % 10 == 0

    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [
        ("ip", *m.span())
        for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
        if all(int(p) <= 255 for p in m[0].split("."))
    ]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        ds = re.sub("[^0-9]", "", m[0])
        if 13 <= len(ds) <= 19 and luhn(ds):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_pii_query_equals_plain_expressions(spark):
    rows = {r.doc_id: r for r in Q.op6_pii(spark, SF_SMALL).collect()}
    docs = documents(spark).collect()
    assert len(rows) == len(docs)
    hits = 0
    for d in docs:
        base = plain_pii(d.text or "")
        hits += len(base)
        r = rows[d.doc_id]
        assert r.base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(
            sum(x[0] == k for x in base) for k in ("email", "ip", "card", "phone")
        )
    assert hits > 0


@settings(max_examples=400, deadline=None)
@given(
    st.lists(
        st.sampled_from(
            ["a", "b.c", "@", ".", "x.org", "-", " ", "1", "255", "256", "0", "4111", "1111", "+1", "(555)", "%", "é", "00", "\n", "12.3"]
        ),
        max_size=16,
    )
)
def test_pii_base_spans_of_random_text(parts):
    text = "".join(parts)
    found = [x[:3] for x in pii.find_spans(text) if x[0] in pii.BASE_KINDS]
    assert found == plain_pii(text)


def test_pii_checksums_and_context():
    iban = "please transfer to bank account GB82 WEST 1234 5698 7654 32 today"
    found = pii.find_spans(iban)
    assert [x[0] for x in found] == ["iban"] and found[0][3] == 0.95
    assert pii.find_spans(iban.replace("GB82", "GB83")) == []
    assert [x[0] for x in pii.find_spans("his SSN is 078-05-1120.")] == ["ssn"]
    assert pii.find_spans("part 078-05-1120 shipped") == []
    assert pii.find_spans("4111 1111 1111 1112") == []
    near, far = pii.find_spans("call +1 (555) 010-9999"), pii.find_spans("zz +1 (555) 010-9999")
    assert near[0][3] > far[0][3]


def test_pii_finds_every_iban_of_a_row_of_groups():
    de, gb = "DE89 3704 0044 0532 0130 00", "GB29 NWBK 6016 1331 9268 19"
    for text in (f"{de} {gb}", f"NR12 {de}", f"NR12 {de} {gb} QX77 {gb.replace(' ', '')}", f"XY99 ABCD {gb} {de}", f"{de} CODE7 X"):
        found = [text[s:e].replace(" ", "") for k, s, e, _ in pii.find_spans(text) if k == "iban"]
        want = [x.replace(" ", "") for x in (de, gb)]
        assert found == [y for y in re.findall("|".join(want), text.replace(" ", ""))]


@pytest.mark.parametrize("digest,counts", [(secret_scan.secret_digest, 3), (pii.pii_digest, 4)])
def test_scan_edges(spark, digest, counts):
    docs = edge_rows(spark)
    rows = digest(docs).collect()
    assert len(rows) == 6
    by = {r.doc_id: r for r in rows}
    assert by[1].base_sha256 == EMPTY and by[2].spans == ""
    assert None in by and rows.count(by[3]) == 2
    assert digest(docs.limit(0)).count() == 0


# --- pages


def article_text(page):
    """The article's blocks, for pages made only of paragraphs, headings and breaks."""
    m = re.search(r"<article>(.*?)</article>", page, re.S)
    parts = re.split(r"</?(?:p|h1|br)\b[^>]*>", m[1])
    texts = [" ".join(html_lib.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts]
    return " ".join(t for t in texts if t)


def test_pages_equal_their_articles(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    out = {r.page_id: r for r in Q.op7_html_text(spark, SF_SMALL).collect()}
    assert len(out) == len(pages)
    for p in pages:
        assert out[p.page_id].text == article_text(p.html)
        assert out[p.page_id].n_chars == len(out[p.page_id].text)
        assert out[p.page_id].url == p.url


def test_page_rules_without_an_article():
    prose = "The house stood on the hill and it was of stone, as they say in the town, with a roof of red tiles that had been laid by the men of the place in the year of the great flood and the storm. " * 2
    page = f"""<html><head><title>T</title><script>if (a < b) {{ x = "<p>no</p>" }}</script></head><body>
    <header>Site head</header><nav><a href=a>One</a><a href=b>Two</a></nav>
    <div>{prose}</div><p>Short line.</p><div>{prose}</div>
    <aside>About us and the others</aside><form><p>Send it</p></form>
    <div class="user-comments"><p>{prose}</p></div><div id="cookie-notice">{prose}</div>
    <div><a href="x">read this</a> <a href="y">and that</a></div><!-- {prose} --><footer>&copy; x</footer></body>"""
    text = html_text.main_text(page)
    once = " ".join(prose.split())
    assert text == f"{once} Short line. {once}"


def test_page_edges(spark):
    assert html_text.main_text(None) == "" and html_text.main_text("") == ""
    assert html_text.main_text("<article><p>a &amp &#x41;&nbsp; b<p>c\n\td") == "a & A b c d"
    assert html_text.main_text("<article>x <p>" * 3000).startswith("x x")
    assert html_text.main_text("<article><p>1 < 2 and 3 > 2</p></article>") == "1 < 2 and 3 > 2"
    assert html_text.main_text("<article><a title='>'>in</a><b>bold</b> t</article>") == "inbold t"
    rows = [(None, None, None, 1), (1, "u", "", 2), (1, "u", "<article>z</article>", 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    out = html_text.extract_main_text(pages).collect()
    assert sorted(r.text for r in out) == ["", "", "z"]
    assert html_text.extract_main_text(pages.limit(0)).count() == 0


def test_second_pass_takes_nearest_neighbours():
    s, g, b = html_text.SHORT, html_text.GOOD, html_text.BAD
    assert html_text.final_labels([s, g, s, g, s, s, b, s]) == [True, True, True, True, True, False, False, False]
    assert html_text.final_labels([s, s]) == [False, False]


# --- BPE


@pytest.fixture(scope="module")
def both():
    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return bpe.WordBpe(f.read()), Tokenizer.from_file(path)


def same(both, text):
    own, theirs = both
    ids = theirs.encode(text, add_special_tokens=False).ids
    got = own.encode(text)
    import array

    assert array.array("I", got).tolist() == ids
    assert own.decode(got) == theirs.decode(ids, skip_special_tokens=False)


def test_bpe_query_equals_the_tokenizers_library(spark, both):
    docs = documents(spark).collect()
    out = {r.doc_id: r for r in Q.op3_bpe(spark, SF_SMALL).collect()}
    assert len(out) == len(docs)
    for d in docs:
        ids = both[1].encode(d.text or "", add_special_tokens=False).ids
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        text = both[1].decode(ids, skip_special_tokens=False)
        r = out[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(packed).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize(
    "text",
    [
        "", " ", "ΑΣ ΟΔΟΣ ΣΣ", "İstanbul ISPARTA", "a\x1cb\x85c d e", "don't I'LL we've", "é é ﬁ ½ ² Ⅻ",
        "x<|endoftext|>y <|startoftext|><|endoftext|", "a" * 5000, "日本語 テスト 123", "👍🏽 ok", "​﻿", "__a_b--c!!", "ab\nc\td",
    ],
)
def test_bpe_special_texts(both, text):
    same(both, text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=("Cn", "Cs")), max_size=60))
def test_bpe_random_texts(both, text):
    """Characters of later Unicode versions than Python's tables are left out."""
    same(both, text)


def test_bpe_edges(spark):
    out = bpe.encode_documents(edge_rows(spark)).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == 6 and by[1].ids == [] and by[1].decoded == "" and by[2].ids == []
    assert bpe.bpe_digest(edge_rows(spark).limit(0)).count() == 0


def test_segment_tree_takes_the_leftmost_lowest_rank():
    pairs = {(1, 1): (0, 2), (2, 1): (1, 3), (2, 2): (2, 4)}
    assert bpe.merge_symbols([1, 1, 1, 1, 1], pairs) == [2, 3]
    assert bpe.merge_symbols([1], pairs) == [1] and bpe.merge_symbols([], pairs) == []
    assert bpe.merge_symbols([1, 1], pairs) == [2]


ARTICLE = "<p>" + "It was the best of times and it was the worst of times for all of the people in the town. " * 4 + "</p>"


@pytest.mark.parametrize(
    "page",
    [
        f'<html class="no-js menu"><body class="has sidebar">{ARTICLE}</body></html>',
        f'<body><article class="post header">{ARTICLE}</article></body>',
        f'<body><div class="page sidebar social">{ARTICLE}{ARTICLE}</div><div>x</div></body>',
    ],
)
def test_html_names_of_wrappers_reject_nothing(page):
    text = html_text.main_text(page)
    assert text.startswith("It was the best") and text.count("the town.") == page.count("the town.")


def test_html_lists_of_links_and_comments_go_but_single_links_stay():
    links = "".join(f"<li><a href=x>More about town {i}</a></li>" for i in range(5))
    text = html_text.main_text(f"<article>{ARTICLE}<ul>{links}</ul>{ARTICLE}</article>")
    assert "More about" not in text and text.count("worst of times") == 8
    one = html_text.main_text(f"<article>{ARTICLE}<p><a href=x>See the map</a></p>{ARTICLE}</article>")
    assert "See the map" in one
    page = f'<article>{ARTICLE}</article><div class="comments">{ARTICLE * 5}</div>'
    assert html_text.main_text(page).count("worst of times") == 4
    assert html_text.main_text(f'<nav class="menu">{ARTICLE}</nav>') == ""


def test_html_rules_alone_decide_without_markup():
    links = "<div><a href=a>Home</a> <a href=b>All news</a> <a href=c>Contact</a></div>"
    page = f"<div>{links}<div>{ARTICLE}</div><div>Then it rained.</div><div>{ARTICLE}</div><div>Copyright 2024</div>{links}</div>"
    text = html_text.main_text(page)
    assert text.count("worst of times") == 8 and "Then it rained." in text
    assert "Home" not in text and "Copyright" not in text


@pytest.mark.parametrize(("country", "digits"), [("BE", 12), ("DK", 14), ("FI", 14)])
def test_pii_keeps_ibans_whose_digits_also_pass_luhn(country, digits):
    overlapping = 0
    for k in range(300):
        body = str(10 ** (digits - 1) + 7919 * k)
        check = 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97
        text = f"account {country}{check:02d}{body} end"
        spans = pii.find_spans(text)
        assert ("iban", 8, 12 + digits) in [x[:3] for x in spans]
        overlapping += any(x[0] == "card" for x in spans)
    assert overlapping > 5


def test_pii_context_words_are_whole():
    assert pii._near("ip 10.0.0.1", "ip", 3, 11)
    far = "zip" + " " * (pii.CONTEXT_CHARS - 2) + "10.0.0.1"  # the window begins inside "zip"
    assert not pii._near(far, "ip", len(far) - 8, len(far))
    after = "10.0.0.1" + " " * (pii.CONTEXT_CHARS - 2) + "ipsum"
    assert not pii._near(after, "ip", 0, 8)
