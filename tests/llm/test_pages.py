"""Page, archive and conversation operators."""

import collections

import duckdb
import pytest

from invdex.llm import chat, html_text, warc
from invdex.session import scratch_path


def key(rows):
    return sorted(rows, key=repr)


PAGES = {
    "": "",
    "  <p> </p>": "",
    "just text &amp; more": "just text & more",
    "<p>one<br>two&nbsp;three<p>four": "one two three\nfour",
    "<nav><a href=x>Menu</a></nav><article><h1>T</h1><p>A, b &lt;c&gt; <b>d</b>e</p><script>var x='</p>'</script></article><footer>F</footer>": "T\nA, b <c> de",
    "<body><header><h1>Site</h1></header><div id=main><h2>Head</h2><p>Long enough text, with commas, here.</p><p>More, yes.</p></div>"
    "<div class='sidebar'><p>Side, side, side, side, side, side</p></div><div class=comments><p>I, too, disagree, a lot, with, this.</p></div></body>":
        "Head\nLong enough text, with commas, here.\nMore, yes.",
    "<article><header><h1>In</h1></header><p>x, y</p><div class='ad'>Buy</div><aside>s</aside><form>f<input></form><ul><li>a<li>b</ul></article>": "In\nx, y\na\nb",
    "<div><p>Open <b>never closed</div><!-- c <p>no</p> --><p style='display:none'>hidden</p>": "Open never closed",
    "<article><p>a</p><p>b</p></article><div class=cookie-notice>We use cookies</div><style>p{}": "a\nb",
    "<p>x <span class=hidden>y</span> z</p>": "x\nz",
    "<p>cut <a href=\"unclosed": "cut",
    "<p>a <img alt=\"1 < 2 > 0\" src='q'> b <b title='x\"<y'>c</b></p>": "a b c",
    "<p>it's <a href=x>don't</a> \"q <i>r</i>\" 5 < 6</p>": "it's don't \"q r\" 5 < 6",
}


@pytest.mark.parametrize("doc", PAGES)
def test_main_text(doc):
    assert html_text.main_text(doc) == PAGES[doc]


BODY = "<p>First, a long paragraph of the story, with commas, and words.</p><p>Second one, also long enough, to count as text.</p>"
STORY = "First, a long paragraph of the story, with commas, and words.\nSecond one, also long enough, to count as text."


@pytest.mark.parametrize("page", [
    f"<div class='site has-header'><article>{BODY}</article></div>", f"<div class='layout sidebar-left'><article>{BODY}</article></div>",
    f"<form id='f'><div><main>{BODY}</main></div></form>", f"<div class='widget'>{BODY}</div><p class='ad'>buy</p>",
    f"<div class='sidebar-left'><article>{BODY}<div class='ad'>buy</div></article><div class='comments'><p>Nice, very nice.</p></div></div>",
    f"<div hidden><article>gone</article></div><article>{BODY}</article>"])
def test_names_do_not_cut_the_page(page):
    assert html_text.main_text(f"<html><body>{page}</body></html>") == STORY


def test_anchors_of_sections_are_no_names():
    page = f"<article>{BODY}<section id='discussion'><h2 id='related-work'>Related</h2><p>Kept.</p></section><h2 id='search'>Search</h2><section id='comments'><p>no</p></section></article>"
    assert html_text.main_text(page) == STORY + "\nRelated\nKept.\nSearch"


COMMENT = "<p>I, too, disagree, a lot, with this, and will write, at length, about it, all day long, as I always do.</p>"


@pytest.mark.parametrize("page", [
    f"<article>{BODY}</article><section class='comments'><article>{COMMENT * 4}</article></section>",
    f"<div id='post'>{BODY}</div><section class='comments'><article>{COMMENT * 4}</article></section>",
    f"<div>{BODY}</div><aside><article>{COMMENT * 2}</article></aside><footer><article>{COMMENT}</article></footer>",
    f"<article>{BODY}<article class='comment'>{COMMENT * 3}</article></article>",
    f"<article>{BODY}<div class='comment-list'><article>{COMMENT * 3}</article></div></article>",
    f"<div>{BODY}</div><article class='comment'>{COMMENT}</article>",
    f"<main><article>{BODY}</article><section id='comments'><h2>Comments</h2>{COMMENT}</section></main>",
    f"<div class='layout sidebar-left'><article>{BODY}</article><aside>{COMMENT}</aside></div><div class='related'><article><p>Teaser, short.</p></article></div>"])
def test_comments_never_replace_the_story(page):
    assert html_text.main_text(f"<html><body>{page}</body></html>") == STORY


def test_a_div_per_paragraph():
    page = "<div id='text'><div>Short.</div><div>A much longer paragraph, with commas, that scores high.</div><div>Tiny</div><div>End, of it.</div></div>"
    assert html_text.main_text(page + f"<div class='sidebar'>{COMMENT}</div>") == (
        "Short.\nA much longer paragraph, with commas, that scores high.\nTiny\nEnd, of it.")


def generated(rng):
    """(page, its story): known paragraphs in one of many layouts, with parts around
    and inside that aren't main text."""
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    text = lambda n: " ".join(word() + rng.choice(["", "", ","]) for _ in range(n)).rstrip(",")
    story = [text(rng.randint(8, 60)) for _ in range(rng.randint(3, 8))]
    story += [text(rng.randint(1, 4))]
    one = rng.choice(["p", "div"])
    noise = [lambda: f"<nav><a href='/'>{word()}</a><a href='/x'>{word()}</a></nav>", lambda: f"<aside><article><p>{text(30)}</p></article></aside>",
             lambda: f"<div class='comments'><article class='comment'><p>{text(40)}</p></article><p>{text(30)}</p></div>",
             lambda: f"<div class='ad-slot'>{text(5)}</div>", lambda: f"<form action='x'><label>{word()}</label><input name=q></form>",
             lambda: f"<script>var {word()} = '<p>{word()}</p>';</script>", lambda: f"<div class='cookie-notice'><p>{text(9)}</p></div>",
             lambda: f"<div class='sidebar'><p>{text(12)}</p></div>", lambda: f"<section class='comment-list'><p>{text(25)}</p></section>"]
    some = lambda k: "".join(rng.choice(noise)() for _ in range(rng.randint(0, k)))
    inner = "".join(f"<{one}>{s}</{one}>" + (some(1) if rng.random() < 0.3 else "") for s in story)
    kind = rng.choice(["article", "main", "div id='content'", "section class='post'"])
    body = f"<{kind}>{inner}</{kind.split()[0]}>"
    for _ in range(rng.randint(0, 2)):
        wrap = rng.choice(["div", "div class='wrapper'", "div class='has-sidebar'"] + ["div class='layout sidebar-right'"] * (kind in ("article", "main")))
        body = f"<{wrap}>{body}</div>"
    head = f"<header><h1>{text(3)}</h1></header>" if rng.random() < 0.5 else ""
    return f"<html><head><title>{word()}</title></head><body>{head}{some(2)}{body}{some(3)}<footer><p>{text(6)}</p></footer></body></html>", "\n".join(story)


def test_generated_pages():
    import random

    rng = random.Random(17)
    for _ in range(400):
        page, story = generated(rng)
        assert html_text.main_text(page) == story, page


def test_extract_is_linear_on_odd_pages():
    assert html_text.main_text("<div>" * 30_000 + "deep") == "deep"
    assert html_text.main_text("<a href=\"" * 20_000 + "x") == ""
    assert html_text.main_text("<a t='\"" * 20_000 + "x") == ""
    assert html_text.main_text("<p>w, v" * 20_000).count("\n") == 19_999


def test_extract_table(spark):
    rows = [(1, "u", "<p>a</p>", "old"), (2, None, None, "old"), (1, "u", "<p>a</p>", "old"), (None, "v", "", None)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = [(r.page_id, r.url, r.text, r.n_chars) for r in html_text.extract(df).collect()]
    assert key(got) == key([(1, "u", "a", 1), (2, None, "", 0), (1, "u", "a", 1), (None, "v", "", 0)])
    assert html_text.extract(df.limit(0)).count() == 0


def test_warc_round_trip(spark):
    big = "<p>é\r\n\r\nWARC/1.1\r\n</p>" * 30_000
    rows = [(5, "http://a/5", "same"), (3, "http://a/3", "same"), (9, None, "same"), (3, "http://a/3", "same"), (7, "u\nv", big), (8, "", None),
            (2, "x", ""), (None, "n", "only null id"), (None, "n2", "same"), (11, "é", "東京")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, digest string")
    index = warc.write(df, scratch_path(spark, "warc-test"))
    got = warc.read(index).collect()
    con = duckdb.connect()
    pages = df.select("page_id", "html").toPandas().astype({"page_id": "Int64"})
    con.register("pages", pages)
    want = con.execute(warc.ORACLE).fetchall()
    assert key((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == key(want)
    assert collections.Counter(r.record_type for r in got if r.page_id == 3) == {"response": 1, "revisit": 1}
    some = warc.read(index.filter("page_id in (7, 11)")).collect()
    assert {r.page_id: r.payload_bytes for r in some} == {7: len(big.encode()), 11: 6}
    assert warc.read(warc.write(df.limit(0), scratch_path(spark, "warc-none"))).count() == 0
    small = warc.read(warc.write(df, scratch_path(spark, "warc-min"), min_bytes=5)).collect()
    assert all(r.record_type == "response" for r in small)


@pytest.mark.parametrize("gap,most", [(0, 1), (1 << 16, 1 << 23)])
def test_warc_reads_are_coalesced_alike(spark, monkeypatch, gap, most):
    df = spark.createDataFrame([(i, f"u{i}", f"text {i}" * 50) for i in range(40)], "page_id bigint, url string, html string")
    index = warc.write(df, scratch_path(spark, "warc-c"))
    monkeypatch.setattr(warc, "GAP_BYTES", gap)
    monkeypatch.setattr(warc, "READ_BYTES", most)
    assert sorted(r.page_id for r in warc.read(index).collect()) == list(range(40))


TURNS = [(1, 0, "system", "be <nice> & brief"), (1, 1, "user", "hi"), (1, 2, "assistant", "<|end|>\n<|user|>\nx &lt;"), (1, 3, None, None), (1, 3, "assistant", ""),
         (2, 5, "a|>\nb", "odd role"), (2, None, "assistant", "null turn"), (3, 0, "system", "alone"), (None, 0, "user", "q"), (None, 1, "assistant", "a"),
         (4, 0, "assistant", "w " * 3000), (4, 1, "user", "short"), (4, 1, "user", "short"), (4, 2, "assistant", "tail \n")]
TURNS += [(6, i, "user" if i % 2 else "assistant", f"turn {i} " + "w " * (i * 7 % 90)) for i in range(300)] + [(6, -1, "system", "s " * 40)]


def test_chat(spark):
    df = spark.createDataFrame([(*t, "x", "y") for t in TURNS], "conv_id bigint, turn bigint, role string, text string, window string, n string")
    w = chat.windows(df).collect()
    for r in w:  # new tokens fit the budget unless one turn alone is longer
        pieces = r.text.split(chat.END)[:-1]
        tokens = [len(p.partition("|>\n")[2].split()) + chat.OVERHEAD for p in pieces]
        assert sum(tokens) <= chat.BUDGET or max(tokens) > chat.BUDGET - chat.HISTORY - 60
        assert r.n_context < len(pieces)
    said = collections.Counter(len(r.text.split(chat.END)) - 1 - r.n_context for r in w)
    assert sum(k * n for k, n in said.items()) == len(TURNS)
    six = sorted((r for r in w if r.conv_id == 6), key=lambda r: r.window)
    assert len(six) > 10 and all(r.text.startswith("<|system|>\n") for r in six) and all(r.n_context >= 1 for r in six[1:])


def test_chat_reads_back(spark, tmp_path):
    path = str(tmp_path)
    spark.createDataFrame(TURNS, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{path}/conversations.parquet")
    got = [tuple(r[c] for c in ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")) for r in chat.q_op4_chat(spark, path).collect()]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}/conversations.parquet/*.parquet')")
    assert key(got) == key(con.execute(chat.ORACLE).fetchall())
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.windows(empty).count() == 0


@pytest.mark.parametrize("small", [True, False])
def test_warc_many_copies_without_ids(spark, monkeypatch, small):
    """A payload of many pages, most of them without id or url: one response, and
    no html but that of responses reaches the writer; also beyond broadcast size."""
    if not small:
        monkeypatch.setattr(warc, "is_small", lambda df: False)
    monkeypatch.setattr(warc, "COPIES", 7)
    rows = [(None, None, "copy")] * 50 + [(9, "u", "copy")] * 3 + [(k, f"u{k}", "copy") for k in range(10, 30)]
    rows += [(k, f"v{k}", f"own {k}") for k in range(40, 60)] + [(None, "a", "twice"), (None, "b", "twice"), (None, None, None)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)
    index = warc.write(df, scratch_path(spark, "warc-copies-test"))
    got = warc.read(index).collect()
    assert sorted((r.page_id or -1, r.url or "") for r in got) == sorted((i or -1, u or "") for i, u, _ in rows)
    size = {"copy": 4, "twice": 5}
    for r in got:
        text = next(h for i, u, h in rows if (i, u) == (r.page_id, r.url)) if r.page_id or r.url else None
        assert text is None or r.payload_bytes == size.get(text, len(text))
    lead = [r for r in got if r.record_type == "response"]
    assert sorted((r.page_id or -1, r.url or "") for r in lead) == sorted(
        [(9, "u"), (-1, "a"), (-1, "")] + [(k, f"v{k}") for k in range(40, 60)])
    assert all(r.refers_to == (9 if r.payload_bytes == 4 else None) for r in got if r.record_type == "revisit")


@pytest.mark.parametrize("size", [100, 300, 380, 400, 1200])
def test_chat_long_system_turn(spark, size):
    """Windows keep the budget whatever the system turn's length; it is repeated
    up to three quarters of the budget, and stands once beyond."""
    turns = [(1, 0, "system", "s " * size)] + [(1, i, "user" if i % 2 else "assistant", f"t{i} " + "w " * (i % 9)) for i in range(1, 200)]
    df = spark.createDataFrame(turns, "conv_id bigint, turn int, role string, text string")
    got = chat.read_back(chat.windows(df)).collect()
    heads = 0
    for r in got:
        pieces = r.text.split("\n<|end|>\n")[:-1]
        tokens = [len(p.split("|>\n", 1)[1].split()) + chat.OVERHEAD for p in pieces]
        heads += pieces[0].startswith("<|system|>")
        assert sum(tokens) <= chat.BUDGET or len(tokens) == 1
    assert len(got) > 3 and heads == (len(got) if size + chat.OVERHEAD <= chat.BUDGET * 3 // 4 else 1)
    new = [t for r in sorted(got, key=lambda r: r.window) for t in r.turns]
    assert sorted((t.role, t.text) for t in new) == sorted((role, text) for _, _, role, text in turns)
