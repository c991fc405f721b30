from wardflow.llm import html_text as H

ARTICLE = ["A heading", "A first long paragraph with enough words in it to be the text of a page, and some more words.", "Short.",
           "Another long paragraph with enough words in it to be the text of a page &amp; more &#233; &lt;b&gt; as well."]
WANT = "\n".join([*ARTICLE[:3], "Another long paragraph with enough words in it to be the text of a page & more é <b> as well."])
AROUND = ('<!DOCTYPE html><html><head><title>Title</title><style>p{x}</style><script>var t="</p><p>no";</script></head><body>'
          "<header><h1>Site</h1><p>The slogan of the site in a few words more than needed</p></header>"
          '<nav><ul><li><a href="/">Home</a></li><li><a href="/a">News</a></li></ul></nav><!-- a comment -->'
          '<div class="cookie-notice">We use cookies and say so in a long sentence that could be mistaken for text.</div>'
          '<div class="ad">Buy this now, it is the best product that has ever been made in the whole world!</div>%s'
          '<aside><p>A sidebar with a long text that could well be taken for a paragraph of the article itself.</p></aside>'
          '<section id="comments"><p>First! A reader wrote this long comment with many words about the article.</p></section>'
          "<form><label>Your mail</label><textarea>text</textarea></form><footer>&copy; 2024 &middot; all rights</footer></body></html>")


def body(tag="article", attrs=""):
    return f"<{tag}{attrs}><h1>{ARTICLE[0]}</h1>" + "".join(f"<p>{p}</p>" for p in ARTICLE[1:]) + f"</{tag}>"


def test_article_alone_is_left():
    for tag, attrs in (("article", ""), ("main", ""), ("div", ' class="content"'), ("section", "")):
        assert H.main_text(AROUND % body(tag, attrs)) == WANT


def test_nested_parts():
    inner = body().replace("</article>", '<div class="share-buttons">Share this</div><div class="related"><p>Read next: another long story about something else</p></div></article>')
    assert H.main_text(AROUND % inner) == WANT
    assert H.main_text(AROUND % f"<div><div><div>{body('div')}</div></div></div>") == WANT


def test_open_tags_and_cut_pages():
    loose = "<article><h1>" + ARTICLE[0] + "</h1><p><b>" + ARTICLE[1] + "<br><p>Short.<p>" + ARTICLE[3]
    assert H.main_text(AROUND.split("%s")[0] + loose) == WANT
    assert H.main_text(loose + "&am") == WANT + "&am"


def test_white_space_and_references():
    assert H.main_text("<p>  a\n\t b&nbsp;&nbsp;c  </p><p> \n </p><p>d<br>e</p><ul><li>f<li>g</ul>") == "a b c\nd e\nf\ng"
    assert H.main_text("<p>in<b>li</b>ne <i>and</i> more</p>") == "inline and more"


def test_odd_pages(odd_texts):
    assert H.main_text(None) == H.main_text("") == H.main_text("   ") == H.main_text("<html></html>") == H.main_text("<nav>x</nav>") == ""
    assert H.main_text("plain text only") == "plain text only"
    for t in odd_texts:
        assert H.main_text(t) == " ".join((t or "").split())
    long = "word " * 100_000
    assert H.main_text(f"<article><p>{long}</p></article>") == long.strip()
    assert H.main_text("<" * 1000) is not None and H.main_text("</p>" * 1000 + "<div>" * 5000 + "x") == "x"


def test_feeding_in_pieces(monkeypatch):
    page = AROUND % body()
    for size in (1, 7, 100):
        monkeypatch.setattr(H, "FEED", size)
        assert H.main_text(page) == WANT


def test_frame(spark):
    rows = [(1, "u", AROUND % body()), (1, "u", AROUND % body()), (2, None, None), (None, "u", "")]
    pages = spark.createDataFrame([(*r, "old", 5) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    out = H.extract(pages)
    got = out.collect()
    assert sorted(out.columns) == sorted(pages.columns)
    assert [(r["text"], r["n_chars"]) for r in got if r["page_id"] == 1] == [(WANT, len(WANT))] * 2
    assert all((r["text"], r["n_chars"]) == ("", 0) for r in got if r["page_id"] != 1)
    assert H.extract(pages.filter("false")).count() == 0


def paragraphs(n, word):
    return [f"Paragraph {i} of {word} has enough words in it to be taken for the text of a page, and then some more words." for i in range(n)]


def test_title_and_lead_outside_the_body():
    lead, text = "A lead of a hundred and fifty characters that says in two lines what the article is about, and for whom it was written, when, and by which of the authors.", paragraphs(20, "body")
    want = "\n".join(["Title", lead, *text])
    inner = "".join(f"<p>{p}</p>" for p in text)
    page = AROUND % f"<div id=main><h1>Title</h1><p>{lead}</p><div class=body>{inner}</div></div>"
    assert H.main_text(page) == want
    assert H.main_text(AROUND % f"<div id=main><h1>Title</h1><div class=body>{inner}</div></div>") == "\n".join(["Title", *text])
    far = "<ul>" + "".join(f"<li>{x}</li>" for x in "abcdefgh") + "</ul>"  # the title's smoothed ratio is low
    assert H.main_text(AROUND % f"<div id=main><h1>T</h1><nav>{far}</nav><div class=body>{inner}</div></div>") == "\n".join(["T", *text])


def test_short_parts_beside_long_ones():
    long, short = paragraphs(30, "long"), paragraphs(2, "short")
    a, b = ("".join(f"<p>{p}</p>" for p in x) for x in (long, short))
    for tag in ("section", "article", "div"):
        assert H.main_text(AROUND % f"<div><{tag}>{a}</{tag}><{tag}>{b}</{tag}></div>") == "\n".join(long + short)
        assert H.main_text(AROUND % f"<{tag}>{b}</{tag}><{tag}>{a}</{tag}>") == "\n".join(short + long)
    assert H.main_text(AROUND % f"<table><tr><td>{a}</td><td>{b}</td></tr></table>") == "\n".join(long + short)


def test_tiny_parts_beside_long_ones():
    a = "".join(f"<p>{p}</p>" for p in paragraphs(30, "long"))
    for tag in ("section", "article"):
        assert H.main_text(AROUND % f"<{tag}>{a}</{tag}><{tag}><ul><li>x<li>y<li>z</ul></{tag}>") == "\n".join([*paragraphs(30, "long"), "x", "y", "z"])


def test_words_of_names_alone_drop_nothing():
    text = paragraphs(6, "the study")
    a = "".join(f"<p>{p}</p>" for p in text)
    parts = [('<section id="discussion"><h2>Discussion</h2>', "</section>", "Discussion"), ('<section id="comments"><h2>Comments</h2>', "</section>", "Comments"),
             ('<h2 id="related-work">Related work</h2>', "", "Related work"), ('<p class="notice">Take notice of this.</p>', "", "Take notice of this."),
             ('<div class="widget response">', "</div>", ""), ('<div id="skip-navigation-menu">', "</div>", "")]
    for tag in ("article", "main", "div"):
        for start, end, head in parts:
            want = "\n".join(["Title", *text, *([head] if head else []), *text])
            assert H.main_text(AROUND % f"<{tag}><h1>Title</h1>{a}{start}{a}{end}</{tag}>") == want, (tag, start)
    assert H.main_text(f'<div class="social widget">{a}</div>') == "\n".join(text)


def test_words_with_links_or_a_low_ratio_drop_the_part():
    text = paragraphs(6, "the study")
    a = "".join(f"<p>{p}</p>" for p in text)
    links = '<div class="related"><p><a href="/x">Another long story about something else, with a title that is as long as any paragraph of this page is, or longer.</a></p></div>'
    share = '<ul class="share"><li>Post</li><li>Mail</li><li>Print</li></ul>'
    for tag in ("article", "main", "div"):
        assert H.main_text(AROUND % f"<{tag}>{a}{links}{share}{a}</{tag}>") == "\n".join(text + text)


def test_words_of_names_in_a_page_without_wrapper():
    a = "".join(f"<p>{p}</p>" for p in paragraphs(6, "the study"))
    page = f'<html><body><h1>Title</h1>{a}<h2 id="related-work">Related work</h2>{a}<p class="notice">Take notice.</p>%s</body></html>'
    want = "\n".join(["Title", *paragraphs(6, "the study"), "Related work", *paragraphs(6, "the study"), "Take notice."])
    assert H.main_text(page % "") == H.main_text(page % '<div id="comments"><p>A comment by a reader in some words.</p></div>') == want


PROSE = "A reader wrote this with as many words as a paragraph of the article has, so that no ratio tells them apart from it, and then some more."


def test_comments_adverts_and_notices_among_the_text():
    text = paragraphs(6, "the study")
    a = "".join(f"<p>{p}</p>" for p in text)
    prose = f"<p>{PROSE}</p>" * 12  # more than the article
    parts = [f'<section class="comments"><h2>Comments</h2>{prose}</section>', f'<div id="cookie-notice">{PROSE}</div>', f'<div class="advert">{PROSE}</div>',
             f'<div class="box adBanner">{PROSE}</div>', f'<ol class="comment-list"><li class="comment">{prose}</li></ol>', f'<p class="advertisement">{PROSE}</p>',
             f'<div class="newsletter-signup"><p>{PROSE}</p></div>', f'<section id="comments">{prose}</section>', f'<div class="post-footer">{PROSE}</div>']
    for tag in ("article", "main", "div", "section"):
        for part in parts:
            assert H.main_text(AROUND % f"<{tag}><h1>Title</h1>{a}{part}{a}</{tag}>") == "\n".join(["Title", *text, *text]), (tag, part[:40])
            assert H.main_text(AROUND % f"<{tag}><h1>Title</h1>{a}</{tag}>{part}") == "\n".join(["Title", *text]), (tag, part[:40])
    thread = "".join(f'<article class="comment"><p>{PROSE}</p></article>' for _ in range(5))
    assert H.main_text(AROUND % f"<article>{a}</article>{thread}") == H.main_text(AROUND % f"<article>{a}{thread}</article>") == "\n".join(text)


def test_names_of_wrappers_and_of_other_things():
    text = paragraphs(6, "the study")
    a = "".join(f"<p>{p}</p>" for p in text)
    for attrs in ('class="sidebar content"', 'class="right-sidebar"', 'id="ad-wrapper"', 'class="post comments-open"', 'id="cookies-and-privacy"', 'class="ad-free page"'):
        assert H.main_text(f"<div {attrs}><h1>Title</h1>{a}</div>") == "\n".join(["Title", *text]), attrs
        assert H.main_text(f"<div {attrs}><main>{a}</main><p>x</p></div>") == "\n".join(text), attrs
    assert H.main_text(f'<div class="comments">{a}</div>') == "\n".join(text)  # all there is
    assert H.main_text(AROUND % f'<article>{a}<h2 class="comments">Comments on the study</h2>{a}</article>') == "\n".join([*text, "Comments on the study", *text])


def test_copyright_line_at_the_end():
    text = paragraphs(6, "the study")
    a = "".join(f"<p>{p}</p>" for p in text)
    for line in ("Copyright 2024 Some House. All rights reserved.", "&copy; 2019 Some House", "(c) Some House, all rights reserved"):
        assert H.main_text(f"<html><body><h1>Title</h1>{a}<div>{line}</div></body></html>") == "\n".join(["Title", *text])
    assert H.main_text(f"<body>{a}<p>Copyright is a right of authors.</p></body>").endswith("Copyright is a right of authors.")
    assert H.main_text("<p>Copyright 2024</p>") == "Copyright 2024"


def test_many_open_elements():
    import time
    import tracemalloc

    for start in ("<div>", '<div class="ad">', '<section id="comments">', "<article>", "<li><ul>"):
        n = 50_000 if start == "<div>" else 10_000
        page = "".join(f"{start}line {i} has some words" for i in range(n))
        if start == "<div>":
            tracemalloc.start()
        began = time.process_time()
        lines = H.main_text(page).split("\n")
        assert time.process_time() - began < 20, start  # it was quadratic
        if start == "<div>":
            assert tracemalloc.get_traced_memory()[1] < 300 << 20 and lines == [f"line {i} has some words" for i in range(n)]
            tracemalloc.stop()


def test_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "<p>a b</p>", "x", "y")], "page_id long, html string, page string, __page string")
    row = H.extract(pages).first()
    assert row.asDict() == {"page_id": 1, "html": "<p>a b</p>", "page": "x", "__page": "y", "text": "a b", "n_chars": 3}
