"""HTML extraction, URL filter, codec and quote linking against brute force and fixed cases."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from hirescope.llm import chat_quotes, common, html_extract, sp_codec, url_filter

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><h1>Site, name, and, more</h1></header><nav><ul><li><a href=/a>A</a></li></ul></nav>
<div class="cookie-notice">We use cookies, yes, we, do</div><div class="ad">Buy, buy, buy</div>
<div id="content"><h2>Head &amp; tail</h2><p>One two,\n  three &#8212; four.<p>Second &lt;b&gt; <a href="x>y">link</a> end
<ul><li>item one<li>item two</ul><script>if (a < b) { "</p>" }</script></div>
<aside><p>Side, text, with, many, commas, all, over</p></aside>
<section id="comments"><p>I, disagree, strongly, with, everything, here</p></section>
<form><p>Send, this</p></form><footer>&copy; footer</footer>"""


def test_main_text_of_a_page():
    assert html_extract.main_text(PAGE) == "Head & tail\n\nOne two, three — four.\n\nSecond <b> link end\n\nitem one\n\nitem two"


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<html></html>", ""), ("plain, text", "plain, text"), ("<p>un<b>closed", "unclosed"),
    ("<article><h1>Es.</h1><p>Be.</p></article>", "Es.\n\nBe."), ("<nav><p>only, a, menu</p></nav>", ""),
    ("<article><p>a<!-- x --><br>b</p><p> </p></article>", "a b"), ("<article><p>x &amp y &am z</p>", "x & y &am z"),
    ("<main><article><header><h1>T</h1></header><pre>a  b\n c</pre></article></main>", "T\n\na b c"),
    ("<", "<"), ("a < b", "a < b"), ("<script>x", ""), ("<article><p>" + "w, " * 50_000, ("w, " * 50_000).strip())])
def test_main_text_cases(page, text):
    assert html_extract.main_text(page) == text


LONG, SHORT = "word, and, more, " * 18 + "long.", "A short section's text."


def test_main_text_keeps_uneven_parts():
    sections = f"<section>{f'<p>{LONG}</p>' * 40}</section><section>{f'<p>{SHORT}</p>' * 3}</section>"
    whole = "\n\n".join([LONG] * 40 + [SHORT] * 3)
    assert html_extract.main_text(f"<body><article>{sections}</article><div><a href=x>More</a></div>") == whole
    assert html_extract.main_text(f"<main><h1>T</h1><div>{sections}</div>end</main>") == f"T\n\n{whole}\n\nend"
    parts = sections.replace("section>", "div>")
    page = f"<div><i>Loose lead, text</i>{parts}<b>and</b> <i>after</i><div><a href=x>More</a></div></div><nav>n</nav>"
    assert html_extract.main_text(page) == f"Loose lead, text\n\n{whole}\n\nand after"


PARAS = "".join(f"<p>{w}, a sentence of some length, with commas, that goes on for a while until it ends here.</p>" for w in ("Uno", "Dos", "Tres"))
OTHERS = PARAS.replace("Uno", "Alpha").replace("Dos", "Beta").replace("Tres", "Gamma")
LINKS = "<div><a href=a>One, two</a> <a href=b>Three, four</a></div>"


def flat(html: str) -> str:
    import re

    return "\n\n".join(re.findall(r"<(?:p|h1|h2)[^>]*>(.*?)</", html))


@pytest.mark.parametrize("page", [
    f"<div id=content><div class=row><div class=sec>{PARAS}</div></div><div class=row><div class=sec>{OTHERS * 4}</div></div>{LINKS}</div>",
    f"<div id=content><div class=row><div class=sec>{PARAS * 4}</div></div><div class=row><div class=sec>{OTHERS}</div></div></div><div>(c) us</div>",
    f"<div><h1>The title</h1></div><div class=wrap>{PARAS}</div>{LINKS}",
    f"<main><article>{PARAS}</article><section><h2>More</h2><p>short</p></section>{LINKS}</main><div>Some company</div>",
    f"<article>{PARAS}<div class='ad-hoc'>{OTHERS}</div><p class='share-price'>Prices</p><section id='related-work'><p>Work</p></section></article>",
])
def test_main_text_keeps_the_whole_article(page):
    assert html_extract.main_text(f"<html><body>{page}</body></html>") == flat(page)


@pytest.mark.parametrize("name", ["comments", "comment-list", "related-posts", "share-buttons", "ad", "cookie-notice", "newsletter-box", "sidebar-left"])
def test_main_text_cuts_named_parts_inside_the_article(name):
    assert html_extract.main_text(f"<article>{PARAS}<div class='x {name}'>{OTHERS}</div></article>") == flat(PARAS)


def by_hand(page: str) -> str:
    """Points of every container from the definition, level by level, for pages without an article element."""
    root = html_extract.parse(page)
    nodes = list(html_extract._walk(root))
    html_extract.score(root)

    def own(n):
        texts = any(not isinstance(k, html_extract.Node) and k[0].strip() for k in n.kids)
        return n.chars and (n.tag in html_extract.PARAGRAPH or n.tag in html_extract.BLOCK and texts)

    points = {id(n): 0.0 for n in nodes}
    for n in nodes:
        if own(n):
            p = (1 + n.commas + min(n.chars / 100, 3)) * (1 - n.linked / n.chars)
            up = n.parent if n.tag in html_extract.PARAGRAPH else n
            while up is not None:
                points[id(up)] += p
                p, up = p / 2 if up.tag in html_extract.BLOCK else p, up.parent
    assert all(n.points == pytest.approx(points[id(n)]) for n in nodes)
    return root


def test_points_equal_their_definition():
    rng = np.random.default_rng(6)
    for _ in range(40):
        parts = []
        for _ in range(60):
            parts.append(str(rng.choice(["<div>", "</div>", "<b>", "</b>", "<section>", "</section>", "<p>one, two</p>", "loose, text",
                                         "<a href=x>linked words</a>", "<ul><li>item, x<li>item</ul>", "<h2>Head</h2>"])))
        by_hand("".join(parts))


def test_main_text_is_linear_in_the_page():
    import time

    for page in ("<div>" * 8000 + PARAS, "<b>" * 20_000 + "<p>x, y</p>" * 5000, "<ul>" + "<li><i>" * 20_000 + PARAS, "<p>x<b>" * 20_000):
        began = time.process_time()
        text = html_extract.main_text(page)
        assert time.process_time() - began < 3 and text


def test_extract_reads_named_columns_only(spark):
    d = spark.createDataFrame([(1, "u", "<p>hi</p>", "x"), (1, "u", "<p>hi</p>", "x"), (None, None, None, None)],
                              "page_id long, url string, html string, text string")
    rows = sorted(map(tuple, html_extract.extract(d).collect()), key=str)
    assert rows == [(1, "u", "hi", 2), (1, "u", "hi", 2), (None, None, "", 0)]


@pytest.mark.parametrize("url,host,path,rule,verdict", [
    ("http://x.com/a", "x.com", "/a", "com/", "allow"), ("http://EXAMPLE.com/en/1?q#f", "example.com", "/en/1", "example.com/en/", "block"),
    ("https://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("https://a.www.example.com/en/x", "a.www.example.com", "/en/x", "www.example.com/en/", "allow"),
    ("https://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"), ("http://a.net/es/1", "a.net", "/es/1", "net/es/", "block"),
    ("http://a.net/en/1", "a.net", "/en/1", None, None), ("http://a.com", "a.com", "", None, None), ("a.com/x", "", "", None, None),
    (None, "", "", None, None), ("", "", "", None, None), ("x://", "", "", None, None), ("http://h?x/y", "h", "", None, None)])
def test_urls_and_rules(url, host, path, rule, verdict):
    assert url_filter.split_url(url) == (host, path)
    assert url_filter.rule_of(host, path) == (rule, verdict)


def test_viterbi_is_the_best_of_all_splits():
    seg = url_filter.Segmenter({"cheap": 50, "pills": 40, "free": 60, "bets": 20, "the": 900, "a": 500, "heap": 5, "pill": 9})

    def cost(parts):
        return sum(seg.logp.get(p, seg.unknown - 2.3 * len(p)) for p in parts)

    for s in ("cheappills", "freebets", "thea", "xqz", "cheapx"):
        every = (tuple(s[i:j] for i, j in itertools.pairwise((0, *cut, len(s))))
                 for k in range(len(s)) for cut in itertools.combinations(range(1, len(s)), k))
        assert math.isclose(cost(seg.split(s)), max(map(cost, every)))
    assert seg.split("cheappills") == ("cheap", "pills")


PLAIN = [(f"https://www.{w}news.example.org/{p}", f"<script>var pharmaword=1;</script><p>the {w} news of a health farm, peaks &amp; essex für größe {x}</p>")
         for w in ("city", "river", "sport", "health") for p in ("a/1", "b/2.html", "en/3", "win/4") for x in ("twin", "one")]
SPAM = [(f"http://{h}.example.biz/{p}", "<p>cheap pills casino</p>") for h in ("cheappills", "casinobonus", "cheapviagra", "pokerslots")
        for p in ("buy", "now/order", "x")]
ODD = [("http://twinpeaks.org/", "<p>x</p>"), ("http://essexwin.de/", ""), ("http://www.sexualhealth.org/win", None),
       ("http://cheappills.example.info/", ""), ("http://a.b:8/x", ""), (None, None), ("http://" + "pill" * 4000 + ".com/x", ""),
       ("http://rarewordhost.example/qqq/zzz/yyy/www/uuu", "")]


def judged(spark, rows, parts=3):
    d = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string").repartition(parts)
    return {r.page_id: r for r in url_filter.judge(d, rules=()).collect()}


def test_ordinary_hosts_are_allowed_and_spam_is_blocked(spark):
    rows = PLAIN + SPAM + ODD
    got = judged(spark, rows)
    odd = [got[len(PLAIN) + len(SPAM) + i].verdict for i in range(len(ODD))]
    assert odd == ["allow", "allow", "allow", "block", "allow", "allow", "allow", "allow"], odd
    assert all(got[i].verdict == "allow" for i in range(len(PLAIN)))
    assert all(got[len(PLAIN) + i].verdict == "block" for i in range(len(SPAM)))


def test_nothing_is_blocked_without_an_example(spark):
    rows = PLAIN + ODD[:3] + ODD[4:]
    assert {r.verdict for r in judged(spark, rows).values()} == {"allow"}
    words = {r.word: r.n for r in url_filter.unigrams(spark.createDataFrame(
        [("<p>für größe &amp; Ärzte</p><style>b{c}</style><script>if(a<b){hidden}</script>" + "w" * 40,)], "html string")).collect()}
    assert words == {"für": 1, "größe": 1, "ärzte": 1, "w" * 40: 1}


def test_naive_bayes_equals_brute_force(spark):
    rows = PLAIN + SPAM
    got = judged(spark, rows)
    count = [{}, {}]
    pages = [0, 0]
    for i, r in got.items():
        host, path = url_filter.split_url(rows[i][0])
        n_host = len(r.tokens.split()) - len(url_filter.path_tokens(path))
        words = r.tokens.split()[:n_host]
        toks = url_filter.tokens(" ".join(words), path)
        y = int(url_filter.is_example(url_filter.by_label(host, " ".join(words)), toks))
        assert y == int(i >= len(PLAIN))
        pages[y] += 1
        for t in toks:
            count[y][t] = count[y].get(t, 0) + 1
    total = [sum(c.values()) for c in count]
    for i, r in got.items():
        host, path = url_filter.split_url(rows[i][0])
        words = r.tokens.split()[:len(r.tokens.split()) - len(url_filter.path_tokens(path))]
        score = math.log((pages[1] + 1) / (pages[0] + 1))
        for t in url_filter.tokens(" ".join(words), path):
            share = sum(c.get(t, 0) for c in count) / sum(total)
            p = [math.log((c.get(t, 0) + 50 * share) / (n + 50)) for c, n in zip(count, total, strict=True)]
            score += p[1] - p[0]
        assert r.score == pytest.approx(score, abs=1e-3)


def test_a_hot_host_is_dealt_in_pieces(spark, monkeypatch):
    rows = [(f"http://hothost.example.org/p/{i}", "<p>hot host</p>") for i in range(300)] + PLAIN
    whole = {i: r.tokens for i, r in judged(spark, rows).items()}
    monkeypatch.setattr(url_filter, "SPLIT", 20)
    assert {i: r.tokens for i, r in judged(spark, rows).items()} == whole and len(whole) == len(rows)


def test_url_filter_blocks_spam_hosts(spark):
    urls = [f"http://{h}.example.org/en/{i}" for i in range(30) for h in ("garden", "www.cheappills", "blog.news")]
    d = spark.createDataFrame([(i, u, "<p>garden news cheap pills</p>") for i, u in enumerate([*urls, None, "x"])],
                              "page_id long, url string, html string").withColumn("verdict", common.F.lit("mine"))
    rows = url_filter.judge(d).collect()
    assert len(rows) == len(urls) + 2
    assert all((r.verdict == "block") == ("cheappills" in r.host) for r in rows)


def test_rare_words_split_labels_too(spark):
    # 60,000 words of one count: the longer label is no "bet" with a rest, however many words are as frequent
    letters = "abcdefghijklmnopqrstuvwxyz"
    rare = " ".join("zz" + letters[i % 26] + letters[i // 26 % 26] + letters[i // 676 % 26] + letters[i // 17576] for i in range(60_000))
    d = spark.createDataFrame([(1, "http://alphabeticgarden.org/x", f"<p>{'the ' * 3000}{rare} alphabetic garden</p>"),
                               (2, "http://www.cheappills.org/9", "<p>cheap pills</p>"), (3, None, None)],
                              "page_id long, url string, html string")
    got = {r.page_id: (r.tokens, r.host) for r in url_filter.judge(d).collect()}
    assert got == {1: ("alphabetic garden org x", "alphabeticgarden.org"), 2: ("www cheap pills org #", "www.cheappills.org"), 3: ("", "")}


TEXTS = ["", " ", "hello world", " a  b▁c é🙂\n\t", "▁", "\n\n x\n", "<0x0A> <s> a", "日本語テスト漢字", "a" * 3000, " \n ▁▁ b",
         "\x00\x01", "é\u2003x \u00a0", "tiontion thereea " * 2000]


def test_rate_zero_is_plain_sentencepiece(spark, base):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=sp_codec.MODEL)
    c = sp_codec.Codec(rate=0.0)
    docs = [r.text for r in common.read(spark, base, "documents").select("text").collect() if r.text]
    for t in [x for x in TEXTS if sp_codec.MARK not in x] + docs:
        assert c.encode(t).tolist() == sp.encode(t)


def test_dropout_varies_repeats_and_decodes():
    c, again = sp_codec.Codec(seed=5), sp_codec.Codec(seed=5)
    plain, other = sp_codec.Codec(rate=0.0), sp_codec.Codec(seed=6)
    for t in TEXTS:
        ids = c.encode(t, 1)
        assert c.decode(ids) == t and np.array_equal(ids, again.encode(t, 1))
    long = TEXTS[-1] + " ".join(f"word{i}ing" for i in range(500))
    assert len({c.encode(long).tobytes(), other.encode(long).tobytes(), plain.encode(long).tobytes()}) == 3
    assert len(c.encode(long)) > len(plain.encode(long))


def test_matrix_agenda_equals_the_queue():
    c = sp_codec.Codec(rate=0.3)
    units = sorted({u.replace(" ", sp_codec.MARK) for t in TEXTS for u in t.replace("▁", "").split("\n") if 0 < len(u) < 40}
                   | {"▁thereation", "▁x", "q", "▁▁▁wörter🙂", "日本語"})
    for v in range(sp_codec.VARIANTS):
        assert c._units(units, np.full(len(units), v)) == [c._unit(u, v) for u in units]


def test_every_occurrence_has_draws_of_its_own(spark):
    c, plain = sp_codec.Codec(), sp_codec.Codec(rate=0.0)
    word, n = " national", 4000
    whole = plain.encode(word[1:]).tolist()
    skips = [next(c._skips(x)) for x in common.mix64(np.arange(1, 20_001, dtype=np.uint64))]
    for k in (1, 3, 8):  # each candidate is skipped with the rate
        assert abs(sum(s >= k for s in skips) / 20_000 - 0.9 ** k) < 0.015
    ids = c.encode((word * n)[1:], 3)
    cuts, begin = [], 0
    for i, end in enumerate(np.cumsum([len(c.bytes_of[t]) for t in ids.tolist()])):
        if end % len(word) == 0:
            cuts.append(tuple(ids[begin:i + 1].tolist()))
            begin = i + 1
    assert len(cuts) == n and len(set(cuts)) > 10 and whole == list(max(set(cuts), key=cuts.count))
    assert len({c.encode("national", k).tobytes() for k in range(300)}) > 5  # and in every document
    d = spark.createDataFrame([(1, "nation " * 50), (1, "nation " * 50), (2, "nation " * 50)], "doc_id long, text string").coalesce(1)
    rows = sp_codec.encode(d, lossless="ok", copies=True).collect()
    assert len({tuple(r.ids) for r in rows}) == 3 and all(r.ok for r in rows)
    # copies are told apart wherever they lie; rows of one id with other texts are no copies
    more = d.unionByName(spark.createDataFrame([(1, "nation " * 3)], "doc_id long, text string"))
    sets = [sorted((r.doc_id, tuple(r.ids)) for r in sp_codec.encode(x, copies=True).collect())
            for x in (more.coalesce(1), more.repartition(6), more.orderBy(F.rand(3)))]
    assert sets[0] == sets[1] == sets[2] and len(set(sets[0])) == 4 and sp_codec.encode(d, copies=True).columns == ["doc_id", "text", "ids"]


def test_codec_tables(spark):
    d = spark.createDataFrame([(1, "a b", 3), (1, "a b", 3), (None, None, None), (2, "", 0)], "doc_id long, text string, n_tokens long")
    rows = sp_codec.encode(d.withColumnRenamed("n_tokens", "extra"), lossless="ok")
    back = {r.doc_id: r for r in sp_codec.decode(rows, text="back").collect()}
    assert back[1].back == "a b" and back[2].back == "" and back[2].ids == [] and back[None].ids is None and back[None].back is None
    assert all(r.ok for r in rows.collect()) and rows.count() == 4


CHAT = [(1, 0, "user", "Hello there.\nHow are you?\n\nSecond  para, here"), (1, 1, "assistant", "> hello there.\n> how are  YOU?\nFine"),
        (1, 2, "user", "unrelated"), (1, 3, "user", ">> Hello there.\n> Fine\n\nGood"),
        (1, 4, "assistant", "> unrelated\nok\n> second para, here\nyes"), (2, 0, "user", "> Fine\nx"), (2, 1, None, None),
        (None, None, "user", "hi"), (1, 5, "user", "> Good\n"), (1, 5, "user", "> Good\n"), (3, 7, "user", "a > b"), (3, 8, "user", "> a > b")]


def brute_quotes(rows):
    """Per row: reply_to, thread and text, line by line."""
    import re

    mark = re.compile(r"^[ \t]*(?:>[ \t]*)+")

    def norm(s):
        return re.sub(r"[\s \"'`‘’“”«»]+", " ", s.lower()).strip(" ")

    def parse(t):
        return [((m.group().count(">") if (m := mark.match(x)) else 0), mark.sub("", x)) for x in re.split(r"\r\n|\n|\r", t or "")]

    own, out, parent = {}, [], {}
    for k, (c, t, _, text) in enumerate(rows):
        ls = parse(text)
        mine = text or ""
        if any(n for n, _ in ls):
            mine = re.sub(r"\n{3,}", "\n\n", "\n".join(b for n, b in ls if n == 0)).strip()
        for p in {norm(x) for x in [mine, *re.split(r"\n[ \t]*\n", mine), *mine.split("\n")]}:
            if p and t is not None:
                own[c, p] = min(own.get((c, p), t), t)
        out.append([c, t, mine])
    for k, (c, t, _, text) in enumerate(rows):
        runs = []
        for n, b in parse(text):
            if runs and runs[-1][0] == n and b.strip(" ") and runs[-1][1].strip(" "):
                runs[-1][1] += "\n" + b
            else:
                runs.append([n, b])
        hits = [(n, i, own[c, norm(b)]) for i, (n, b) in enumerate(r for r in runs if r[0]) if norm(b)
                and own.get((c, norm(b)), t) is not None and t is not None and own.get((c, norm(b)), t) < t]
        if hits:
            parent[c, t] = min(hits)[2]
    for row in out:
        at = (row[0], row[1])
        row.append(parent.get(at))
        while at in parent:
            at = (at[0], parent[at])
        row.append(at[1])
    return sorted(((*r,) for r in out), key=str)


def test_quote_linking_equals_brute_force(spark):
    d = spark.createDataFrame(CHAT, "conv_id long, turn long, role string, text string").withColumn("thread", common.F.lit("x"))
    got = chat_quotes.link_quotes(d).select("conv_id", "turn", "text", "reply_to", "thread").collect()
    assert sorted(map(tuple, got), key=str) == brute_quotes(CHAT)


def test_quotes_of_parts_of_paragraphs_link(spark):
    four = "First line of four\nsecond line here\nand the third one\nthen the last"
    rows = [(1, 0, "user", four), (1, 1, "user", "It was late. Nobody came, sadly. We left."), (1, 2, "user", "noise"),
            (1, 3, "user", "> second line here\n> and the third one\nyes"), (1, 4, "user", "> nobody came, sadly.\nTrue"),
            (1, 5, "user", "> never written\n> by anyone\nno"), (1, 6, "user", "> and the third one\n> It was late. Nobody\nhm"),
            (2, 1, "user", "> second line here\n> and the third one\nother conversation")]
    got = {(r.conv_id, r.turn): (r.reply_to, r.thread, r.n_linked) for r in chat_quotes.link_quotes(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got == {(1, 0): (None, 0, 0), (1, 1): (None, 1, 0), (1, 2): (None, 2, 0), (1, 3): (0, 0, 1), (1, 4): (1, 1, 1),
                   (1, 5): (None, 5, 0), (1, 6): (0, 0, 1), (2, 1): (None, 1, 0)}


def test_messages_come_in_reply_order(spark):
    d = spark.createDataFrame([(c, t, "user", f"m{t}" if t % 3 else f"> m{t - 2}\nm{t}") for t in range(9, -1, -1) for c in (2, 1)],
                              "conv_id long, turn long, role string, text string").repartition(5)
    got = [(r.conv_id, r.thread, r.turn) for r in chat_quotes.link_quotes(d).collect()]
    assert got == sorted(got) and [t for c, _, t in got if c == 1] != sorted(t for c, _, t in got if c == 1)


def test_quote_linking_follows_long_chains(spark):
    rows = [(1, i, "user", f"message number {i}" if not i else f"> message number {i - 1}\nmessage number {i}") for i in range(60)]
    got = chat_quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {r.thread for r in got} == {0} and all(r.reply_to == (r.turn - 1 if r.turn else None) for r in got)
    assert all(">" not in r.text for r in got)


def test_all_conversations_keep_their_messages(spark, base):
    d = common.read(spark, base, "conversations")
    got = chat_quotes.op5_quote_linking(spark, base)
    assert got.select("conv_id", "turn", "role").exceptAll(d.select("conv_id", "turn", "role")).count() == 0
    assert got.count() == d.count()


def test_word_hashes_split_like_bytes():
    texts = ["A b\x0bc\x0c\rd", None, "", " é\u00a0x ", "\U0001F642 A"]
    h, doc = common.word_hashes(pa.array(texts), True)
    words = [(i, w) for i, t in enumerate(texts) for w in (t or "").encode().lower().split()]
    assert doc.tolist() == [i for i, _ in words]
    assert len(set(zip(h.tolist(), [w for _, w in words], strict=True))) == len({w for _, w in words})


def test_passages_of_a_very_long_message_take_linear_time(spark):
    import time

    def seconds(n: int) -> float:
        text = "\n".join(("> " if i % 2 else "") + f"line {i}" for i in range(n))
        d = spark.createDataFrame([(1, text)], "i int, text string")
        began = time.time()
        got = d.select(chat_quotes.passages(chat_quotes.lines(F.col("text"))).alias("p")).selectExpr("size(p) as n", "p[1] as q").first()
        assert got.n == n and (got.q.level, got.q.body) == (1, "line 1")
        return time.time() - began

    seconds(100)
    assert seconds(100_000) < 15
