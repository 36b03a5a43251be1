"""Language ID, personal data, toxicity, HTML and chat against brute force and edge cases."""

import hashlib
import html
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quillspark.llm import chat, extract_html, language, pii, queries, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def documents(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}


# --- language ---------------------------------------------------------------------------

def test_language_held_out_accuracy_and_fold(spark):
    docs = documents(spark)
    out = queries.op3_language(spark, SF_SMALL).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in out)
    held = [r for r in out if r["held_out"] and r["lang_pred"] != "und"]
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in out)


def test_language_edge_cases(spark):
    rows = [(i, t, k, "s", 0) for i, (t, k) in enumerate([("the cat and the dog", "en"), ("der Hund und die Katze", "de")] * 4)]
    train = docs_of(spark, rows + [(90, "unlabelled", None, "s", 0), (91, None, "en", "s", 0)])
    ask = docs_of(spark, [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "123 !!! ²", "en", "s", 0),
                          (4, "the dog", "de", "s", 0), (4, "the dog", "de", "s", 0), (5, "der Hund " * 200000, "en", "s", 0),
                          (6, "\U00020000\U00020001", "en", "s", 0)]).withColumn("language", F.lit("clash"))
    got = {(r["doc_id"]): r["found"] for r in language.identify(ask, train, out="found").collect()}
    assert got[1]["lang"] == got[2]["lang"] == got[3]["lang"] == "und" and got[1]["score"] == 0
    assert got[4]["lang"] == "en" and got[5]["lang"] == "de" and got[6]["lang"] in ("en", "de")
    assert language.identify(ask, train).where("doc_id = 4").count() == 2
    assert language.identify(ask.limit(0), train).count() == 0
    assert {r["language"]["lang"] for r in language.identify(ask, train.limit(0)).collect()} == {"und"}


def test_language_grams_of_all_lengths():
    whole = sorted(int(x) for a in language.Grams().buckets("Abc déf 12 ghi") for x in a)
    text = "Abc déf 12 ghi"
    one = {n: [int(x) for a in language.Grams(lengths=(n,)).buckets(text) for x in a] for n in (1, 2, 3)}
    assert sorted(sum(one.values(), [])) == whole and len(one[1]) > len(one[3]) > 0


# --- personal data ----------------------------------------------------------------------

BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(d := re.sub("[^0-9]", "", s)) <= 19 and brute_luhn(d)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(re.sub("[^0-9]", "", s)) <= 15)]


def brute_luhn(digits):
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(map(int, str(2 * int(d)))) for d in even)) % 10 == 0


def brute_base(text):
    found = [(m.start(), k, m.end(), name) for k, (name, rx, ok) in enumerate(BASE)
             for m in re.finditer(rx, text or "") if ok(m.group())]
    return [(n, s, e) for s, _, e, n in sorted(found)]


TRICKY = ["a@b.c_d@e.f", "@@a@b.c", "x@y", "a.b@c-d.e.f@g.h", "1.2.3.4.5.6.7.8", "300.1.1.1 1.1.1.300 12.34.56.78", "0000255.0.0.1",
          "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111112", "+1 (555) 123-4567", "+12345", "+1      ", "é@é.é a@é.b",
          "1" * 5000, "9" * 4000 + ".1.1.1", "a" * 5000 + "@", "+4" + " " * 3000 + "3", "１２３@x.y", "", "mail me: a%b@x.org."]


@pytest.mark.parametrize("text", TRICKY)
def test_pii_base_spans_match_plain_regexes(text):
    assert [s[:3] for s in pii.spans(text) if s[4]] == brute_base(text)


def test_pii_base_spans_random():
    import random
    r = random.Random(3)
    for _ in range(3000):
        t = "".join(r.choice("0123456789..--  ++@@()ab%é\n") for _ in range(r.randint(0, 60)))
        assert [s[:3] for s in pii.spans(t) if s[4]] == brute_base(t), t


def test_pii_added_kinds_need_checksum_or_context():
    kinds = lambda t: [s[0] for s in pii.spans(t)]
    assert kinds("pay to DE89370400440532013000 now") == ["iban"]
    assert "iban" not in kinds("pay to DE89370400440532013001 now")
    assert kinds("number 123-45-6789") == [] and kinds("my ssn is 123-45-6789") == ["ssn"]
    assert kinds("tel: (030) 1234567") == ["local_phone"] and kinds("room (030) 1234567") == []
    near = {s[0]: s[3] for s in pii.spans("credit card 4111111111111111")}
    assert near["card"] > {s[0]: s[3] for s in pii.spans("number 4111111111111111")}["card"]


def test_pii_query_against_brute_force(spark):
    docs = documents(spark)
    for r in queries.op7_pii(spark, SF_SMALL).collect():
        base = brute_base(docs[r["doc_id"]]["text"])
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r[f"n_{k}"] for k, *_ in BASE] == [sum(b[0] == k for b in base) for k, *_ in BASE]
        assert set(text.split(",")) <= set(r["spans"].split(",")) | {""}


def test_pii_edges_and_mask(spark):
    df = docs_of(spark, [(1, None, None, None, None), (2, "", None, None, None), (3, "x a@b.de 1.2.3.4", "en", "s", 1)])
    got = {r["doc_id"]: r["spans"] for r in pii.find_pii(df.withColumn("pii", F.lit(1)), out="spans").collect()}
    assert got[1] == got[2] == [] and [s["kind"] for s in got[3]] == ["email", "ip"]
    assert {r["doc_id"]: r["text"] for r in pii.mask(df).collect()} == {1: None, 2: "", 3: "x [email] [ip]"}
    assert pii.find_pii(df.limit(0)).count() == 0


# --- toxicity ---------------------------------------------------------------------------

def test_toxicity_separates_held_out_labels(spark):
    sf = SF_SMALL.replace("sf0.001", "sf0.01")
    out = queries.op10_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    held = [r for r in out if r["held_out"]]
    pos, neg = [r["score"] for r in held if r["toxic"]], [r["score"] for r in held if not r["toxic"]]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert wins >= 0.85 and sum(r["predicted"] for r in held if not r["toxic"]) <= 0.02 * len(neg)


def test_toxicity_edges(spark):
    f = dict(zip(toxicity.FEATURES, toxicity.features("You IDIOT!! 1d10t st*pid, noooo", {"idiot": 2.0, "stpid": 1.0})))
    assert f["near_you"] > 0 and f["obfuscated"] > 0 and f["letter_runs"] > 0 and f["capitals"] > 0 and f["lexicon_top"] == 2.0
    assert toxicity.features(None, {}) == toxicity.features("", {}) == [0.0] * len(toxicity.FEATURES)
    rows = spark.createDataFrame([(1, "a", 1), (2, None, 1), (3, "b", None)], "doc_id long, text string, toxic int")
    ask = docs_of(spark, [(1, None, None, None, None), (1, None, None, None, None), (2, "x " * 300000, "en", "s", 1)]).withColumn(
        "p", F.lit("clash")).withColumn("f", F.lit(1)).withColumn("_row", F.lit(2))
    for train in (rows, rows.limit(0)):  # one class, or nothing to learn from
        got = toxicity.score(ask, toxicity.train(train))
        assert got.count() == 3 and all(0 <= r["toxicity"] <= 1 for r in got.collect())
    both = spark.createDataFrame([(i, "you idiot" if i % 2 else "a good day", i % 2) for i in range(80)], "doc_id long, text string, toxic int")
    got = toxicity.score(ask, toxicity.train(both))
    assert got.columns == [*ask.columns, "toxicity"] and got.count() == 3
    assert toxicity.score(ask.limit(0), toxicity.train(both)).count() == 0


def rare_insults(spark, n, toxic, copies=0):
    """Prose of ``n`` texts, of which ``toxic`` call the reader "du blarg" or "du fnord", and copies of one of them."""
    r = random.Random(n)
    say = lambda i: " ".join(r.choice(["haus", "baum", "weg", "tag", "licht", "wald", "stein", "fluss"]) + chr(97 + r.randrange(26))
                             for _ in range(30)) + (f" du {'blarg' if i % 2 else 'fnord'}" if i < toxic else "")
    rows = [(i, say(i), int(i < toxic)) for i in range(n)]
    rows += [(n + i, "quux " + rows[0][1], 1) for i in range(copies)]
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxicity_rare_class_is_parted(spark):
    rows = rare_insults(spark, 4800, 24)  # half a percent
    out = toxicity.score(rows, toxicity.train(rows, words=("blarg", "fnord"))).collect()
    assert sum(r["toxicity"] >= 0.5 for r in out if r["toxic"]) >= 20 and not any(r["toxicity"] >= 0.5 for r in out if not r["toxic"])
    some = toxicity.sampled(rows, bound=400)
    got = some.collect()
    assert sum(r["toxic"] for r in got) == 24 and 250 < len(got) < 550
    assert abs(sum(r["weight"] for r in got) - 4800) < 960


def test_toxicity_lexicon_needs_texts_not_contexts(spark):
    rows = rare_insults(spark, 3000, 300, 200)
    model = toxicity.train(rows, words=())
    assert {"blarg", "fnord"} <= set(model.lexicon) and "quux" not in model.lexicon  # one text and its copies teach nothing


# --- HTML -------------------------------------------------------------------------------

def brute_article(page):
    a = page[page.find("<article>") + 9:page.find("</article>")]
    a = re.sub(r"</?(p|h\d|br)[^>]*>", " ", a)
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", a)).split())


def test_html_query_against_article_text(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    out = queries.op1_html(spark, SF_SMALL).collect()
    assert sorted(r["page_id"] for r in out) == sorted(pages)
    for r in out:
        assert r["text"] == brute_article(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"])
        assert r["url"] == pages[r["page_id"]]["url"]


def page(body, menu="x"):
    return f"<html><head><title>T</title></head><body><nav><ul><li>{menu}</li></ul></nav>{body}<footer>&copy; us</footer></body></html>"


def test_html_edges(spark):
    cases = {
        1: (None, ""), 2: ("", ""), 3: ("plain &amp; text\n here", "plain & text here"),
        4: ("<p>a<b>b</b>c<p>d&#233;<br>e&nbsp;f<script>var x='</p>';</script>", "abc dé e f"),
        5: (page("<article><h1>H</h1><div class='comments'><p>bad</p></div><form>f</form><p>t</p><aside>s</aside></article><div>o</div>"), "H t"),
        6: (page("<div id='cookie-notice'>n</div><main><p>m</p></main>"), "m"),
        7: ("<!-- <p>no</p> --><p>yes</p><!-- open", "yes"), 8: ("<p>a < b</p><p title='x>y'>c</p>", "a < b c"),
        9: ("<style>p{}</style><article>" + "w " * 200000 + "</article>", " ".join(["w"] * 200000)),
        11: (page("<article><header class='entry-header'><h1>T</h1></header><p>t</p><footer>f</footer></article>", "y"), "T t"),
        12: ("<a " * 30000, " ".join(["<a"] * 30000)), 13: ("<a \"" * 5000 + ">x", None),
        14: ("<div>" * 30000 + "deep" + "</p></nav>" * 30000, "deep"),
        10: (page("<article class='comment'>c</article><article>real</article>"), "real"),
    }
    schema = "page_id long, url string, html string, host string, template int"
    df = spark.createDataFrame([(k, f"http://h{k}.org/", v[0], "clash", 1) for k, v in cases.items()], schema)
    got = extract_html.extract(df)
    assert got.columns == [*df.columns, "text"]
    assert {r["page_id"]: r["text"] for r in got.collect() if r["page_id"] != 13} == {k: v[1] for k, v in cases.items() if k != 13}
    null = df.withColumn("url", F.lit(None).cast("string"))
    assert extract_html.extract(null).count() == len(cases) and extract_html.extract(df.limit(0)).count() == 0


def test_html_template_text_is_deduced_from_pages_of_a_host(spark):
    body = "<html><body><div><p>Welcome to our site</p></div><div><p>{0}</p></div><div><p>All rights reserved</p></div></body></html>"
    rows = [(i, "http://Host.org/a", body.format(f"story number {i}")) for i in range(6)]
    rows += [(10, "http://other.org/", body.format("single"))]  # no template from one page
    got = {r["page_id"]: r["text"] for r in extract_html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"story number {i}" for i in range(6))
    assert got[10] == "Welcome to our site single All rights reserved"


def test_html_repeated_articles_are_content_even_if_equal(spark):
    rows = [(i, "http://h.org/", page("<article><p>same story</p></article>")) for i in range(8)]
    got = extract_html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == 8 and {r["text"] for r in got} == {"same story"}


def test_html_template_text_inside_articles_and_per_layout(spark):
    story = "<article><h1>title {0}</h1><p>story number {0}</p><p>told at length {0}</p><div><p>Share this story</p></div></article>"
    item = "<section><table><tr><td>item {0}</td></tr></table><div><p>Call us today</p></div></section>"
    rows = [(i, "http://h.org/a", page(story.format(i))) for i in range(9)]
    rows += [(20 + i, "http://h.org/b", page(item.format(i))) for i in range(4)]  # a layout of a minority of the host's pages
    rows += [(40 + i, "http://near.org/", page(f"<article><h1>T</h1><p>one</p><p>two and more</p><p>{i}</p></article>")) for i in range(5)]
    got = {r["page_id"]: r["text"] for r in extract_html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"title {i} story number {i} told at length {i}" for i in range(9))
    assert all(got[20 + i] == f"item {i}" for i in range(4))
    assert all(got[40 + i] == f"T one two and more {i}" for i in range(5))  # near copies stay whole


def test_html_layout_words_drop_no_article(spark):
    story = "<article><p>story</p><div class='{0}'><p>inner</p></div></article>"
    cases = {1: ("<div id='page' class='with-sidebar'>" + story.format("x") + "</div>", "story inner"),
             2: ("<main class='no-sidebar'><p>story</p></main>", "story"), 3: ("<article class='post has-comments'><p>story</p></article>", "story"),
             4: ("<div class='menu-open'><article><p>story</p></article></div>", "story"),
             5: ("<section class='search-results'><article><p>story</p></article></section>", "story"),
             6: ("<div class='sidebar'><article><p>story</p></article></div><div class='x'>rest</div>", "story"),  # by a word alone
             7: (story.format("commentlist"), "story"), 8: (story.format("commentList"), "story"), 9: (story.format("post-comments wide"), "story"),
             10: (story.format("has-comments"), "story inner"), 11: ("<div class='with-sidebar'><p>plain</p></div><div class='site-footer'>f</div>", "plain"),
             12: ("<main><p>story</p><div class='related'><article><p>teaser</p></article></div></main>", "story"),
             13: ("<div class='related'><article><p>teaser</p></article></div><article><p>story</p></article>", "story"),
             15: ("<main><div class='widget-area'><article><p>story</p></article></div></main>", "story"),
             14: ("<nav><article><p>menu</p></article></nav><p>story</p>", "story")}
    df = spark.createDataFrame([(k, f"http://h{k}.org/", page(v[0])) for k, v in cases.items()], "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in extract_html.extract(df).collect()} == {k: v[1] for k, v in cases.items()}


# --- chat -------------------------------------------------------------------------------

MESSAGE = f"conv_id long, turn long, role string, content array<{chat.PART}>"


def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def test_chat_typed_parts(spark):
    rows = [(1, 0, "user", [part("text", "look <|image:0|> "), part("image", ref="a.png", width=56, height=57),
                            part("audio", ref="b.wav", seconds=1.0), part("text", "!")]),
            (1, 1, "assistant", [part("text", "ok"), part("document", ref="c.pdf", pages=2), part("video"), None, part(None)])]
    r = chat.format_chats(spark.createDataFrame(rows, MESSAGE)).first()
    assert r["formatted"] == ("<|turn|>user<|body|>look <\\|image:0|> <|image:0|><|audio:1|>!<|end|>"
                              "<|turn|>assistant<|body|>ok<|document:0|><|other:1|><|other:2|><|other:3|><|end|>")
    assert [(a["message"], a["kind"], a["ordinal"], a["ref"], a["tokens"]) for a in r["attachments"]] == [
        (0, "image", 0, "a.png", 6), (0, "audio", 1, "b.wav", 25), (1, "document", 0, "c.pdf", 1024),
        (1, "other", 1, None, 0), (1, "other", 2, None, 0), (1, "other", 3, None, 0)]
    assert r["n_tokens_attached"] == 6 + 25 + 1024
    (x,) = r["loss"]
    assert r["formatted"][x["start"]:x["start"] + x["length"]].startswith("ok<|document:0|>")


def test_chat_round_trip_of_hostile_texts(spark):
    import random
    r = random.Random(5)
    pool = ["<", "|", "\\", ">", "turn", "body", "end", "<|turn|>", "<|end|>", "<\\|", "$1", "\n", "é", "\U0001f600", ""]
    texts = ["".join(r.choice(pool) for _ in range(r.randint(0, 12))) for _ in range(300)] + [None, "", "x" * 300000]
    rows = [(i // 5, i % 5, r.choice(["user", "assistant", "a<|body|>b", None, "s\nt"]), t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_chats(df.select("conv_id", "turn", "role", chat.text_parts(F.col("text")).alias("content")))
    got = out.select("conv_id", "formatted", "loss", chat.read_turns(F.col("formatted")).alias("turns"),
                     chat.read_loss(F.col("formatted"), F.col("loss")).alias("read")).collect()
    for c in got:
        want = [(x[2] or "", x[3] or "") for x in rows if x[0] == c["conv_id"]]
        assert [(t["role"], t["text"]) for t in c["turns"]] == want
        assert c["read"] == "".join(t for who, t in want if who == "assistant")
        masked = [c["formatted"][x["start"]:x["start"] + x["length"]] for x in c["loss"]]
        assert [re.sub(r"<\\(\\*)\|", r"<\1|", m) for m in masked] == [t for who, t in want if who == "assistant"]


def test_chat_nulls_repeats_and_empty(spark):
    rows = [(None, None, None, None), (None, None, None, None), (3, 1, "user", []), (3, None, "user", [part("text", None)])]
    got = {r["conv_id"]: r for r in chat.format_chats(spark.createDataFrame(rows, MESSAGE).withColumn("who", F.lit(1))).collect()}
    assert got[None]["formatted"] == "<|turn|><|body|><|end|>" * 2 and got[3]["formatted"] == "<|turn|>user<|body|><|end|>" * 2
    assert got[3]["loss"] == [] and got[3]["attachments"] == []
    assert chat.format_chats(spark.createDataFrame([], MESSAGE)).count() == 0


def test_chat_query_has_the_added_conversation(spark):
    r = queries.op2_chat(spark, SF_SMALL).where("conv_id = -7").first()
    text = "\\### Assistant: </turn> ok"
    assert r["n_turns"] == 2 and r["loss_chars"] == len(text) and r["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert r["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
