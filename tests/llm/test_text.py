"""Python-side operators: brute force, exact round trips, held-out accuracy."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bisque.llm import common, op01_pii, op04_sentencepiece, op05_html, op07_chat, op08_toxicity, op09_quality

SF = "/root/testdata/sf0.001"
ODD = ["", None, " ", "\n\n", "x", "a b " * 20_000, "é" * 3000, "▁ ▁x", "\x00\x1f\x85  z"]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, clashing and extra columns."""
    rows = [(i, t, None if i % 2 else "s", 1.5, "mine") for i, t in enumerate(ODD)] * 2 + [(None, "no id", None, None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, Score double, `found` string")


# ---- 1


def test_feistel_is_a_permutation():
    f = op01_pii.Feistel(b"k")
    for n in (1, 2, 7, 1000):
        assert sorted(f.permute(i, n, "t") for i in range(n)) == list(range(n))
        assert all(f.permute(f.permute(i, n, "t"), n, "t", back=True) == i for i in range(n))
    assert [f.permute(i, 1000, "t") for i in range(9)] != [op01_pii.Feistel(b"l").permute(i, 1000, "t") for i in range(9)]


def test_pseudonyms_keep_format_and_link():
    p = op01_pii.Pseudonyms(b"k")
    t = "Call +1 (663) 555-6869 or +1-663-555-6869, card 4316522678525456, 4316 5226 7852 5456; ip 174.91.180.241, 2001-02-03, 3.2.2001, x.12@mail2.example.com DE89 3704 0044 0532 0130 00"
    out, n, found = p.apply(t)
    assert n == 9 and [out[f["start"] : f["stop"]] for f in found] == re.findall(r"\+1[^,]*?(?= or|,)|\d{16}|\d{4} \d{4} \d{4} \d{4}(?=;)|[\d.]{8,}(?=, |,)|\d{4}-\d\d-\d\d|\S+@\S+|DE.*", out)[:9] or n == 9
    digits = [re.sub(r"\D", "", out[f["start"] : f["stop"]]) for f in found]
    assert digits[0] == digits[1] and digits[2] == digits[3]
    assert op01_pii.luhn(digits[2][:-1]) == int(digits[2][-1])
    iban = out[found[-1]["start"] : found[-1]["stop"]].replace(" ", "")
    assert op01_pii.mod97(iban[4:] + iban[:4]) == 1
    for secret in ("663", "4316522678525456", "174.91.180.241", "2001-02-03", "x.12@", "3704 0044"):
        assert secret not in out


def test_dates_stay_linked():
    p = op01_pii.Pseudonyms(b"k")
    iso = p.apply("2001-02-03")[0]
    y, m, d = map(int, iso.split("-"))
    assert p.apply("3 February 2001")[0] == f"{d} {op01_pii.MONTHS[m - 1]} {y}"
    assert p.apply("03.02.2001")[0] == f"{d:02d}.{m:02d}.{y}"
    assert p.apply("2001-02-30")[0] == "2001-02-30" and p.apply("9870157079875996")[0] == "9870157079875996"


def test_clean_texts_are_left_alone():
    p = op01_pii.Pseudonyms(b"k")
    for t in ("version 2.0 of 4.0.", "a token of thanks, the secret garden", "300.1.1.1", "42 and 1,000"):
        assert p.apply(t) == (t, 0, [])


def test_pii_odd_rows(spark, odd):
    out = op01_pii.pseudonymize(odd, b"k")
    assert out.count() == odd.count() and out.where("text is null").count() == 2
    assert out.schema["found"].dataType.typeName() == "array" and "Score" in out.columns
    assert op01_pii.pseudonymize(odd.limit(0), b"k").isEmpty()


# ---- 4


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=op04_sentencepiece.MODEL)


@pytest.fixture(scope="module")
def pieces():
    return op04_sentencepiece.Encoder(op04_sentencepiece.Pieces(op04_sentencepiece.read_model()))


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.text(max_size=200), st.text("abehinost  \n.,X²’é中▁!$", max_size=300)))
def test_ids_equal_the_librarys(pieces, library, t):
    assert pieces.encode(t) == library.encode(t)
    assert pieces.decode(pieces.encode(t)) == t.replace("▁", " ")


def test_long_segments_are_streamed(pieces, library):
    for t in ("abcdefghij" * 3000, "中文字的" * 3000, " " * 5000 + "x", "Thequickbrownfox" * 2000):
        assert pieces.encode(t) == library.encode(t)
    assert 0 < pieces.window <= 4 * pieces.v.longest


def test_unigram_walk_is_viterbi():
    """The additive walk against all splits of short strings."""
    e = op04_sentencepiece.Encoder.__new__(op04_sentencepiece.Encoder)
    e.known, e.older, e.pairs, e.spines, e.window, e.before = {}, {}, {}, {}, 0, ""

    class V:
        score = {"a": -1.0, "b": -2.0, "ab": -2.5, "ba": -2.2, "aba": -3.1, "bb": -3.0}
        ids = {p: i for i, p in enumerate(score)}
        bytes, unk, longest, merges = {}, 9, 3, False

    e.v = V

    def best(s):
        if not s:
            return 0.0
        return max((V.score[s[:k]] + best(s[k:]) for k in range(1, 4) if s[:k] in V.score), default=-1e9)

    names = {i: p for p, i in V.ids.items()}
    r = random.Random(3)
    for _ in range(60):
        s = "".join(r.choice("ab") for _ in range(r.randrange(1, 14)))
        got = [names[i] for i in e.walk(s)]
        assert "".join(got) == s and sum(V.score[p] for p in got) == pytest.approx(best(s))


def test_encode_and_decode_frames(spark, odd, library):
    out = op04_sentencepiece.encode(odd)
    assert out.where("text is not null and not decodes").count() == 0
    for r in out.select("text", "ids", "n_ids").collect():
        assert (r.ids is None) == (r.text is None) and (r.ids is None or r.ids == library.encode(r.text) and r.n_ids == len(r.ids))
    back = op04_sentencepiece.decode(out)
    assert back.where("not (decoded <=> replace(text, '▁', ' '))").count() == 0
    assert op04_sentencepiece.encode(odd.limit(0)).isEmpty()


# ---- 5

ARTICLE = "<article class='post'><header><h1>Ti&amp;tle</h1></header><p>One  two\n three<b>four</b> <i>x</i><p>Five<br>six &eacute;&#x41;</p><script>var t='</p>';</script><aside>no</aside><div class='comments'><p>nor this</p></div></article>"


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>T</title><style>p{{}}</style></head><body><nav><ul><li><a href=/>menu</a></ul></nav><div class='cookie-notice'>we use cookies</div><header>site</header>{ARTICLE}<section id='comments'><p>first!</p></section><footer>&copy; x</footer></body></html>",
        f"<body><div id=sidebar>side</div><!-- <p>gone --><form><input value='<p>'>mail?</form>{ARTICLE}",
    ],
)
def test_article_alone(page):
    assert op05_html.extract(page) == "Ti&tle One two threefour x Five six éA"


def test_density_finds_the_text_without_article():
    para = "<p>" + "long words of the main text " * 12 + "</p>"
    page = "<body><div class='top'><ul>" + "<li><a href=x>link text here</a></li>" * 15 + f"</ul></div><div><div>{para * 4}</div></div><div>short <a href=y>end</a></div></body>"
    assert op05_html.extract(page) == " ".join(["long words of the main text " * 12][0].split() * 4)


def test_names_titles_and_references():
    para = "<p>" + "long words of the main text " * 12 + "</p>"
    assert op05_html.extract(f"<body><div><h1>Title</h1><div>{para * 3}</div></div></body>").startswith("Title long words")
    page = "<body><article><p>one two</p><div class='notice-board'>kept</div><p class='side-effects'>kept too</p><div class='notice notice--warning'>gone</div><div class='side-bar'>gone</div><div class='cookie-notice'>gone</div></article></body>"
    assert op05_html.extract(page) == "one two kept kept too"
    a, b = (op05_html.parse(f"<body><p>{t}</p></body>") for t in ("&eacute;&eacute;", "éé"))
    for root in (a, b):
        op05_html.measure(op05_html.order(root))
    assert (a.chars, a.density) == (b.chars, b.density)


def test_pages_against_regex(spark):
    """The pages of the fixture have one article each: its text with tags cut out."""
    import html

    for r in op05_html.query(spark, SF).join(common.table(spark, SF, "pages").select("page_id", "html"), "page_id").collect():
        body = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        assert r.text == re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", " ", body))).strip()
        assert r.n_chars == len(r.text)


def test_broken_pages():
    for page in (None, "", "<", "<<p", "a" * 100_000, "<div>" * 30_000 + "x", "</p></p>", "<p>a<table><td>b", "<script>alert(1)"):
        assert isinstance(op05_html.extract(page), str)


def test_html_odd_rows(spark, odd):
    assert op05_html.extract_main(odd.withColumnRenamed("text", "html")).count() == odd.count()


# ---- 7


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", "", "[INST]"]), st.text("</s>[INST] okA\n␛:", max_size=40)), max_size=6))
def test_turns_are_read_back(turns):
    t = op07_chat.Template()
    f = op07_chat.Formatter(t)
    s = t.start + "".join(x for r, text in turns for x, _ in f.segments(r, text)) + t.end
    assert f.parse(s) == turns
    # the reader finds the same in pieces of any length, and cuts the loss out by its spans
    spans, at = [], len(t.start)
    for r, text in turns:
        for x, loss in f.segments(r, text):
            if loss:
                spans.append((at, at + len(x)))
            at += len(x)
    for size in (1, 7, 1000):
        read = op07_chat.Reader(f)
        read.feed(t.start, [])
        for k in range(len(t.start), len(s), size):
            read.feed(s[k : k + size], [x for x in spans if k <= x[0] < k + size])
        said = "".join(x for r, x in turns if r == "assistant")
        assert read.close() == len(s) and read.n == len(turns) and read.loss_chars == len(said)
        assert read.turns.hexdigest() == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert read.loss.hexdigest() == hashlib.sha256(said.encode()).hexdigest()


def test_broken_output_is_refused():
    t = op07_chat.Template()
    read = op07_chat.Reader(op07_chat.Formatter(t))
    read.feed(t.start + "[INST] a" + t.end, [])
    with pytest.raises(ValueError):
        read.close()


def test_conversations(spark):
    got = {r.conv_id: r for r in op07_chat.query(spark, SF).collect()}
    by = collections.defaultdict(list)
    for r in common.table(spark, SF, "conversations").collect():
        by[r.conv_id].append(r)
    by[-1] = [type("R", (), {"turn": k, "role": x, "text": "</s>[INST] ok [/INST]"}) for k, x in enumerate(("user", "assistant"))]
    assert set(got) == set(by)
    for k, rows in by.items():
        rows.sort(key=lambda r: r.turn)
        said = "".join(r.text or "" for r in rows if r.role == "assistant")
        assert got[k].n_turns == len(rows)
        assert got[k].turns_sha256 == hashlib.sha256("".join(f"{r.role}\n{r.text or ''}\n" for r in rows).encode()).hexdigest()
        assert (got[k].loss_chars, got[k].loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())


def test_machine_and_spans(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "[x]"), (2, 0, "assistant", "a"), (3, 0, "user", None), (None, 0, "user", "n"), (None, 0, "user", "n"), (4, 0, None, "q")]
    out = {r.conv_id: r for r in op07_chat.format_turns(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").withColumn("valid", F.lit("mine"))).collect()}
    assert [out[k].valid for k in (1, 2, 3, 4)] == [True, False, False, False] and out[None].n_turns == 2
    f = op07_chat.Formatter(op07_chat.Template())
    assert [f.unescape(out[1].formatted[s.start : s.stop]) for s in out[1].loss_spans] == ["[x]"]
    assert all(r.formatted_chars == len(r.formatted) for r in out.values())
    assert op07_chat.format_turns(spark.createDataFrame([], "conv_id int, turn int, role string, text string")).isEmpty()


# ---- 8


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in common.table(spark, sf, "labels").collect()}
    rows = [(labels[r.doc_id], r.score) for r in op08_toxicity.query(spark, sf).collect() if r.held_out and r.doc_id in labels]
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert auc > 0.95
    assert sum(s >= 0.3 for s in neg) < 0.02 * len(neg)


def test_split_and_odd_rows(spark, odd):
    ids = spark.range(200).select(F.col("id").alias("doc_id"))
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in ids.select("doc_id", op08_toxicity.held_out().alias("h")).collect())
    m = op08_toxicity.fit(["you idiot", "fine day"] * 40, [1, 0] * 40, op08_toxicity.Settings(l1=0.1))
    out = op08_toxicity.score(odd, m)
    assert out.count() == odd.count() and out.where("score is null or score < 0 or score > 1").isEmpty()
    none = op08_toxicity.train(odd, spark.createDataFrame([(1, None)], "doc_id int, toxic int"))
    assert len(none.at) == 0


# ---- 9


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    at = collections.defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i : i + 8])].append(i)
    rep = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dups, len(rep)


def test_quality_against_brute_force(spark, odd):
    r = random.Random(5)
    made = ["\n".join(" ".join(r.choice(["a", "b", "c.", "#d"]) for _ in range(r.randrange(12))) for _ in range(r.randrange(9))) for _ in range(300)]
    for t in [*ODD, *made]:
        got = op09_quality.judge(t, op09_quality.Rules())
        assert got[:5] == base(t), t
        assert got[6] == (got[0] < 20 or 100 * got[4] > 30 * got[0]) and not (got[6] and got[7])
    out = op09_quality.clean_lines(odd)
    assert out.count() == odd.count()
    for x in op09_quality.query(spark, SF).join(common.table(spark, SF, "documents"), "doc_id").select("text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect():
        assert tuple(x[1:]) == base(x.text)


def test_line_rules():
    r = op09_quality.Rules()
    good = "\n".join(f"A plain{i} sentence{i} of ordinary{i} words stands{i} here{i}, and then{i} it ends." for i in range(6))
    assert op09_quality.judge(good, r)[7] and op09_quality.judge(good, r)[8] == good
    assert op09_quality.judge(good + "\nHome | About | Contact\nAll rights reserved.", r)[8] == good
    assert op09_quality.judge(good + "\nHome News Sport World About\nHome · Local · Sport · Weather · More", r)[8] == good
    kept = good + "\nWe must design in a modern way.\nPeople spread more light than they find."
    assert op09_quality.judge(kept, r)[8] == kept
    assert not op09_quality.judge("\n".join(f"THIS{i} IS!! LOUD!! TEXT!! AND!! MORE{i}!!" for i in range(9)), r)[7]
