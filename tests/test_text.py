import html
import itertools
import random
import re
import string
import time

import pytest
from pyspark.sql import functions as F

from mailsieve.functions import features, text
from mailsieve.functions.entities import decode_entities
from mailsieve.functions.patterns import SHORT_STOPWORDS, WHITESPACE


def column(spark, values, step):
    frame = spark.createDataFrame(list(enumerate(values)), "i int, x string")
    rows = frame.select("i", step(F.col("x")).alias("y")).orderBy("i").collect()
    return [row["y"] for row in rows]


def cleaned(spark, values, **options):
    frame = spark.createDataFrame(list(enumerate(values)), "i int, text string")
    rows = text.with_clean_text(frame, **options).orderBy("i").collect()
    return [row["clean_text"] for row in rows]


def tag_end(value, start, name=""):
    """Index after a tag that starts at ``start``, or -1."""
    if value[start] != "<" or not value[start + 1 :].lower().startswith(name):
        return -1
    close = value.find(">", start + 1 + len(name))
    return -1 if close < 0 or (not name and close == start + 1) else close + 1


def skip_blocks(value, name):
    """Blank for every block of that name, by walking over the characters."""
    # Lower case letter by letter: some characters grow when whole texts are lowered.
    out, i, low = [], 0, "".join(c.lower() if c.isascii() else c for c in value)
    while i < len(value):
        body = tag_end(value, i, name)
        end = low.find(f"</{name}>", body) if body >= 0 else -1
        if end >= 0:
            out.append(" ")
            i = end + len(name) + 3
        else:
            out.append(value[i])
            i += 1
    return "".join(out)


def walked_clean(value):
    """The cleaner as a walk over characters and words."""
    for name in ("script", "style"):
        value = skip_blocks(value, name)
    out, i = [], 0
    while i < len(value):
        end = tag_end(value, i)
        out.append(" " if end >= 0 else value[i])
        i = end if end >= 0 else i + 1
    value = html.unescape("".join(out))
    value = walk_urls(value)
    value = walk_addresses(value)
    value = "".join(" numbertoken " if c == "0" else c for c in squeeze_digits(value))
    letters = "".join(c if "a" <= c <= "z" else " " for c in value.lower())
    return " ".join(word for word in letters.split(" ") if word and word not in SHORT_STOPWORDS)


def squeeze_digits(value):
    """Every run of decimal digits as one 0."""
    runs = itertools.groupby(value, str.isdecimal)
    return "".join("0" if digits else "".join(run) for digits, run in runs)


def walk_urls(value):
    """An address runs from its mark to the next blank; a mark alone is not one."""
    out, i = [], 0
    while i < len(value):
        mark = next((m for m in ("http://", "https://", "www.") if value[i : i + len(m)].lower() == m), None)
        end = i + len(mark) if mark else i
        while mark and end < len(value) and value[end] not in WHITESPACE:
            end += 1
        if mark and end > i + len(mark):
            out.append(" urltoken ")
            i = end
        else:
            out.append(value[i])
            i += 1
    return "".join(out)


def walk_addresses(value):
    """name@host.end, with the longest host whose last part is two letters or more."""
    name_chars = set(string.ascii_letters + string.digits + "._%+-")
    host_chars = set(string.ascii_letters + string.digits + ".-")
    out, i = [], 0
    while i < len(value):
        at = i
        while at < len(value) and value[at] in name_chars:
            at += 1
        found = -1
        if at > i and value[at : at + 1] == "@":
            stop = at + 1
            while stop < len(value) and value[stop] in host_chars:
                stop += 1
            for dot in range(stop - 1, at + 1, -1):
                end = dot + 1
                while end < stop and value[end] in string.ascii_letters:
                    end += 1
                if value[dot] == "." and end - dot > 2:
                    found = end
                    break
        if found >= 0:
            out.append(" emailtoken ")
            i = found
        else:
            out.append(value[i : max(at, i + 1)])
            i = max(at, i + 1)
    return "".join(out)


PAGE = "<div class=x>Offer ends <b>TODAY</b>: call 555 0199, mail sales@shop.example or see www.shop.example/a</div>"


def test_known_messages(spark):
    cases = {
        PAGE: "offer ends today call numbertoken numbertoken mail emailtoken see urltoken",
        "See you at 8, bring 2 chairs.": "see numbertoken bring numbertoken chairs",
        "Photos: https://pics.example/album?id=7": "photos urltoken",
        "50% OFF, write to a.b@c.example!!!": "numbertoken off write emailtoken",
        "The AND of": "",
        None: "",
    }
    assert cleaned(spark, list(cases)) == list(cases.values())


def test_stop_words_can_stay(spark):
    assert cleaned(spark, ["The cat & the dog"], remove_common_words=False) == ["the cat the dog"]
    assert cleaned(spark, ["The cat sat"], stopwords=["cat"]) == ["the sat"]


def test_random_texts_match_a_walk_over_characters(spark):
    random.seed(7)
    parts = [
        "<p>", "</p>", "<", ">", "<>", "<script>", "<SCRIPT a='>'>", "</script>", "<style x>",
        "</Style>", "&amp;", "&lt;", "&amp;lt;", "&eacute;", "&#233;", "&#xE9;", "&notit;", "&copy",
        "&#0;", "&#128;", "&#x110000;", "&#55296;", "&bogus;", "&", "http://a.b/c?d=1", "WWW.x.y",
        "https://é", "a@b.co", "x.y+z@sub.dom.org_q@r.st", "@", "12", "٣٤", "Ünïcode", "İ", "ß", "the",
        "And", " ", "\n", "\t", "\xa0", " ", "　", "\x1c", "\x85", "free", "$!", "😀", "K",
    ]
    texts = ["".join(random.choices(parts, k=random.randint(0, 25))) for _ in range(600)]
    assert cleaned(spark, texts) == [walked_clean(t) for t in texts]


def test_character_references(spark):
    values = [
        "&lt;b&gt; &quot;x&quot; &#39;y&#39; &nbsp;|", "&amp;lt;", "&amp;amp;", "&ampamp;", "&eacute;&Eacute",
        "&notin;&notit;&not", "&#8217;&#x2019;&#X2019", "&#128;&#129;&#150;&#159;", "&#0;&#13;&#1;&#11;",
        "&#xD800;&#x110000;&#99999999999999999999;", "&#xFFFE;&#64976;&#x1FFFF;", "&#;&#x;&;&&", "&CounterClockwiseContourIntegral;",
        "&lt&gt&amp&quot", "&#65&#66;", "no reference", "a & b", "&acE;&bne;", "&#000065;", "&#x0000000000041;",
    ]
    assert column(spark, values, decode_entities) == [html.unescape(v) for v in values]


def test_tags_and_blocks(spark):
    values = ["a<b>c", "a<>b", "a < b", "x<y<z>w", "<script>var t='</p>';</script>ok", "<STYLE>p{}\n</style >no", "1 > 0"]
    expected = [re.sub(r"<[^>]+>", " ", v) for v in values]
    assert column(spark, values, text.without_tags) == expected
    blocks = [re.sub(r"(?is)<script[^>]*>.*?</script>", " ", v) for v in values]
    blocks = [re.sub(r"(?is)<style[^>]*>.*?</style>", " ", v) for v in blocks]
    assert column(spark, values, text.without_blocks) == blocks


@pytest.mark.parametrize(
    "value", ["<" * 200_000, "a>" + "<" * 200_000, "x" * 300_000 + "@", "&" * 100_000, " " * 300_000 + "x"]
)
def test_long_degenerate_texts_finish(spark, value):
    start = time.time()
    cleaned(spark, [value])
    assert time.time() - start < 20


def test_strip_covers_all_white_space(spark):
    assert column(spark, [WHITESPACE + "a b" + WHITESPACE, WHITESPACE, None], text.strip) == ["a b", "", ""]


def test_stop_words_on_any_text(spark):
    words = text.stopword_list("short", extra=["Cat"])
    values = ["the\tCat sat on a cat mat ", "", None]
    result = column(spark, values, lambda c: text.without_stopwords(c, words))
    assert result == ["Cat sat mat", "", ""]
    assert len(text.stopword_list("short")) == 29
    assert "because" in text.stopword_list("english")
    assert "und" in text.stopword_list("german") and "avec" in text.stopword_list("french")
    german = text.stopword_list("german")
    assert column(spark, ["Haus und Hof"], lambda c: text.without_stopwords(c, german)) == ["Haus Hof"]
    with pytest.raises(ValueError):
        text.stopword_list("klingon")


def test_cleaner_is_idempotent_on_its_output(spark):
    once = cleaned(spark, [PAGE, "Plain words, twice over."])
    assert cleaned(spark, once) == once


def test_preview(spark):
    assert column(spark, ["abcdef", "é" * 90], lambda c: text.preview(c, 3)) == ["abc", "ééé"]


def test_manual_features(spark):
    values = ["Hi! $5 www.a.b HTTP://x https://y", "", "ÉÀ Ⅷ ⓐⒶ é", None, "😀!!"]
    frame = spark.createDataFrame(list(enumerate(values)), "i int, text string")
    rows = features.with_manual_features(frame).orderBy("i").collect()
    for row in rows:
        value = row["text"] or ""
        assert row["length"] == len(value)
        assert row["url_count"] == len(re.findall(r"https?://|www\.", value))
        assert row["exclamation_count"] == value.count("!")
        assert row["dollar_count"] == value.count("$")
        upper = sum(c.isupper() for c in value)
        assert row["uppercase_ratio"] == pytest.approx(upper / (len(value) + 1))
