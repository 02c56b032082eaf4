"""Column expressions against the Python meaning of the same steps."""

import html
import random
import re

import pytest
from pyspark.sql import functions as F

from opinionlens import constants as K
from opinionlens.functions import text as tx
from opinionlens.functions import values as v

EMOJI = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in K.EMOJI_RANGES) + "]+")

SAMPLES = [
    "", " ", "plain", "a #été_1 #️⃣ #x#y http://q#frag", "awwww", "awww", "see www.x.org now", "wwwhttp://x",
    "HTTP://UP https://a.b/c?d=e f", "a  b", " x　y\x1c", "tab\there\nline\r\nend ",
    "smile 😀😀 ❤️ 🇮🇹 ⭐", "Été naïve × ÷ ß", "#1 #_ #a-b ##c # d", "http", "http s", "x http://",
]


def _random_texts(n=400):
    rng = random.Random(11)
    bits = ["http", "www", "#", "ab", "é", " ", "  ", "\n", " ", " ", "😀", "❤", "️", "_", "7", ".", "-", "ß", "中", "w", "h"]
    return ["".join(rng.choices(bits, k=rng.randint(0, 14))) for _ in range(n)]


def _apply(spark, texts, *functions):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", *[f("t").alias(f"f{k}") for k, f in enumerate(functions)]).orderBy("i").collect()
    return [tuple(r)[1:] for r in rows]


def _spaces(t):
    return re.sub(r"\s+", " ", t).strip()


def test_patterns_follow_python(spark):
    texts = SAMPLES + _random_texts()
    got = _apply(
        spark, texts, tx.strip_emojis, tx.strip_urls, tx.normalize_spaces, tx.extract_tags, tx.delete_tags, tx.keep_latin
    )
    for text, row in zip(texts, got):
        assert row[0] == EMOJI.sub("", text)
        assert row[1] == re.sub(r"http\S+|https\S+|www\S+", "", text)
        assert row[2] == _spaces(text)
        assert row[3] == re.findall(r"#\w+", text)
        assert row[4] == re.sub(r"#\w+", "", text)
        assert row[5] == re.sub(r"[^A-Za-z0-9À-ÖØ-öø-ÿ\s]", "", text)


def test_named_edge_cases(spark):
    (tags,), = _apply(spark, ["a #été_1 #️⃣ #x#y http://q#frag"], tx.extract_tags)
    assert tags == ["#été_1", "#x", "#y", "#frag"]
    assert _apply(spark, ["awwww", "awww"], tx.strip_urls) == [("a",), ("awww",)]
    assert _apply(spark, ["\U0001f600❤\U0001f1fa️⭐"], tx.strip_emojis) == [("️⭐",)]


def test_clean_fields(spark):
    texts = ["  Hi &amp; bye  😀 www.a.b", None, "Jo_é (x)  y!"]
    got = _apply(spark, texts, tx.clean_text, tx.clean_description, tx.clean_username)
    assert got == [
        ("Hi & bye", "Hi  bye", "Hi bye"),
        ("", "", ""),
        ("Jo_é (x) y!", "Joé x y", "Joé x y"),
    ]


@pytest.mark.parametrize(
    "damaged, repaired",
    [
        ("plain text", "plain text"),
        ("a &amp; b &lt;c&gt; &quot;d&quot; &#39;e&#39;", "a & b <c> \"d\" 'e'"),
        ("a &amp;amp;lt; b", "a < b"),
        ("<b>x &amp; y</b>", "<b>x &amp; y</b>"),
        ("cafÃ© Ã\x89tÃ© Ã‰tÃ©", "café Été Été"),
        ("itâ€™s â€œsoâ€\x9d Â£5 â„¢", "it's \"so\" £5 ™"),
        ("ðŸ˜€!", "😀!"),
        ("â lone Ã lead", "â lone Ã lead"),
        ("“a” ‘b’ \x93c\x94", "\"a\" 'b' \"c\""),
        ("ﬁne ＦＵＬＬ　５", "fine FULL 5"),
        ("a\r\nb\rc d", "a\nb\nc\nd"),
        ("bell\x07 nul\x00 bom﻿", "bell nul bom"),
    ],
)
def test_repair(spark, damaged, repaired):
    assert _apply(spark, [damaged], tx.repair_text) == [(repaired,)]


def test_repair_undoes_every_accented_letter(spark):
    letters = [chr(c) for c in range(0xC0, 0x100)]
    as_latin = [f"x{c.encode().decode('latin-1')}y" for c in letters]
    readable = [c for c in letters if c.encode()[1] not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
    as_cp1252 = [f"x{c.encode().decode('cp1252')}y" for c in readable]
    assert _apply(spark, as_latin + as_cp1252, tx.repair_text) == [(f"x{c}y",) for c in letters + readable]


def test_repair_is_stable(spark):
    texts = SAMPLES + _random_texts(100) + [html.escape(t) for t in SAMPLES]
    once = [r[0] for r in _apply(spark, texts, tx.repair_text)]
    assert [r[0] for r in _apply(spark, once, tx.repair_text)] == once


def test_keyword_mentions(spark):
    texts = ["#trump2024 x", "trumpism", "antitrump", "trump_2024", "Trump!", "a trump", "étrump", "trump️", "TRUMP 2024"]
    got = [r[0] for r in _apply(spark, texts, lambda c: tx.mentions(c, K.KEYWORDS_A))]
    assert got == [True, False, False, False, True, True, False, True, True]
    with pytest.raises(ValueError):
        tx.keyword_pattern([])


def test_keywords_are_literal(spark):
    got = [r[0] for r in _apply(spark, ["c++ x", "cxx", "a.b", "axb"], lambda c: tx.mentions(c, ["c++", "a.b"]))]
    assert got == [True, False, True, False]


def test_values(spark):
    df = spark.createDataFrame(
        [("1",), ("1.0",), ("0",), ("0.0",), ("",), ("N",), (None,), ("nan",), ("2",)], "x string"
    )
    assert [r[0] for r in df.select(v.label_value("x")).collect()] == [1, 1, 0, 0, None, None, None, None, 2]
    df = spark.createDataFrame([("2024-09-01",), ("2024-09-01 12:30:00",), ("10/01/2024",), ("",), (None,)], "x string")
    assert [str(r[0]) for r in df.select(v.date_value("x")).collect()] == ["2024-09-01"] * 2 + ["None"] * 3
    df = spark.createDataFrame([("  ",), (None,), (" Reno ",), ("",)], "x string")
    assert [r[0] for r in df.select(v.place_or_unknown("x")).collect()] == ["Unknown", "Unknown", "Reno", "Unknown"]
    one = spark.range(1)
    got = one.select(
        v.safe_divide(F.lit(1), F.lit(0)), v.safe_divide(F.lit(1), F.lit(4)), v.format_thousands(F.lit(1234567)),
        v.format_thousands(F.lit(12)), v.area(F.lit("a"), F.lit("b")), v.area(F.lit(None).cast("string"), F.lit("b")),
        v.lookup(F.lit("Nevada"), K.STATE_CODES), v.lookup(F.lit("Ohio"), K.STATE_CODES),
        v.state_from_name(F.lit("NORTH_Carolina_tweets.csv")), v.state_from_name(F.lit("ohio.csv")),
    ).first()
    assert tuple(got) == (0.0, 0.25, "1.234.567", "12", "a, b", None, "NV", None, "North Carolina", None)


def test_first_file_key_wins(spark):
    table = {"ab": "first", "a": "second"}
    df = spark.createDataFrame([("xab",), ("xa",)], "n string")
    assert [r[0] for r in df.select(v.state_from_name("n", table)).collect()] == ["first", "second"]


REPAIRS = [
    ("it&#8217;s &eacute;t&eacute;", "it's été"),
    ("&#x27;q&#X27; &amp;rarr; &rarr; &nosuch; &#0; &#xD800; & &;", "'q' → → &nosuch; \ufffd \ufffd & &;"),
    ("&amp;amp; fish", "& fish"),
    ("<b>&eacute;</b>", "<b>&eacute;</b>"),
    ("cafe\u0301 E\u0301te\u0301 \u0438\u0306", "café Été й"),
    ("a\u0302\u0301 \u0301 x\u0301", "ấ \u0301 x\u0301"),
    ("Ð¿Ñ€Ð¸Ð²ÐµÑ‚", "привет"),
    ("Å¡Ä\u008d", "šč"),
    ("caf\u00c3\u00a9 it\u00e2\u20ac\u2122s", "café it's"),
    ("\u00f0\u0178\u02dc\u20ac", "😀"),
    ("ESPAÑ\u201d", 'ESPAÑ"'),
    ("ﬁne \uff21\u3000b\r\nc\x07", "fine A b\nc"),
    (None, None),
    ("", ""),
]


def test_repairs_by_literal_rows(spark):
    df = spark.createDataFrame(REPAIRS, "damaged string, wanted string")
    for r in df.select("*", tx.repair_text("damaged").alias("found")).collect():
        assert r["found"] == r["wanted"], r["damaged"]


def test_tags_after_repair(spark):
    from opinionlens.operators.posts import clean_posts

    text = "it&#8217;s &#x27;so&#x27; #e\u0301te\u0301 &lt;#one&gt;"
    rows = spark.createDataFrame([(text, "u", "d")], "text string, username string, description string")
    assert clean_posts(rows).first()["hashtags"] == "#été;#one"


PATTERNS = [
    r"\bvote\b(\s+blue)?", r"\b[uv]ote\b", r"\bvote blue|kamala2024", r"\bvote\b", r"vote\b", r"\bvote", r"\b(vote|red)\b",
    r"\b(?:vote|red)s?\b", r"(?:\bx|y\b)z?", r"\b\w+ed\b", r"\b#\w+", r"#\w+\b", r"\bé\w*", r"\bn[o0]\b|\byes\b", r"\d+\b", r"\b\d{4}\b",
    r"[-\s]blue", r"\S+@\S+", r"\W{2,}", r"[\w.]+\b!", r"\b!", r"!\b", r"\b", r"\Bote", r"vot\B", r"\b(a|b)?vote", r"(vote)?\b", r"(?:a\b)?!",
    r"^\bvote", r"blue\b$", r"\b.ote\b", r"\b[^v]ote", r"[\d-]+x", r"\bvote(?= blue\b)", r"(?<!\w)blue", r"\b(?:#vote|vote)\b", r"[\[&]a",
]
MIXED = [
    "please vote now", "we xkamala2024 here", "vote  blue", "vote blue!", "voted", "revote", "uote", "note vote", "né éa àvote", "vote_1 x", "2024 votes", "20245",
    "#vote", "a#vote b", "été vote", "no", "n0 yes", "red reds", "yz xz ax", "a! !b", "me@x.org", "x -blue", "tab\tblue", "вote", "vote", "", "!", "a.b!", "1-2x",
    "blue", "say blue", "zvote", "avote bvote", "[a &a", "vote blue", "votó",
]


@pytest.mark.parametrize("pattern", PATTERNS)
def test_patterns_mean_what_they_mean_in_python(spark, pattern):
    from opinionlens.functions.patterns import portable_pattern

    df = spark.createDataFrame([(t,) for t in MIXED], "t string")
    for patterns in ([pattern], [pattern, r"\bquince\b"], [r"\bzebra", pattern]):
        found = {r["t"]: r["hit"] for r in df.select("t", F.col("t").rlike(portable_pattern(patterns)).alias("hit")).collect()}
        assert found == {t: any(re.search(p, t) for p in patterns) for t in MIXED}, portable_pattern(patterns)


def test_stop_words_are_those_of_spark(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert K.ENGLISH_STOPWORDS == StopWordsRemover.loadDefaultStopWords("english")


def test_oracles_need_neither_install_files_nor_a_session():
    import os
    import subprocess
    import sys

    code = (
        "import os.path, glob, zipfile\n"
        "def gone(*a, **k): raise FileNotFoundError('no install files')\n"
        "glob.glob = zipfile.ZipFile = gone\n"
        "import __spark_entry__ as e\n"
        "from pyspark import SparkContext\n"
        "print(len(e.oracle_sql())); assert SparkContext._active_spark_context is None"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout.split()[-1]) >= 63
