"""Text rules against hand-written inputs and plain-Python brute force."""

from __future__ import annotations

import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from tarn.functions import chunks as C
from tarn.functions import text as X
from tarn.functions.language import language_of, translator_code
from tarn.operators import text_clean as TC
from tarn.operators import text_quality as TQ


def apply(spark, rule, inputs):
    rows = [(i, text) for i, text in enumerate(inputs)]
    df = spark.createDataFrame(rows, "i int, text string").select("i", rule(F.col("text")).alias("out"))
    return [row["out"] for row in df.orderBy("i").collect()]


ODD_TEXTS = [
    "",
    "   ",
    "plain text",
    "a\r\nb\rc\n\n\n\nd",
    "　 padded\xa0",
    "tab\tand\x0bvt\x0cff",
    "bell\x07 zero​width ﻿ bom",
    "café café ﬁ ① Ａ",
    "smile \U0001f600✨ é✨ éé",
    "one. two! three? four。 five！  six",
    "x\x1cy\x1dz\x85w v ",
    "a b \x00 c",
    "line one \n  \n\n line\t\t two ",
    "no space.at all?yes",
    "del\x7f é",
]


# What spacing rules leave of ODD_TEXTS, written out by hand.
SPACED = [
    "",
    "",
    "plain text",
    "a\nb\nc\n\nd",
    "padded",
    "tab\tand\x0bvt\x0cff",
    "bell\x07 zero\u200bwidth \ufeff bom",
    ODD_TEXTS[7],
    ODD_TEXTS[8],
    ODD_TEXTS[9],
    ODD_TEXTS[10].strip(),
    "a b \x00 c",
    "line one \n  \n\n line\t\t two",
    "no space.at all?yes",
    ODD_TEXTS[14],
]


def test_strip_and_spacing(spark):
    once = apply(spark, X.normalize_spacing, ODD_TEXTS)
    assert once == SPACED
    assert apply(spark, X.normalize_spacing, once) == once
    assert apply(spark, X.normalize_spacing, [None]) == [""]


def test_line_count_matches_splitlines(spark):
    assert apply(spark, X.line_count, ODD_TEXTS) == [len(t.splitlines()) for t in ODD_TEXTS]


def test_unprintable_count(spark):
    def count(s):
        return sum(not (c.isprintable() or c.isspace()) for c in s)

    assert apply(spark, X.unprintable_count, ODD_TEXTS) == [count(t) for t in ODD_TEXTS]


def test_low_printable_ratio_edge(spark):
    texts = ["a" * 9 + "\x01", "a" * 8 + "\x01\x01", "\t\t\t"]
    docs = spark.createDataFrame(list(enumerate(texts)), "key int, text string")
    rows = TQ.printable_ratio(docs).orderBy("key").collect()
    assert [r["low_printable_ratio"] for r in rows] == [False, True, False]


# What cleaning leaves of ODD_TEXTS, written out by hand.
CLEANED = [
    "",
    "",
    "plain text",
    "a\nb\nc\n\nd",
    "padded",
    "tab andvtff",
    "bell zero width bom",
    "café café fi 1 A",
    "smile \U0001f600✨ é✨ éé",
    "one. two! three? four。 five! six",
    "xyz\x85w v",
    "a b c",
    "line one\n\nline two",
    "no space.at all?yes",
    "del é",
]


def test_basic_clean(spark):
    docs = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "key int, text string")
    got = [r["text"] for r in TC.basic_clean(docs).orderBy("key").collect()]
    assert got == CLEANED


# What the last scrub leaves of ODD_TEXTS, written out by hand.
SCRUBBED = [
    "",
    "   ",
    "plain text",
    "a\r\nb\rc\n\n\n\nd",
    "  padded ",
    "tab\tand vt ff",
    "bell  zero width   bom",
    "caf  caf  fi 1 A",
    "smile       ",
    "one. two! three? four  five!  six",
    "x y z w v ",
    "a b   c",
    "line one \n  \n\n line\t\t two ",
    "no space.at all?yes",
    "del   ",
]


def test_final_scrub(spark):
    got = apply(spark, X.final_scrub, ODD_TEXTS)
    assert got == SCRUBBED
    assert apply(spark, X.final_scrub, got) == got
    assert apply(spark, lambda t: X.final_scrub(t, True), ["é✨\x07"]) == ["é  "]


# The sentences of ODD_TEXTS, written out by hand.
SENTENCES = [
    [],
    [],
    ["plain text"],
    ["a", "b", "c", "d"],
    ["padded"],
    ["tab and vt ff"],
    ["bell\x07 zero\u200bwidth \ufeff bom"],
    [ODD_TEXTS[7]],
    [ODD_TEXTS[8]],
    ["one.", "two!", "three?", "four。", "five！", "six"],
    ["x y z w v"],
    ["a b \x00 c"],
    ["line one", "line two"],
    ["no space.at all?yes"],
    [ODD_TEXTS[14]],
]


def test_split_sentences(spark):
    assert apply(spark, X.split_sentences, ODD_TEXTS) == SENTENCES


def test_chunks_written_out(spark):
    texts = ["", "One two. Three four five six. Seven!", "a b c d e f g h. Short one.", "x. x. x. x."]
    got = apply(spark, lambda t: C.chunk_text(t, 7, 2), texts)
    assert [[(c["text"], c["n_tokens"]) for c in row] for row in got] == [
        [],
        [("One two.", 2), ("Three four five six. Seven!", 5)],
        [("a b c d e", 5), ("d e f g h.", 5), ("Short one.", 2)],
        [("x. x. x. x.", 4)],
    ]


@pytest.mark.parametrize("max_tokens,stride", [(7, 2), (5, 2), (12, 0), (3, 0)])
def test_chunks_are_greedy_and_lose_nothing(spark, max_tokens, stride):
    """Distinct words tell where each token of a chunk comes from."""
    budget, lengths = max_tokens - 2, [2, 4, 1, 31, 3, 3, 1, 1, 1, 14, 1]
    number = iter(range(1000))
    sentences = [[f"w{next(number)}" for _ in range(n)] for n in lengths]
    owner = {w: i for i, words in enumerate(sentences) for w in words}
    text = " ".join(" ".join(words) + "." for words in sentences)
    chunks = [c["text"].replace(".", "").split() for c in apply(spark, lambda t: C.chunk_text(t, max_tokens, stride), [text])[0]]
    assert all(len(c) <= budget for c in chunks)
    assert list(dict.fromkeys(w for c in chunks for w in c)) == [w for words in sentences for w in words]
    for one, other in zip(chunks, chunks[1:], strict=False):
        shared = [w for w in one if w in other]
        inside_long = owner[one[-1]] == owner[other[0]] and len(sentences[owner[other[0]]]) > budget
        assert len(shared) == (stride if inside_long else 0)
        if not inside_long:  # the next sentence would not have fitted, or a long one stands alone
            following = len(sentences[owner[other[0]]])
            assert len(one) + following > budget or len(sentences[owner[one[0]]]) > budget


def test_chunk_budget_must_be_positive():
    with pytest.raises(ValueError):
        C.token_budget(2)


def test_windows_cover_every_token(spark):
    n, budget, stride = 57, 10, 3
    text = " ".join(f"w{i}" for i in range(n))
    rule = lambda t: C.windows(F.split(t, " "), budget, stride, C.Tokenizer())
    parts = [w["text"].split(" ") for w in apply(spark, rule, [text])[0]]
    assert parts[0] + [w for p in parts[1:] for w in p[stride:]] == text.split(" ")
    assert all(a[-stride:] == b[:stride] for a, b in zip(parts, parts[1:], strict=False))


def test_rechunk_keeps_short_paragraphs(spark):
    text = "short one.\n\n" + "Long sentence here. " * 10 + "\n\n  \n\nlast"
    got = apply(spark, lambda t: C.rechunk_paragraphs(t, 20), [text])[0]
    assert got.startswith("short one.\n\nLong sentence here.")
    assert got.endswith("\n\nlast")
    assert all(len(p.split()) <= 18 for p in got.split("\n\n"))


def test_language_and_routing(spark):
    texts = ["the cat and the dog", "der Hund und die Katze", "le chat et les chiens", "el perro y los gatos", "xyz", ""]
    assert apply(spark, language_of, texts) == ["en", "de", "fr", "es", "unknown", "unknown"]
    codes = ["zh-CN", "ZH_cn", "zh", "pt", "en"]
    assert apply(spark, translator_code, codes) == ["zh-CN", "zh-CN", "zh-CN", "pt", "en"]


def test_markdown_images(spark):
    cases = {
        "a ![[x.png]] b": "a  b",
        "a <IMG\nsrc='x'> b": "a  b",
        'a ![alt](http://x "t") b': "a  b",
        "a ![alt](http://x 't') b": "a  b",
        "a ![alt][id] b": "a  b",
        'a\n [id]: <http://x> "t"\nb': "a\n\nb",
        "a\n[id]: http://x\nb": "a\n\nb",
        "a\n\n[id]: <data:image/png;base64,AA BB\nCC>\nrest": "a",
        "[link](http://x) stays": "[link](http://x) stays",
    }
    got = apply(spark, X.markdown_strip_images, list(cases))
    assert [re.sub(r"\n+", "\n", g) for g in got] == [re.sub(r"\n+", "\n", w) for w in cases.values()]


def test_rtf(spark):
    got = apply(spark, X.rtf_strip, ["{\\rtf1\\ansi{\\fonttbl\\f0 Swiss;}\\f0\\fs24 One\\par Two\\pard Three}"])
    assert [re.sub(r" +", " ", p).strip() for p in got[0].split("\n\n")] == ["One", "Two", "Three"]


def test_html(spark):
    cases = {
        "<p>a</p><p>b</p>": "a\nb",
        "<p><b>a</b></p>\n<p>c</p>": "a\n\nc",
        "x<script>var t='</p>';</script>y<!-- no -->z": "x\ny\nz",
        "<style>p{}</style>a &amp; b &lt;c&gt; &amp;lt;": "a & b <c> &lt;",
        "1 < 2 &eacute; &#65;&#x42; &hellip;": "1 < 2 é AB …",
        "<!DOCTYPE html>&nbsp;t&nbsp;": "t",
        "<i>" * 20000 + "deep": "deep",
    }
    assert apply(spark, X.html_to_text, list(cases)) == list(cases.values())


def test_profile_of_empty_body(spark):
    docs = spark.createDataFrame([("a", ""), ("b", None), ("c", " \n "), ("d", "A sentence that is long enough.\n\nxy")], "key string, text string")
    rows = {r["key"]: r for r in TQ.text_profile(docs).collect()}
    assert rows["a"]["empty"] and rows["a"]["size_bytes"] is None and rows["a"]["origin_language"] is None
    assert rows["b"]["empty"] and rows["b"]["lines"] is None
    assert rows["c"]["empty"] and rows["c"]["too_short"] and rows["c"]["lines"] == 2
    assert rows["d"]["paragraph_token_list"] == [31, 2] and rows["d"]["avg_tokens_per_paragraph"] == 16.5
    kept = TQ.drop_low_quality(docs).collect()
    assert [r["key"] for r in kept] == ["d"]
    by_profile = TQ.drop_low_quality(docs, TQ.text_profile(docs)).collect()
    assert [r["key"] for r in by_profile] == ["d"]


def test_clean_text_uses_translations(spark):
    docs = spark.createDataFrame([(1, "der Hund und die Katze ist nicht da"), (2, "the dog and the cat are here")], "key int, text string")
    english = spark.createDataFrame([(1, "the dog and the cat is not here"), (2, "ignored")], "key int, text string")
    got = {r["key"]: (r["language"], r["text"]) for r in TC.clean_text(docs, english).collect()}
    assert got == {1: ("de", "the dog and the cat is not here"), 2: ("en", "the dog and the cat are here")}


def test_python_round(spark):
    df = spark.createDataFrame([(12.125,), (2.675,), (0.285,), (-1.5,)], "x double")
    got = [r[0] for r in df.select(X.python_round(F.col("x"))).collect()]
    assert got == [round(12.125, 2), round(2.675, 2), round(0.285, 2), -1.5]


def test_python_rules_hold_a_part_of_a_batch():
    import pyarrow as pa

    from tarn.functions import unicode as U

    texts = [" a" * 100_000, None, "", " ", None] * 20
    parts = list(U._in_parts(lambda text: text, iter([pa.array(texts, pa.string()), pa.array([], pa.string())])))
    assert [t for part in parts for t in part.to_pylist()] == texts
    # A part is a stretch of bytes, so it may end with one text beyond it.
    assert len(parts) > 4 and max(part.nbytes for part in parts) < 2 * U._PART_BYTES
