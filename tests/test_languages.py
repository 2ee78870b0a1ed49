"""Language by character n-grams: against a plain reading, and on texts left out of the profiles."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tarn.operators import languages as LA
from tarn.operators import text_quality as TQ

SF = "/root/testdata/sf0.01"
KNOWN = [
    ("en", "The cat sat on the mat, and the dog with it."),
    ("en", "The end of that thing"),
    ("de", "Der Hund und die Katze; nicht für mich, sich selbst!"),
    ("fr", "Le chat est là, où l'été s'en va. A"),
    (None, "zzz zzz"),
    ("en", None),
    ("xx", "12 34 ..."),
]


def cut(text):
    return [w[i : i + 3] for w in ("_" + w.lower() + "_" for w in re.findall(r"[^\W\d_]+", text)) for i in range(len(w) - 2)]


def learned(rows, size):
    counts = defaultdict(Counter)
    for language, text in rows:
        if language and text:
            counts[language].update(cut(text))
    return {
        (code, gram): weight
        for code, grams in counts.items()
        for gram, n in sorted(grams.items(), key=lambda p: (-p[1], p[0]))[:size]
        if (weight := math.floor(math.log(n / sum(grams.values()) / LA.FLOOR) * 1000)) > 0
    }


def plain(text, profiles):
    grams = cut(text or "")
    scores = Counter()
    for (code, gram), weight in profiles.items():
        if n := grams.count(gram):
            scores[code] += n * weight
    if not scores:
        return "unknown", len(grams), None, None
    (code, score), *rest = sorted(scores.items(), key=lambda p: (-p[1], p[0]))
    lead = score - (rest[0][1] if rest else 0)
    return code if lead >= LA.MARGIN * len(grams) else "unknown", len(grams), score, lead


ASKED = ["the dog", "die Katze", "l'été", "", None, "...", "日本語", "a", "the die le", "THE " * 20_000, "nicht " + "x" * 3000, "zzz"]


@pytest.mark.parametrize("size", [LA.PROFILE, 5])
def test_scores_equal_a_plain_reading(spark, size):
    known = spark.createDataFrame(KNOWN, "lang string, text string").withColumn("language", F.lit("clash"))
    made = LA.language_profiles(known.drop("language"), size=size)
    profiles = learned(KNOWN, size)
    assert {(r["language"], r["gram"]): r["weight"] for r in made.collect()} == profiles
    docs = spark.createDataFrame(list(enumerate(ASKED)), "key int, text string").withColumn("gram", F.lit("clash"))
    got = {r["key"]: (r["language"], r["n_grams"], r["score"], r["lead"]) for r in LA.language_by_grams(docs, made).collect()}
    assert got == {i: plain(text, profiles) for i, text in enumerate(ASKED)}


def test_nothing_known_and_nothing_asked(spark):
    known = spark.createDataFrame(KNOWN, "lang string, text string")
    docs = spark.createDataFrame([(1, "the dog")], "key int, text string")
    none = LA.language_profiles(known.limit(0))
    assert none.count() == 0
    assert [tuple(r) for r in LA.language_by_grams(docs, none).collect()] == [(1, "unknown", 6, None, None)]
    assert LA.language_by_grams(docs.limit(0), LA.language_profiles(known)).count() == 0


@pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")
def test_held_out_accuracy_is_above_the_marker_vote(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id").alias("key"), "lang", "text")
    held = docs.filter("key % 3 = 0")
    made = LA.language_profiles(docs.filter("key % 3 <> 0"))
    both = (
        held.select("key", "lang")
        .join(LA.language_by_grams(held, made), "key")
        .join(TQ.language_vote(held).withColumnRenamed("language", "vote"), "key")
    ).toPandas()
    grams, vote = (both["lang"] == both["language"]).mean(), (both["lang"] == both["vote"]).mean()
    assert len(both) == held.count() and grams >= 0.98 and grams > vote
    wrong = both[(both["lang"] != both["language"]) & (both["language"] != "unknown")]
    assert len(wrong) <= 0.01 * len(both)


def test_long_texts_are_scored_in_parts_and_grams_are_no_rows(spark):
    rows = learned(KNOWN, 50)
    profiles = spark.createDataFrame([(c, g, w) for (c, g), w in rows.items()], "language string, gram string, weight long")
    words = ["the", "die", "für", "\U0001d4d0the", "zzz"]
    texts = [" ".join(words[i % 5] for i in range(70_000)), "the dog", None, " ".join(words[i % 3] for i in range(70_000))]
    docs = spark.createDataFrame(list(enumerate(texts)), "key long, text string")
    found = LA.language_by_grams(docs.coalesce(1), profiles)
    got = {r["key"]: (r["language"], r["n_grams"], r["score"], r["lead"]) for r in found.collect()}
    assert got == {key: plain(text, rows) for key, text in enumerate(texts)}
    assert "substring(" not in found._jdf.queryExecution().optimizedPlan().toString()
