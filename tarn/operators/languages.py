"""Language by character n-grams: profiles learned from texts of known language, scored in one pass."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tarn.functions.language import UNKNOWN

GRAM = 3
# Grams kept for each language. Profiles are sent to every task: languages times this many short rows.
PROFILE = 2_000
# Words looked up at once.
_WORDS_AT_ONCE = 1 << 16
# The share that any gram counts as, at least, in every language; and the least lead, in thousandths of a nat a gram.
FLOOR = 1e-6
MARGIN = 50


_NO_LETTERS = r"[^\p{L}]+"


def words_of(text: Column) -> Column:
    """Words of letters in lower case, and an empty one at an end without letters. Long texts cost no more a letter."""
    return F.split(F.lower(text), _NO_LETTERS)


def gram_count(text: Column) -> Column:
    """Grams of all words: with its marks, a word of n letters has ``n + 3 - GRAM``."""
    letters = F.length(F.regexp_replace(F.lower(text), _NO_LETTERS, ""))
    marks = F.lit(0) if GRAM == 3 else (3 - GRAM) * F.size(F.array_remove(words_of(text), ""))
    return F.coalesce((letters + marks).cast("long"), F.lit(0).cast("long"))


def language_profiles(docs: DataFrame, language: str = "lang", size: int = PROFILE) -> DataFrame:
    """``(language, gram, weight)`` of the commonest grams of each language, from rows ``(language, text)``.

    The weight is the logarithm of the gram's share of its language over ``FLOOR``, in thousandths, so sums of weights
    are exact. Ties for the last places go to the smaller gram; rows without language or text teach nothing.
    Different words of a part of the rows are cut into grams once, and no language is gathered in one task.
    """
    known = docs.filter(F.col(language).isNotNull()).select(
        F.col(language).cast("string").alias("language"), words_of(F.col("text")).alias("words")
    )
    counted = (
        known.mapInArrow(_count_grams, "language string, gram string, n long")
        .groupBy("language", "gram")
        .agg(F.sum("n").alias("n"))
    )
    totals = counted.groupBy("language").agg(F.sum("n").alias("total"))
    place = F.row_number().over(Window.partitionBy("language").orderBy(F.desc("n"), "gram"))
    kept = counted.withColumn("_place", place).filter(F.col("_place") <= size).drop("_place")
    weight = F.floor(F.log(F.col("n") / F.col("total") / F.lit(FLOOR)) * 1000)
    return (
        kept.join(F.broadcast(totals), "language")
        .select("language", "gram", weight.cast("long").alias("weight"))
        .filter("weight > 0")
    )


def gram_keys(points: np.ndarray) -> np.ndarray:
    """A number for the gram at each code point but the last ones; three code points of 21 bits fit."""
    keys = np.zeros(max(0, len(points) - (GRAM - 1)), dtype=np.int64)
    for place in range(GRAM):
        keys = (keys << 21) | points[place : place + len(keys)]
    return keys


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)


def cut_words(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all grams of ``words``, and the place of the word that each lies in."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    found = gram_keys(_code_points("".join(f"_{word}_" for word in words)))
    marked = lengths + 2
    place = np.arange(len(found)) - np.repeat(np.cumsum(marked) - marked, marked)[: len(found)]
    owner = np.repeat(np.arange(len(words)), marked)[: len(found)]
    inside = (place <= marked[owner] - GRAM) & (lengths[owner] > 0)
    return found[inside], owner[inside]


def _text_of(key: int) -> str:
    return "".join(chr((key >> 21 * place) & 0x1FFFFF) for place in reversed(range(GRAM)))


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(language, gram, n)`` of each part of the rows ``(language, words)``."""
    for batch in batches:
        spoken = batch.column("language").dictionary_encode()
        words = batch.column("words")
        of_rows = spoken.indices.to_numpy()
        languages = np.repeat(of_rows, pc.fill_null(pc.list_value_length(words), 0).to_numpy())
        flat = words.flatten()
        for start in range(0, len(flat), _WORDS_AT_ONCE):
            part = flat.slice(start, _WORDS_AT_ONCE).dictionary_encode()
            places, of_words = part.indices.to_numpy(), languages[start : start + _WORDS_AT_ONCE]
            found, owner = cut_words(part.dictionary.to_pylist())
            grams, which = np.unique(found, return_inverse=True)
            texts = pa.array([_text_of(key) for key in grams.tolist()], pa.string())
            for language in np.unique(of_words):
                times = np.bincount(places[of_words == language], minlength=len(part.dictionary))
                counts = np.bincount(which, weights=times[owner], minlength=len(grams)).astype(np.int64)
                held = np.flatnonzero(counts)
                names = pa.array([spoken.dictionary[int(language)].as_py()] * len(held), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [names, texts.take(pa.array(held)), pa.array(counts[held])], names=["language", "gram", "n"]
                )


def gram_scores(words: Column, weights: dict[str, dict[int, int]], n_languages: int) -> Column:
    """Sums of the weights of all grams of an array of words, by number of the language.

    Of each part of a batch the different words are cut into grams; a word that comes again only adds its sums.
    """
    points = [(int(gram_keys(_code_points(gram))[0]), of_gram) for gram, of_gram in weights.items()]
    points.sort(key=lambda pair: pair[0])
    # A last row of zeros stands for grams that no profile knows.
    keys = np.array([key for key, _ in points] + [np.iinfo(np.int64).max], dtype=np.int64)
    table = np.zeros((len(keys), n_languages))
    for row, (_, of_gram) in enumerate(points):
        for language, weight in of_gram.items():
            table[row, language] = weight

    def scored(different: list[str]) -> np.ndarray:
        found, owner = cut_words(different)
        rows = np.searchsorted(keys, found)
        rows[keys[rows] != found] = len(keys) - 1
        # Sums of whole numbers in doubles, far below 2^53.
        columns = [np.bincount(owner, weights=table[rows, n], minlength=len(different)) for n in range(n_languages)]
        return np.stack(columns, axis=1) if columns else np.zeros((len(different), 0))

    @F.arrow_udf("array<long>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            owners = np.repeat(np.arange(len(batch)), pc.fill_null(pc.list_value_length(batch), 0).to_numpy())
            flat = batch.flatten()
            sums = np.zeros((len(batch), n_languages), dtype=np.int64)
            for start in range(0, len(flat), _WORDS_AT_ONCE):
                part = flat.slice(start, _WORDS_AT_ONCE).dictionary_encode()
                of_words = scored(part.dictionary.to_pylist())
                rows = owners[start : start + _WORDS_AT_ONCE]
                first, places = rows[0], part.indices.to_numpy()
                for language in range(n_languages):
                    found = np.bincount(rows - first, weights=of_words[places, language])
                    sums[first : first + len(found), language] += found.astype(np.int64)
            offsets = np.arange(len(batch) + 1, dtype=np.int32) * n_languages
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(sums.reshape(-1)))

    return run(words)


def language_by_grams(docs: DataFrame, profiles: DataFrame, margin: int = MARGIN) -> DataFrame:
    """``(key, language, n_grams, score, lead)`` of each document ``(key, text)``; keys are unique.

    The language with the greatest sum of weights; equal sums go to the first code. ``unknown`` without letters, without known
    grams, or where the lead over the next language is under ``margin`` a gram. ``score`` and ``lead`` are null without
    known grams; with a single language the lead is its score. Weights are above zero. Profiles, a few thousand short rows
    a language, are read when this is called. Words meet them where the text is read: one row a document and language leaves a task.
    """
    learned = profiles.select("language", "gram", "weight").collect()
    languages = sorted({row["language"] for row in learned})
    number = {language: place for place, language in enumerate(languages)}
    weights: dict[str, dict[int, int]] = {}
    for language, gram, weight in learned:
        of_gram = weights.setdefault(gram, {})
        of_gram[number[language]] = of_gram.get(number[language], 0) + weight
    names = F.array(*(F.lit(language) for language in languages)).cast("array<string>")
    scores = docs.select("key", gram_scores(words_of(F.col("text")), weights, len(languages)).alias("scores"))
    by_language = scores.select("key", F.posexplode("scores").alias("place", "score")).filter("score > 0")
    sums = by_language.groupBy("key", F.get(names, F.col("place")).alias("language")).agg(F.sum("score").alias("score"))
    counts = docs.select("key", gram_count(F.col("text")).alias("n_grams"))
    ranked = (
        sums.groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "language"))).alias("by_score"))
    )
    best, second = F.get("by_score", F.lit(0)), F.get("by_score", F.lit(1))
    lead = F.coalesce(second["s"], F.lit(0)) - best["s"]
    found = counts.join(ranked, "key", "left")
    return found.select(
        "key",
        F.when(lead >= margin * F.col("n_grams"), best["language"]).otherwise(F.lit(UNKNOWN)).alias("language"),
        "n_grams",
        (-best["s"]).alias("score"),
        lead.alias("lead"),
    )
