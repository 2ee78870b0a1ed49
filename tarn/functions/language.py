"""Language vote by marker words, and the routing of texts to a translator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarn.functions.bind import let

# Marker words of the languages told apart. Passed as a parameter wherever it is used.
LEXICON = {
    "de": ("der", "die", "das", "und", "ist", "nicht", "ein", "eine", "mit", "von", "auch", "für", "sich", "auf"),
    "en": ("the", "and", "of", "to", "in", "is", "that", "it", "for", "with", "by", "was", "this", "are"),
    "es": ("el", "los", "las", "y", "que", "en", "por", "con", "una", "para", "del", "no", "se", "como"),
    "fr": ("le", "les", "et", "est", "des", "un", "une", "que", "dans", "pour", "avec", "sur", "pas", "qui"),
}
UNKNOWN = "unknown"

# Detector code -> translator code. Looked up in lower case; other codes pass through.
TRANSLATOR_CODES = {
    "zh-cn": "zh-CN",
    "zh_cn": "zh-CN",
    "zh": "zh-CN",
    "en": "en",
    "es": "es",
    "fr": "fr",
    "ja": "ja",
    "ko": "ko",
}


def _one_of(words: tuple[str, ...]):
    return lambda word: word.isin(*words)


def language_of(text: Column, lexicon: dict[str, tuple[str, ...]] = LEXICON) -> Column:
    """The language with most votes; on a tie the first code; ``unknown`` without votes.

    The votes are counted inside the row, so no text is shuffled: the words are cut to marker words of
    any language once, and each language counts its own among these few.
    """
    known = sorted({word for words in lexicon.values() for word in words})
    tokens = F.split(F.lower(text), r"[^\p{L}]+")

    def elect(markers: Column) -> Column:
        return F.array_max(
            F.array(
                *(
                    F.struct(
                        F.size(F.filter(markers, _one_of(lexicon[code]))).alias("votes"),
                        F.lit(-place).alias("preference"),
                        F.lit(code).alias("code"),
                    )
                    for place, code in enumerate(sorted(lexicon))
                )
            )
        )

    best = let(F.filter(tokens, _one_of(tuple(known))), elect)
    return let(best, lambda b: F.when(b["votes"] > 0, b["code"]).otherwise(F.lit(UNKNOWN)))


def translator_code(language: Column) -> Column:
    """Code the translator expects: the fixed map over lower case, else the code itself."""
    pairs = [F.lit(part) for pair in TRANSLATOR_CODES.items() for part in pair]
    return F.coalesce(F.create_map(*pairs)[F.lower(language)], language)
