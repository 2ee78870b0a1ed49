"""Text quality, cleaning and chunking operators bound to the given documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.functions import chunks as C
from tarn.functions import text as X
from tarn.functions.language import LEXICON, TRANSLATOR_CODES
from tarn.operators import languages as LA
from tarn.operators import text_clean as TC
from tarn.operators import text_quality as TQ
from tarn.plans import views as V

TRIM = V.trim_sql
LINES = "\n"


def _noisy(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with a bell, a zero-width space and a line separator at the end."""
    return V.docs(spark, sf).withColumn("text", F.concat("text", F.lit("\x07\u200b\u2028")))


NOISY_SQL = "noisy AS (SELECT doc_id AS key, text || chr(7) || chr(8203) || chr(8232) AS text FROM documents)"


def _joined(lengths: str = "paragraph_token_list"):
    return F.array_join(F.col(lengths).cast("array<string>"), ",").alias("paragraph_token_list")


def text_profile(spark: SparkSession, sf: str) -> DataFrame:
    profile = TQ.text_profile(_noisy(spark, sf), LINES)
    return profile.withColumn("paragraph_token_list", _joined())


def printable_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return TQ.printable_ratio(_noisy(spark, sf)).select(
        "key", "n_unprintable", F.round("ratio", 6).alias("ratio"), "low_printable_ratio"
    )


def paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    return V.docs(spark, sf).select(
        "key", F.posexplode(X.paragraphs(F.col("text"), LINES)).alias("n", "paragraph")
    )


def paragraph_stats(spark: SparkSession, sf: str) -> DataFrame:
    return TQ.paragraph_stats(V.docs(spark, sf), LINES).withColumn("paragraph_token_list", _joined())


def size_flags(spark: SparkSession, sf: str) -> DataFrame:
    return TQ.size_flags(V.docs(spark, sf))


def line_count(spark: SparkSession, sf: str) -> DataFrame:
    return _noisy(spark, sf).select("key", X.line_count(F.col("text")).alias("lines"))


def language_by_grams(spark: SparkSession, sf: str) -> DataFrame:
    """Profiles from all documents with a language, and the language of every document by them."""
    known = V.table(spark, sf, "documents").select("lang", "text")
    return LA.language_by_grams(V.docs(spark, sf), LA.language_profiles(known))


LANGUAGE_BY_GRAMS_SQL = f"""WITH words AS (
  SELECT doc_id AS key, lang, '_' || unnest(string_split_regex(lower(text), '[^\\p{{L}}]+')) || '_' AS word FROM documents),
grams AS (SELECT key, lang, substr(word, i, {LA.GRAM}) AS gram FROM
  (SELECT *, unnest(range(1, length(word) - {LA.GRAM - 2})) AS i FROM words WHERE word <> '__')),
counted AS (SELECT lang, gram, count(*) AS n FROM grams WHERE lang IS NOT NULL GROUP BY ALL),
ranked AS (SELECT *, sum(n) OVER (PARTITION BY lang) AS total, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS place FROM counted),
profiles AS (SELECT lang AS language, gram, floor(ln(n::DOUBLE / total::DOUBLE / {LA.FLOOR}) * 1000)::BIGINT AS weight FROM ranked WHERE place <= {LA.PROFILE}),
sums AS (SELECT key, language, sum(weight)::BIGINT AS score FROM grams JOIN profiles USING (gram) WHERE weight > 0 GROUP BY ALL),
placed AS (SELECT *, row_number() OVER w AS place, score - coalesce(lead(score) OVER w, 0) AS lead_ FROM sums
  WINDOW w AS (PARTITION BY key ORDER BY score DESC, language)),
counts AS (SELECT key, count(*) AS n_grams FROM grams GROUP BY key)
SELECT doc_id AS key, CASE WHEN lead_ >= {LA.MARGIN} * n_grams THEN language ELSE 'unknown' END AS language,
  coalesce(n_grams, 0) AS n_grams, score, lead_ AS lead
FROM documents LEFT JOIN counts ON counts.key = doc_id LEFT JOIN (SELECT * FROM placed WHERE place = 1) AS p ON p.key = doc_id"""


def language_vote(spark: SparkSession, sf: str) -> DataFrame:
    return TQ.language_vote(V.docs(spark, sf))


def route_translation(spark: SparkSession, sf: str) -> DataFrame:
    code = (
        F.when(F.col("source") == "src1", "zh-CN")
        .when(F.col("source") == "src2", "ZH_CN")
        .when(F.col("source") == "src3", "pt")
        .otherwise(F.col("lang"))
    )
    return TQ.route_translation(
        V.table(spark, sf, "documents").select(F.col("doc_id").alias("key"), code.alias("origin_language"))
    )


def drop_low_quality(spark: SparkSession, sf: str) -> DataFrame:
    return TQ.drop_low_quality(V.docs(spark, sf)).select("key")


def _messy(text):
    return F.concat(
        F.lit("\ufeff"),
        F.replace(text, F.lit(" "), F.lit(" \u2003\x02 ")),
        F.lit("\r\n\n\n\x07\nend\t \n"),
    )


_MESSY_SQL = (
    "chr(65279) || replace(text, ' ', ' ' || chr(8195) || chr(2) || ' ') || chr(13) || chr(10) || chr(10) || chr(10)"
    " || chr(7) || chr(10) || 'end' || chr(9) || ' ' || chr(10)"
)


def basic_clean(spark: SparkSession, sf: str) -> DataFrame:
    docs = V.docs(spark, sf).withColumn("text", _messy(F.col("text")))
    return TC.basic_clean(docs).select("key", F.md5("text").alias("text_md5"))


def split_sentences(spark: SparkSession, sf: str) -> DataFrame:
    return TC.split_sentences(V.docs(spark, sf))


def pack_sentences(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents packed to 126 tokens; sentences above that are cut into windows."""
    chunks = C.chunk_text(F.col("text"), max_tokens=128, stride=16)
    return V.docs(spark, sf).select("key", F.posexplode(chunks).alias("chunk_no", "chunk")).select(
        "key", "chunk_no", "chunk.n_tokens", F.md5("chunk.text").alias("text_md5")
    )


def window_long_sentence(spark: SparkSession, sf: str) -> DataFrame:
    windows = C.windows(X.words(F.col("text")), C.token_budget(), C.STRIDE, C.Tokenizer())
    return V.docs(spark, sf).select("key", F.posexplode(windows).alias("window_no", "w")).select(
        "key", "window_no", "w.n_tokens", F.md5("w.text").alias("text_md5")
    )


def chunk_documents(spark: SparkSession, sf: str) -> DataFrame:
    return TC.chunk_documents(V.docs(spark, sf), separator=LINES).select(
        "key", "paragraph_no", "chunk_no", "n_tokens", F.md5("text").alias("text_md5")
    )


def rechunk_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    return TC.rechunk_paragraphs(V.docs(spark, sf), separator=LINES).select(
        "key", F.md5("text").alias("text_md5")
    )


def _adorned(text):
    return F.concat(F.lit("\U0001f3ae\u2728 \u00e9\u2728q\u0301 "), text, F.lit("\x07"))


def final_scrub(spark: SparkSession, sf: str) -> DataFrame:
    docs = V.docs(spark, sf).withColumn("text", _adorned(F.col("text")))
    return TC.final_scrub(docs).select("key", F.md5("text").alias("text_md5"))


def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return TC.clean_text(V.docs(spark, sf)).select(
        "key", "language", "translator_code", F.md5("text").alias("text_md5")
    )


def truncate_tokens(spark: SparkSession, sf: str) -> DataFrame:
    kept = X.truncate_tokens(F.col("text"), 77)
    return V.docs(spark, sf).select(
        "key", F.size(kept).alias("n_tokens"), F.md5(F.array_join(kept, " ")).alias("text_md5")
    )


def preview(spark: SparkSession, sf: str) -> DataFrame:
    return V.docs(spark, sf).select("key", X.preview(F.col("text")).alias("preview"))


_BAD = (
    r"length(text) - length(regexp_replace(text, '[\x00-\x08\x0e-\x1b\x7f-\x{84}\x{86}-\x{9f}\p{Cf}\p{Co}]', '', 'g'))"
)
_BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
_LINE_COUNT = (
    f"(len(regexp_extract_all(text, '{_BREAKS}')) + CASE WHEN text = '' OR regexp_matches(text, '({_BREAKS})$') THEN 0 ELSE 1 END)::INT"
)


def _pieces(text: str, separator: str = "chr(10)") -> str:
    return (
        f"list_filter(list_transform(string_split({text}, {separator}), lambda x: {TRIM('x')}), lambda x: x <> '')"
    )


def _language_sql(text: str = "text") -> str:
    votes = [
        f"len(list_filter(regexp_extract_all(lower({text}), '\\p{{L}}+'), lambda w: w IN ({', '.join(repr(w) for w in LEXICON[code])})))"
        for code in sorted(LEXICON)
    ]
    best = f"greatest({', '.join(votes)})"
    arms = " ".join(f"WHEN {vote} THEN '{code}'" for vote, code in zip(votes, sorted(LEXICON), strict=True))
    return f"CASE WHEN {best} = 0 THEN 'unknown' ELSE CASE {best} {arms} END END"


def _code_sql(column: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TRANSLATOR_CODES.items())
    return f"CASE lower({column}) {arms} ELSE {column} END"


_STATS = f"""CASE WHEN len(p) = 0 THEN 0.0::DOUBLE ELSE {V.round_sql('list_sum(p)::DOUBLE / len(p)')} END AS avg_tokens_per_paragraph,
       coalesce(list_max(p), 0)::INT AS max_tokens_paragraph, coalesce(list_min(p), 0)::INT AS min_tokens_paragraph,
       array_to_string(p, ',') AS paragraph_token_list"""

_END = ".?!。！？"


def _sentences_sql(text: str) -> str:
    """Sentences of a text as a list."""
    line = TRIM("regexp_replace(x, '[\\s\\p{Z}]+', ' ', 'g')")
    marked = f"regexp_replace(l, '([{_END}])[\\s\\p{{Z}}]+', '\\1' || chr(1), 'g')"
    return (
        f"list_filter(flatten(list_transform(list_filter(list_transform(string_split({text}, chr(10)), lambda x: {line}),"
        f" lambda l: l <> ''), lambda l: string_split({marked}, chr(1)))), lambda s: s <> '')"
    )


def chunk_sql(source: str, budget: int, stride: int) -> str:
    """CTEs that end in ``chunks(key, p, chunk_no, text, n_tokens)`` of ``source(key, p, text)``.

    Greedy packing by a recursion over sentence numbers; a sentence above the budget stands alone and
    is cut into windows.
    """
    step = max(budget - stride, 1)
    return f"""
sents AS (SELECT key, p, {_sentences_sql('text')} AS s FROM {source}),
numbered AS (SELECT key, p, unnest(range(len(s))) AS i, unnest(s) AS s FROM sents),
sized AS (SELECT *, len(string_split(s, ' ')) AS n FROM numbered),
walk AS (
  SELECT key, p, i, s, n, 0 AS seg, n AS filled FROM sized WHERE i = 0
  UNION ALL
  SELECT b.key, b.p, b.i, b.s, b.n, CASE WHEN a.filled + b.n <= {budget} THEN a.seg ELSE a.seg + 1 END,
         CASE WHEN a.filled + b.n <= {budget} THEN a.filled + b.n ELSE b.n END
  FROM walk a JOIN sized b ON b.key = a.key AND b.p = a.p AND b.i = a.i + 1),
segs AS (SELECT key, p, seg, string_agg(s, ' ' ORDER BY i) AS text, sum(n)::BIGINT AS n FROM walk GROUP BY 1, 2, 3),
cuts AS (
  SELECT key, p, seg, w, array_to_string(list_slice(string_split(text, ' '), w * {step} + 1, w * {step} + {budget}), ' ') AS text
  FROM (SELECT *, unnest(range(CASE WHEN n > {budget} THEN ceil((n - {budget}) / {step}.0)::BIGINT + 1 ELSE 1 END)) AS w FROM segs)),
chunks AS (
  SELECT key, p, (row_number() OVER (PARTITION BY key, p ORDER BY seg, w) - 1)::INT AS chunk_no, text,
         len(string_split(text, ' '))::INT AS n_tokens FROM cuts)"""


_PARAGRAPHS = f"""paras AS (SELECT key, unnest(range(len(ps)))::INT AS p, unnest(ps) AS text
  FROM (SELECT doc_id AS key, {_pieces('text')} AS ps FROM documents))"""


def _rebuilt(source: str) -> str:
    return f"""rebuilt AS (
  SELECT key, string_agg(piece, chr(10) || chr(10) ORDER BY p) AS text FROM (
    SELECT {source}.key, {source}.p, CASE WHEN length({source}.text) > 512 THEN c.text ELSE {source}.text END AS piece
    FROM {source} LEFT JOIN (SELECT key, p, string_agg(text, chr(10) || chr(10) ORDER BY chunk_no) AS text FROM chunks GROUP BY 1, 2) c
      ON c.key = {source}.key AND c.p = {source}.p)
  GROUP BY key)"""


_CONTROL = r"[\x00-\x08\x0B-\x0C\x0E-\x1F\x7F]"


def _scrubbed(text: str) -> str:
    for pattern, new in (
        (r"[\x{300}-\x{36F}]+", ""),
        (_CONTROL, " "),
        (r"[\x{1F300}-\x{1FAFF}\x{2700}-\x{27BF}]+", " "),
        (r"[^\x00-\x7F]+", " "),
    ):
        text = f"regexp_replace({text}, '{pattern}', '{new}', 'g')"
    return text


def _cleaned(text: str) -> str:
    text = f"regexp_replace(regexp_replace(replace({text}, chr(65279), ''), '{_CONTROL}', '', 'g'), '\\r\\n?', chr(10), 'g')"
    line = TRIM("regexp_replace(x, '[ \\t\\x{A0}\\x{2000}-\\x{200B}\\x{3000}]+', ' ', 'g')")
    lines = f"array_to_string(list_transform(string_split({text}, chr(10)), lambda x: {line}), chr(10))"
    return f"regexp_replace({lines}, '\\n{{3,}}', chr(10) || chr(10), 'g')"


_KEEP = f"length({TRIM('text')}) >= 20 AND ({_BAD}) <= 0.1 * greatest(1, length(text))"

CASES = {
    "text_profile": (
        text_profile,
        f"""WITH {NOISY_SQL}, e AS (SELECT *, list_transform({_pieces('text')}, lambda x: length(x)) AS p FROM noisy)
        SELECT key, strlen(text)::BIGINT AS size_bytes, 'utf-8' AS encoding, {TRIM('text')} = '' AS empty,
               length({TRIM('text')}) < 20 AS too_short, (length(text) - ({_BAD})) / greatest(1, length(text)) < 0.9 AS low_printable_ratio,
               {_LINE_COUNT} AS lines, {_STATS}, {_language_sql()} AS origin_language FROM e""",
    ),
    "printable_ratio": (
        printable_ratio,
        f"""WITH {NOISY_SQL}, b AS (SELECT key, text, {_BAD} AS bad FROM noisy)
        SELECT key, bad::INT AS n_unprintable, round((length(text) - bad) / greatest(1, length(text)), 6) AS ratio,
               (length(text) - bad) / greatest(1, length(text)) < 0.9 AS low_printable_ratio FROM b""",
    ),
    "paragraphs": (
        paragraphs,
        f"""WITH e AS (SELECT doc_id AS key, {_pieces('text')} AS p FROM documents)
        SELECT key, unnest(range(len(p)))::INT AS n, unnest(p) AS paragraph FROM e""",
    ),
    "paragraph_stats": (
        paragraph_stats,
        f"""WITH e AS (SELECT doc_id AS key, list_transform({_pieces('text')}, lambda x: length(x)) AS p FROM documents)
        SELECT key, {_STATS} FROM e""",
    ),
    "size_flags": (
        size_flags,
        f"""SELECT doc_id AS key, strlen(text)::BIGINT AS size_bytes, {TRIM('text')} = '' AS empty,
        length({TRIM('text')}) < 20 AS too_short FROM documents""",
    ),
    "line_count": (line_count, f"WITH {NOISY_SQL} SELECT key, {_LINE_COUNT} AS lines FROM noisy"),
    "language_by_grams": (language_by_grams, LANGUAGE_BY_GRAMS_SQL),
    "language_vote": (language_vote, f"SELECT doc_id AS key, {_language_sql()} AS language FROM documents"),
    "route_translation": (
        route_translation,
        f"""WITH l AS (SELECT doc_id AS key, CASE source WHEN 'src1' THEN 'zh-CN' WHEN 'src2' THEN 'ZH_CN' WHEN 'src3' THEN 'pt'
              ELSE lang END AS language FROM documents)
        SELECT key, language, {_code_sql('language')} AS translator_code, language <> 'en' AS translate FROM l""",
    ),
    "drop_low_quality": (drop_low_quality, f"SELECT doc_id AS key FROM documents WHERE {_KEEP}"),
    "basic_clean": (
        basic_clean,
        f"SELECT doc_id AS key, md5({_cleaned(_MESSY_SQL)}) AS text_md5 FROM documents",
    ),
    "split_sentences": (
        split_sentences,
        f"""WITH e AS (SELECT doc_id AS key, {_sentences_sql('text')} AS s FROM documents)
        SELECT key, unnest(range(len(s)))::INT AS sentence_no, unnest(s) AS sentence FROM e""",
    ),
    "pack_sentences": (
        pack_sentences,
        f"""WITH RECURSIVE whole AS (SELECT doc_id AS key, 0 AS p, text FROM documents), {chunk_sql('whole', 126, 16)}
        SELECT key, chunk_no, n_tokens, md5(text) AS text_md5 FROM chunks""",
    ),
    "window_long_sentence": (
        window_long_sentence,
        """WITH t AS (SELECT doc_id AS key, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS w FROM documents),
        n AS (SELECT *, unnest(range(CASE WHEN len(w) > 510 THEN ceil((len(w) - 510) / 446.0)::BIGINT + 1 ELSE 1 END)) AS i FROM t)
        SELECT key, i::INT AS window_no, len(w[i * 446 + 1 : i * 446 + 510])::INT AS n_tokens,
               md5(array_to_string(w[i * 446 + 1 : i * 446 + 510], ' ')) AS text_md5 FROM n""",
    ),
    "chunk_documents": (
        chunk_documents,
        f"""WITH RECURSIVE {_PARAGRAPHS}, {chunk_sql('paras', 510, 64)}
        SELECT key, p AS paragraph_no, chunk_no, n_tokens, md5(text) AS text_md5 FROM chunks""",
    ),
    "rechunk_paragraphs": (
        rechunk_paragraphs,
        f"""WITH RECURSIVE {_PARAGRAPHS}, {chunk_sql('paras', 510, 64)}, {_rebuilt('paras')}
        SELECT key, md5(text) AS text_md5 FROM rebuilt""",
    ),
    "final_scrub": (
        final_scrub,
        "SELECT doc_id AS key, md5("
        + _scrubbed(
            "chr(127918) || chr(10024) || ' ' || chr(233) || chr(10024) || 'q' || chr(769) || ' ' || text || chr(7)"
        )
        + ") AS text_md5 FROM documents",
    ),
    "clean_text": (
        clean_text,
        f"""WITH RECURSIVE kept AS (SELECT doc_id AS key, {_language_sql()} AS language, {_cleaned('text')} AS text FROM documents WHERE {_KEEP}),
        paras AS (SELECT key, unnest(range(len(ps)))::INT AS p, unnest(ps) AS text
                  FROM (SELECT key, {_pieces('text', 'chr(10) || chr(10)')} AS ps FROM kept)),
        {chunk_sql('paras', 510, 64)}, {_rebuilt('paras')}
        SELECT kept.key, language, {_code_sql('language')} AS translator_code, md5({_scrubbed('rebuilt.text')}) AS text_md5
        FROM kept JOIN rebuilt USING (key)""",
    ),
    "truncate_tokens": (
        truncate_tokens,
        """WITH t AS (SELECT doc_id AS key, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')[1:77] AS w FROM documents)
        SELECT key, len(w)::INT AS n_tokens, md5(array_to_string(w, ' ')) AS text_md5 FROM t""",
    ),
    "preview": (
        preview,
        """SELECT doc_id AS key, CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END AS preview FROM documents""",
    ),
}
