"""Quality rules: counts within a text, and lines that many documents of one host share.

Lines are normalised and hashed; for each host (the `source` column) the distinct documents that
hold a line are counted. Lines above the limits are removed everywhere but in the first document of
the host that has them, so shared text survives once, and a document of which too little is left is
rejected. Exact copies count as one document: they are a matter for deduplication.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerostrata.llm.common import NON_WORD_ONLY, WHITE, WHITE_RUN, stored, table

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# A line is boilerplate of its host above both: so many documents, and this share of the host's.
MAX_DOCS = 20
MAX_DOC_SHARE = 0.005
# A document is depleted when less than this share of its words is left.
MIN_LEFT_SHARE = 0.2


def words_of(text: Column) -> Column:
    """Runs of anything but white space; an empty array for null or blank text."""
    trimmed = F.btrim(text, F.lit(WHITE))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, WHITE_RUN)).otherwise(F.array().cast("array<string>"))


def repeated_words(df: DataFrame, words: str, out: str, window: int = WINDOW) -> DataFrame:
    """Adds `out`: words inside windows that occur twice or more in the row's array `words`.

    Windows are compared by 64-bit hashes. Only rows with a repeated window are sorted. Every
    column that a lambda reads is referenced twice, which keeps the optimiser from inlining it.
    """
    df = df.withColumn("_w", F.transform(words, lambda w: F.xxhash64(w)))
    df = df.withColumn("_h", F.when(F.size("_w") >= window, F.transform(
        F.sequence(F.lit(1), F.size("_w") - (window - 1)), lambda i: F.xxhash64(F.slice("_w", i, window))))
        .otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn("_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.sort_array(
        F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    df = df.withColumn("_p", F.sort_array(F.transform(F.filter(
        "_s", lambda x, i: (F.get("_s", i - 1)["h"] == x["h"]) | (F.get("_s", i + 1)["h"] == x["h"])), lambda x: x["i"])))
    steps = F.transform("_p", lambda p, i: F.least(F.lit(window), F.coalesce(F.get("_p", i + 1) - p, F.lit(window))))
    covered = F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return df.withColumn(out, F.coalesce(covered, F.lit(0).cast("bigint"))).drop("_w", "_h", "_s", "_p")


def normalised(line: Column) -> Column:
    """Lower case, digits as 0, white space trimmed and collapsed."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.btrim(line, F.lit(WHITE))), WHITE_RUN, " "), "[0-9]", "0")


def _lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: ~x.rlike(NON_WORD_ONLY))


def base_counts(docs: DataFrame, text: str = "text", host: str = "source", key: str = "doc_id") -> DataFrame:
    """Per row: key, host, _copy (hash of the text), the five counts, base_failed, and _lines."""
    df = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("_host"),
                     F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    df = df.withColumn("_words", words_of(F.col("_text")))
    df = df.withColumn("n_words", F.size("_words").cast("bigint"))
    df = repeated_words(df, "_words", "n_repeat_words").drop("_words")
    df = df.withColumn("_raw", _lines(F.col("_text")))

    def chars(gone: str) -> Column:
        return F.length(F.translate(F.col("_text"), gone, "")).cast("bigint")

    size = F.length("_text").cast("bigint")
    return df.select(
        "_key", "_host", F.xxhash64("_text").alias("_copy"), "n_words",
        chars(WHITE).alias("word_chars"), (size - chars(SYMBOLS)).alias("n_symbols"),
        (F.size("_raw") - F.size(F.array_distinct("_raw"))).cast("bigint").alias("n_dup_lines"), "n_repeat_words",
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"),
        F.transform("_raw", lambda x: F.struct(F.xxhash64(normalised(x)).alias("line"), F.size(words_of(x)).alias("n"))).alias("_lines"))


def common_lines(counted: DataFrame, max_docs: int, max_doc_share: float) -> DataFrame:
    """Rows (_host, line, keeper): lines above both limits, keeper being the copy that keeps them.

    Counts are of distinct texts. Both steps sum before they shuffle; a line that a third of all
    documents hold reaches its counter as one row per task.
    """
    each = (counted.select("_host", "_copy", "_key", F.explode(F.array_distinct(F.col("_lines.line"))).alias("line"))
            .groupBy("_host", "line", "_copy").agg(F.min("_key").alias("_key")))
    found = each.groupBy("_host", "line").agg(
        F.count("*").alias("docs"), F.min(F.struct(F.col("_key").isNull(), "_key", "_copy")).alias("first"))
    found = stored(found.filter(F.col("docs") > max_docs).select("_host", "line", "docs", F.col("first._copy").alias("keeper")), "lines-many")
    hosts = stored(counted.select("_host", "_copy").distinct().groupBy("_host").agg(F.count("*").alias("n")), "lines-hosts")
    return stored(found.join(hosts, "_host").filter(F.col("docs") > max_doc_share * F.col("n"))
                  .select("_host", "line", "keeper"), "lines-common")


def judge(docs: DataFrame, text: str = "text", host: str = "source", key: str = "doc_id", max_docs: int = MAX_DOCS,
          max_doc_share: float = MAX_DOC_SHARE, min_left_share: float = MIN_LEFT_SHARE) -> DataFrame:
    """One row per document: key, counts, base_failed, n_common_words, kept, and for rewriting
    _host, _copy and _common (hashes of the lines to remove, or null).

    A null text is an empty one and fails; a null host is the host "". Of documents with the lowest
    key the copy with the smaller hash counts as first; null keys come last. Repeated rows are judged
    alike. An empty table gives an empty result; further columns are not read.
    """
    counted = stored(base_counts(docs, text, host, key), "lines-counted")
    common = common_lines(counted, max_docs, max_doc_share)
    # Texts are told apart by copy and host: rows that share both get the same answer.
    lines = counted.select("_host", "_copy", F.posexplode("_lines").alias("at", "x")).select("_host", "_copy", "at", "x.line", "x.n")
    hit = (lines.join(common, ["_host", "line"]).filter("keeper <> _copy")
           .groupBy("_host", "_copy", "at", "line").agg(F.max("n").alias("n"))
           .groupBy("_host", "_copy").agg(F.sum("n").alias("gone"), F.collect_set("line").alias("_common")))
    hit = stored(hit, "lines-hit")
    out = counted.drop("_lines").join(hit, ["_host", "_copy"], "left")
    gone = F.coalesce("gone", F.lit(0).cast("bigint"))
    return out.withColumns({
        "n_common_words": gone,
        "kept": ~F.col("base_failed") & (F.col("n_words") - gone >= min_left_share * F.col("n_words")),
    }).withColumnRenamed("_key", key).drop("gone")


def apply_rules(docs: DataFrame, text: str = "text", host: str = "source", key: str = "doc_id", **limits) -> DataFrame:
    """The kept documents with common lines removed from their text; columns as given.

    Removal leaves the other lines as they are; a text without common lines stays unchanged.
    """
    verdicts = stored(judge(docs, text, host, key, **limits).filter("kept")
                      .select("_host", "_copy", "_common").dropDuplicates(["_host", "_copy"]), "lines-verdicts")
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("_h"),
                        F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("_c"))
    joined = keyed.join(verdicts, (F.col("_h") == F.col("_host")) & (F.col("_c") == F.col("_copy")))
    own = F.col("row")[text]
    left = F.array_join(F.filter(F.split(own, "\n"), lambda x: x.rlike(NON_WORD_ONLY) | ~F.array_contains(
        F.col("_common"), F.xxhash64(normalised(x)))), "\n")
    new = F.when(F.col("_common").isNull(), own).otherwise(left)
    return joined.select(*(new.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns))


CONTRACT = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def op3_quality_lines(spark, sf_dir):
    return judge(table(spark, sf_dir, "documents")).select(*CONTRACT, "kept", "n_common_words")


def oracle() -> str:
    ws = r"[\x20\x09-\x0D]"
    return rf"""
    WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
    w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
          list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS raw FROM d),
    win AS (SELECT doc_id, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS g
            FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - {WINDOW - 1})) AS i FROM w WHERE len(words) >= {WINDOW})),
    twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
    rep AS (SELECT doc_id, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW}))) AS r
            FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM twice) GROUP BY doc_id),
    base AS (SELECT w.doc_id, host, t, raw, len(words) AS n_words,
          length(regexp_replace(t, '{ws}', '', 'g')) AS word_chars,
          length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
          len(raw) - len(list_distinct(raw)) AS n_dup_lines, coalesce(r, 0) AS n_repeat_words FROM w LEFT JOIN rep USING (doc_id)),
    l AS (SELECT doc_id, host, t, regexp_replace(regexp_replace(lower(trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))),
             '{ws}+', ' ', 'g'), '[0-9]', '0', 'g') AS line,
             len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n FROM (SELECT doc_id, host, t, unnest(raw) AS x FROM base)),
    many AS (SELECT host, line, count(DISTINCT t) AS docs, arg_min(t, doc_id) AS keeper FROM l GROUP BY ALL HAVING count(DISTINCT t) > {MAX_DOCS}),
    common AS (SELECT many.* FROM many JOIN (SELECT host, count(DISTINCT t) AS n FROM d GROUP BY host) USING (host) WHERE docs > {MAX_DOC_SHARE} * n),
    hit AS (SELECT doc_id, sum(n) AS gone FROM l JOIN common USING (host, line) WHERE keeper <> t GROUP BY doc_id),
    f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM base)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
      NOT base_failed AND n_words - coalesce(gone, 0) >= {MIN_LEFT_SHARE} * n_words AS kept, coalesce(gone, 0)::BIGINT AS n_common_words
    FROM f LEFT JOIN hit USING (doc_id)"""
