"""Quality rules with a cross-document line frequency (DataFrame functions only).

Within a document: word and symbol counts, repeated lines, and the words that
lie in 8-word windows found twice or more. Across documents: every line is
normalised (separator runs to one space, trimmed) and hashed;
for each host the distinct *texts* that hold a line are counted, so exact
copies of one document count once. A line held by more than ``max_share`` of a
host's distinct texts and by more than ``min_texts`` of them is boilerplate. A
document that keeps fewer than ``min_words`` words once such lines are removed
is depleted and rejected.

How it scales: a row's own counts are array expressions over that row, no
shuffle. Line counts shuffle 64-bit hashes, first made distinct for each
(host, line, text), then summed with a map-side combine, so a line that a third
of all documents share is spread over all tasks. A host has fewer than
``lines per text / max_share`` boilerplate lines (each needs that share of the
host's texts), so their list for each host is small whatever the corpus; it is
joined on the host, broadcast only if Spark's size check allows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import SEPARATOR_CHARS, let
from salesmart.session import scratch_uri

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: A line is boilerplate in more than this share of a host's distinct texts and in more than so many.
MAX_SHARE = 0.05
MIN_TEXTS = 10


def _is_blank(line: Column) -> Column:
    return F.btrim(line, F.lit(SEPARATOR_CHARS)) == F.lit("")


def _repeated_starts(grams: Column) -> Column:
    """Ascending positions of the hashes that occur twice or more."""
    pairs = F.sort_array(F.transform(grams, lambda h, p: F.struct(h.alias("h"), p.alias("p"))))

    def repeated(s: Column) -> Column:
        def same(k: Column, x: Column) -> Column:
            return F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))

        hit = F.filter(s, lambda x, k: same(k - 1, x) | same(k + 1, x))
        return F.sort_array(F.transform(hit, lambda x: x["p"]))

    return let(pairs, repeated)


def _covered_words(starts: Column) -> Column:
    """Words under windows of WINDOW words that start at the given positions."""

    def total(s: Column) -> Column:
        gain = F.transform(
            s, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(p - F.get(s, k - 1), F.lit(WINDOW)))
        )
        return F.aggregate(gain, F.lit(0), lambda acc, g: acc + g)

    return let(starts, total)


def document_stats(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns named in ``keep`` and the in-document counts of every row.

    Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``
    (long) and ``base_failed`` (boolean). A null or empty text has no words
    and fails. Repeated rows each keep their row.

    A step refers to the array of the step before more than once, so that
    the optimiser keeps the steps apart and computes every array once.
    """
    kept = [F.col(c) for c in keep]
    text = F.coalesce(F.col(text_col), F.lit(""))
    # separators other than space and line feed, and symbols: few texts have any
    odd = F.col("_text").rlike(r"[\x09\x0B-\x0D#*$%&|<>]")
    chars = F.char_length("_text")
    symbols = chars - F.char_length(F.regexp_replace("_text", r"[#*$%&|<>]", ""))
    plain = F.when(odd, F.regexp_replace("_text", r"[\x09\x0B-\x0D]", " ")).otherwise(F.col("_text"))
    dup_lines = let(
        F.filter(F.split("_text", "\n"), lambda x: ~_is_blank(x)),
        lambda ls: F.size(ls) - F.size(F.array_distinct(ls)),
    )
    pieces = docs.select(*kept, text.alias("_text")).select(
        *kept,
        F.when(odd, symbols).otherwise(F.lit(0)).cast("long").alias("n_symbols"),
        dup_lines.cast("long").alias("n_dup_lines"),
        chars.alias("_chars"),
        F.split(F.replace(plain, F.lit("\n"), F.lit(" ")), " ").alias("_pieces"),
    )
    has_empty = F.array_contains("_pieces", "")
    words = pieces.select(
        *kept,
        "n_symbols",
        "n_dup_lines",
        # every separator is a cut between two pieces
        (F.col("_chars") - (F.size("_pieces") - 1)).cast("long").alias("word_chars"),
        F.when(has_empty, F.array_remove("_pieces", "")).otherwise(F.col("_pieces")).alias("_words"),
    )
    done = [*kept, "n_symbols", "n_dup_lines", "word_chars", "n_words"]
    grams = words.select(
        *done[:-1],
        F.size("_words").cast("long").alias("n_words"),
        F.size("_words").alias("_n"),
        F.when(F.size("_words") >= WINDOW, F.transform("_words", lambda w: F.xxhash64(w))).alias("_grams"),
    )
    for step in (1, 2, 4):  # hashes of 2, 4 and 8 consecutive words
        later = F.slice("_grams", F.lit(step + 1), F.col("_n"))
        grams = grams.select(
            *done,
            F.greatest(F.size("_grams") - step, F.lit(0)).alias("_n"),
            F.slice(
                F.zip_with("_grams", later, lambda x, y: F.xxhash64(x, y)), F.lit(1), F.size("_grams") - step
            ).alias("_grams"),
        )
    repeat = F.when(
        F.size("_grams") > F.size(F.array_distinct("_grams")),
        _covered_words(_repeated_starts(F.col("_grams"))),
    ).otherwise(F.lit(0))
    return grams.select(
        *kept,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        repeat.cast("long").alias("n_repeat_words"),
    ).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS)
        | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT),
    )


def _normal_lines(text: Column) -> Column:
    """The lines with a word, trimmed, runs of separators as one space."""
    text = F.coalesce(text, F.lit(""))
    loose = text.rlike(r"\x20\x20|[\x09\x0B-\x0D]")
    even = F.when(loose, F.regexp_replace(text, r"[\x20\x09\x0B-\x0D]+", " ")).otherwise(text)
    return F.array_remove(F.transform(F.split(even, "\n"), lambda x: F.btrim(x)), "")


def _host(host_col: str) -> Column:
    return F.coalesce(F.col(host_col), F.lit(""))


def _boilerplate(text: Column, hashes: Column) -> Column:
    """The normalised lines of a text whose hash is listed (none for a null list)."""
    return F.when(
        hashes.isNotNull(),
        F.filter(_normal_lines(text), lambda x: F.array_contains(hashes, F.xxhash64(x))),
    )


def _line_words(lines: Column) -> Column:
    """Words of normalised lines in all; 0 for null."""
    total = F.aggregate(lines, F.lit(0), lambda acc, x: acc + F.size(F.split(x, " ")))
    return F.coalesce(total, F.lit(0))


def frequent_lines(
    docs: DataFrame,
    text_col: str = "text",
    host_col: str = "source",
    max_share: float = MAX_SHARE,
    min_texts: int = MIN_TEXTS,
) -> DataFrame:
    """``(host, lines array<long>)``: hashes of the boilerplate lines of each host.

    A null host counts as the empty one. Rows without words add to the host's
    texts but have no lines.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        _host(host_col).alias("host"),
        F.xxhash64(text, F.lit(1)).alias("text_hash"),
        F.array_distinct(F.transform(_normal_lines(text), lambda x: F.xxhash64(x))).alias("hashes"),
    )
    texts = (
        rows.select("host", "text_hash").distinct().groupBy("host").agg(F.count("*").alias("n_texts"))
    )
    counts = (
        rows.select("host", "text_hash", F.explode("hashes").alias("h"))
        .distinct()
        .groupBy("host", "h")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > min_texts)
    )
    return (
        counts.join(texts, "host")
        .where(F.col("n") > F.col("n_texts") * max_share)
        .groupBy("host")
        .agg(F.collect_set("h").alias("lines"))
    )


def written_frequent_lines(docs: DataFrame, **options) -> DataFrame:
    """``frequent_lines`` as a table in the shared folder, so its size is known to the planner."""
    spark = docs.sparkSession
    path = scratch_uri(spark, "frequent-lines")
    frequent_lines(docs, **options).write.parquet(path)
    return spark.read.schema("host string, lines array<long>").parquet(path)


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_share: float = MAX_SHARE,
    min_texts: int = MIN_TEXTS,
) -> DataFrame:
    """One row for each input row: its counts, ``base_failed`` and the verdict ``kept``.

    Also ``n_removed_lines`` and ``n_removed_words`` of boilerplate lines. A
    document is kept if it passes the base rules and keeps MIN_WORDS words
    without those lines. Nulls: a null id or host is carried as it is, a null
    text is an empty one. An empty table gives an empty result. Columns other
    than the three named ones are ignored.
    """
    source = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(host_col).alias("source")
    )
    frequent = written_frequent_lines(source, max_share=max_share, min_texts=min_texts)
    hosted = source.select("doc_id", "text", _host("source").alias("host")).join(frequent, "host", "left")
    marked = hosted.select("doc_id", "text", _boilerplate(F.col("text"), F.col("lines")).alias("_removed"))
    counted = marked.select(
        "doc_id",
        "text",
        F.greatest(F.coalesce(F.size("_removed"), F.lit(0)), F.lit(0)).cast("long").alias("n_removed_lines"),
        _line_words(F.col("_removed")).cast("long").alias("n_removed_words"),
    )
    return document_stats(counted, keep=("doc_id", "n_removed_lines", "n_removed_words")).withColumn(
        "kept",
        ~F.col("base_failed") & (F.col("n_words") - F.col("n_removed_words") >= MIN_WORDS),
    )


def _without_boilerplate(text: Column, hashes: Column) -> Column:
    """The text without the lines whose normalised form is listed; the other lines as they are."""

    def normal(line: Column) -> Column:
        return F.btrim(F.regexp_replace(line, r"[\x20\x09\x0B-\x0D]+", " "))

    rest = F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(hashes, F.xxhash64(normal(x))))
    return F.array_join(rest, "\n")


def clean_good_documents(
    docs: DataFrame,
    text_col: str = "text",
    host_col: str = "source",
    length_col: str | None = "n_chars",
    max_share: float = MAX_SHARE,
    min_texts: int = MIN_TEXTS,
) -> DataFrame:
    """The rows that the rules keep, boilerplate lines removed from their texts.

    Same columns and types. ``length_col``, if present, is the code point count
    of a changed text; rows without a boilerplate line are unchanged.
    """
    frequent = written_frequent_lines(
        docs, text_col=text_col, host_col=host_col, max_share=max_share, min_texts=min_texts
    )
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col(text_col).alias("text"),
        _host(host_col).alias("host"),
    ).join(frequent, "host", "left")
    marked = packed.select(
        "doc", "text", "lines", _boilerplate(F.col("text"), F.col("lines")).alias("_removed")
    )
    counted = marked.select(
        "doc",
        "text",
        _line_words(F.col("_removed")).alias("removed_words"),
        F.when(
            F.size("_removed") > 0, _without_boilerplate(F.col("text"), F.col("lines"))
        ).alias("cleaned"),
    )
    stats = document_stats(counted, keep=("doc", "removed_words", "cleaned"))
    # numbered for the same reason as in keep_good_documents
    numbered = stats.withColumn("row", F.monotonically_increasing_id())
    left = F.col("n_words") - F.col("removed_words")
    good = ~F.col("base_failed") & (left >= MIN_WORDS) & (F.col("row") >= 0)
    out = []
    for f in docs.schema:
        value = F.col(f"doc.`{f.name}`")
        if f.name == text_col:
            value = F.coalesce("cleaned", value)
        elif f.name == length_col:
            length = F.char_length("cleaned").cast(f.dataType)
            value = F.when(F.col("cleaned").isNotNull() & value.isNotNull(), length).otherwise(value)
        out.append(value.alias(f.name))
    return numbered.where(good).select(*out)


def keep_good_documents(
    docs: DataFrame,
    text_col: str = "text",
    host_col: str = "source",
    max_share: float = MAX_SHARE,
    min_texts: int = MIN_TEXTS,
) -> DataFrame:
    """The rows of ``docs`` that the rules keep, every column as it was (whatever its name)."""
    frequent = written_frequent_lines(
        docs, text_col=text_col, host_col=host_col, max_share=max_share, min_texts=min_texts
    )
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col(text_col).alias("text"),
        _host(host_col).alias("host"),
    ).join(frequent, "host", "left")
    removed = _line_words(_boilerplate(F.col("text"), F.col("lines")))
    counted = packed.select("doc", "text", removed.alias("removed_words"))
    stats = document_stats(counted, keep=("doc", "removed_words"))
    # a filter is not pushed below a row number; pushed, it would repeat every array step in itself
    numbered = stats.withColumn("row", F.monotonically_increasing_id())
    left = F.col("n_words") - F.col("removed_words")
    good = ~F.col("base_failed") & (left >= MIN_WORDS) & (F.col("row") >= 0)
    return numbered.where(good).select("doc.*")
