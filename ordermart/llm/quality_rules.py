"""Quality rules by distribution divergence, DataFrame functions only.

Two histograms of each whole text are compared with references of its
language by Jensen-Shannon distance (square root of the base-2 divergence):
- character classes: lower-case and other letters, A-Z, digits, symbols,
  other punctuation, white space, and UTF-8 continuation bytes;
- the language's common words, all other words as one class.
A reference is the mean of the histograms of all documents of that language,
whatever its share of the rows: the common words of languages with over 1 /
``LANGS`` of the rows are literals of the plan, those of others are joined by
language.  Distances judge a language with ``LEAST_DOCS`` documents past the
guards; rarer ones, and null, have nothing to be compared with that would not
reject clean text, so they are left to the base rules, as short texts are by
the minimum-length guards.

Base rules: under 20 words, or over 30 of 100 words inside 8-word windows that
occur twice or more in the text.

Defined cases: null text counts as empty, has no words and fails the base
rule; repeated rows get equal rows; the only columns read are the id, text and
language; an empty table gives no rows.  Common words are ranked by the number
of documents that hold them, ties by the word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut

#: Fewer than so many languages are matched without a shuffle.
LANGS = 200
#: Documents past the guards that a reference needs to reject others by.
LEAST_DOCS = 10
#: Common words of each reference.
COMMON = 40
#: Guards: words and characters below which a distance says nothing.
MIN_WORDS = 50
MIN_CHARS = 300
#: Distances above these are rejected.  A word histogram drawn from the
#: reference itself lies about 1 / sqrt(words) away, so short texts get that
#: much more room.
MAX_CHAR = 0.30
MAX_WORD = 0.24
WORD_ROOM = 1.6

_CLASSES = {"upper": r"[A-Z]", "digit": r"[0-9]", "symbol": r"[#*$%&|<>]", "punct": r"[!\"'()+,\-./:;=?@\[\\\]^_`{}~]"}


def words_of(text: Column) -> Column:
    """Runs of characters outside 0x20 and 0x09-0x0D."""
    for c in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _pairs(h: Column, step: int) -> Column:
    """Hash of each element and the one ``step`` later."""
    return _let(h, lambda a: F.zip_with(a, F.slice(a, F.lit(step + 1), F.greatest(F.size(a), F.lit(1))), lambda x, y: F.xxhash64(x, y)))


def _covered(windows: Column, width: int) -> Column:
    """Words inside windows that occur twice or more: the start positions of
    such windows in order, each covering ``width`` words up to the next."""
    at = lambda a: F.zip_with(a, F.sequence(F.lit(0), F.size(a) - 1), lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    ordered = _let(windows, lambda a: F.array_sort(at(a)))

    def starts(s: Column) -> Column:
        nexts = F.slice(s, F.lit(2), F.size(s))
        same = F.zip_with(s, nexts, lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False)))  # equal to the next
        def marked(e: Column) -> Column:
            before = F.concat(F.array(F.lit(False)), e)
            both = F.zip_with(s, F.zip_with(e, before, lambda x, y: x | y), lambda x, m: F.when(m, x["i"]))
            return F.array_sort(F.filter(both, lambda i: i.isNotNull()))
        return _let(same, marked)

    gaps = lambda p: F.zip_with(p, F.slice(p, F.lit(2), F.size(p)), lambda x, y: F.least(F.lit(width), F.coalesce(y - x, F.lit(width))))
    total = lambda p: F.aggregate(gaps(p), F.lit(0), lambda t, g: t + g)
    return _let(_let(ordered, starts), total)


def _histogram(words: Column) -> Column:
    """Sorted runs of an array of words as (w, c) entries."""
    def runs(s: Column) -> Column:
        first = F.filter(
            F.zip_with(s, F.zip_with(F.concat(F.array(F.lit("")), s), F.sequence(F.lit(0), F.size(s)), lambda b, i: F.struct(b.alias("b"), i.alias("i"))),
                       lambda w, p: F.when(w != p["b"], F.struct(w.alias("w"), p["i"].alias("i")))),
            lambda e: e.isNotNull(),
        )
        return _let(first, lambda f: F.zip_with(f, F.slice(f, F.lit(2), F.greatest(F.size(f), F.lit(1))),
                                                 lambda x, y: F.struct(x["w"].alias("w"), (F.coalesce(y["i"], F.size(s)) - x["i"]).alias("c"))))
    return F.when(F.size(words) > 0, _let(F.sort_array(words), runs)).otherwise(F.array().cast("array<struct<w:string,c:int>>"))


def _js_term(p: Column, q: Column) -> Column:
    """One class's share of the base-2 Jensen-Shannon divergence."""
    half = lambda a: F.when(a > 0, a * F.log2(2 * a / (p + q))).otherwise(F.lit(0.0)) / 2
    return half(p) + half(q)


def _distance(divergence: Column) -> Column:
    return F.sqrt(F.greatest(F.lit(0.0), divergence))


def measure(docs: DataFrame, id_col: str, text_col: str, lang_col: str, is_common, listed: bool = False) -> DataFrame:
    """Counts and histograms of every row (no shuffle)."""
    df = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(lang_col).cast("string").alias("lang"), *(["listed"] if listed else []))
    df = df.withColumn("w", words_of(F.col("text")))
    lines = F.filter(F.split("text", "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    df = df.select(
        "id", "lang",
        F.xxhash64("text").alias("text_hash"),
        F.size("w").cast("long").alias("n_words"),
        F.length(F.concat_ws("", "w")).cast("long").alias("word_chars"),
        F.length("text").cast("long").alias("chars"),
        (F.octet_length("text") - F.length("text")).cast("long").alias("more_bytes"),
        *[F.regexp_count("text", F.lit(r)).cast("long").alias(k) for k, r in _CLASSES.items()],
        F.when(F.instr("text", "\n") == 0, F.lit(0)).otherwise(_let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a)))).cast("long").alias("n_dup_lines"),
        F.filter("w", is_common).alias("common"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("h"),
    )
    df = df.withColumn("h4", _pairs(_pairs(F.col("h"), 1), 2)).drop("h")
    # windows of 8 words, made of two windows of 4; most texts repeat none of 4
    n = F.col("n_words")
    h4 = F.slice("h4", F.lit(1), F.greatest(n - 3, F.lit(0)).cast("int"))
    h8 = lambda: F.slice(_pairs(F.col("h4"), 4), F.lit(1), F.greatest(n - 7, F.lit(0)).cast("int"))
    df = df.withColumn("again4", _let(h4, lambda a: F.size(a) - F.size(F.array_distinct(a))))
    df = df.withColumn("h8", F.when((n > 8) & (F.col("again4") > 4), h8()))
    df = df.withColumn("again8", F.when(F.col("h8").isNotNull(), F.size("h8") - F.size(F.array_distinct("h8"))).otherwise(F.lit(0)))
    df = df.withColumn("n_repeat_words", F.when(F.col("again8") > 0, _covered(F.col("h8"), 8)).otherwise(F.lit(0)).cast("long"))
    return df.withColumn("hist", _histogram(F.col("common"))).drop("common", "h4", "h8", "again4", "again8")


def common_words(docs: DataFrame, text_col: str, lang_col: str, common: int) -> tuple[list[str], list[str], DataFrame | None]:
    """(languages with over 1 / LANGS of the rows, their common words, common
    words of each other language if there are any): over all documents."""
    base = docs.select(F.col(lang_col).cast("string").alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n_rows = base.count()
    large = base.groupBy("lang").count().where((F.col("lang").isNull()) | (F.col("count") * LANGS > n_rows)).collect()
    langs = [r[0] for r in large if r[0] is not None]
    words = base.where("lang is not null").select("lang", F.explode(F.array_distinct(F.split("text", " "))).alias("w"))
    # a word of under 17 bytes: longer ones are no function words of any language
    df = words.where((F.octet_length("w") > 0) & (F.octet_length("w") < 17)).groupBy("lang", "w").agg(F.count("*").alias("df"))
    ranked = df.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("df"), "w")))
    top = ranked.where(F.col("r") <= common).select("lang", "w")
    rare = None
    if sum(r[1] for r in large) < n_rows:
        top = cut(top, "common")
        rare = cut(top.where(~F.col("lang").isin(langs)).groupBy("lang").agg(F.collect_list("w").alias("listed")), "rare")
    return langs, sorted({r[0] for r in top.where(F.col("lang").isin(langs)).select("w").collect()}), rare


def divergence(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    common: int = COMMON,
    max_char: float = MAX_CHAR,
    max_word: float = MAX_WORD,
    min_words: int = MIN_WORDS,
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """A row for each row of ``docs``: the base counts, char_js, word_js
    (null below the guards and for a null language), base_failed, kept, and
    ``text_hash`` to find the row again."""
    langs, listed, rare = common_words(docs, text_col, lang_col, common)
    lang = F.col(lang_col).cast("string")
    in_list = (lambda x: x.isin(listed)) if listed else (lambda x: F.lit(False))
    rows = measure(docs.where(lang.isNull() | lang.isin(langs)), id_col, text_col, lang_col, in_list)
    if rare is not None:
        others = docs.where(~lang.isin(langs)).select(F.col(id_col), F.col(text_col), lang.alias(lang_col))
        # each of these languages has at most 1 / LANGS of the rows
        others = others.join(rare.withColumnRenamed("lang", lang_col), lang_col, "left")
        rows = rows.unionByName(measure(others, id_col, text_col, lang_col, lambda x: F.array_contains("listed", x), listed=True))
    rows = cut(rows, "quality")
    size = (F.col("chars") + F.col("more_bytes")).cast("double")
    counts = {k: F.col(k) for k in _CLASSES} | {"space": F.col("chars") - F.col("word_chars"), "more": F.col("more_bytes")}
    share = {k: F.coalesce(F.try_divide(c, size), F.lit(0.0)) for k, c in counts.items()}
    share["lower"] = F.greatest(F.lit(0.0), 1 - sum(share.values(), F.lit(0.0)))
    long_enough = (F.col("n_words") >= min_words) & (F.col("chars") >= min_chars)

    # references: means over the documents past the guards, by language
    refs = rows.where(long_enough & F.col("lang").isNotNull()).select("lang", *[v.alias(f"c_{k}") for k, v in share.items()], "hist", "n_words")
    chars = refs.groupBy("lang").agg(*[F.avg(f"c_{k}").alias(f"q_{k}") for k in share], F.count("*").alias("n_docs"))
    each = refs.select("lang", "n_words", F.explode("hist").alias("e")).groupBy("lang", F.col("e.w").alias("w")).agg(F.sum(F.col("e.c") / F.col("n_words")).alias("s"))
    top = each.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("s"), "w"))).where(F.col("r") <= common)
    by_word = top.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("w", "s"))).alias("m"))
    refs = chars.join(by_word, "lang", "left").withColumn("m", F.transform_values(F.coalesce("m", F.create_map().cast("map<string,double>")), lambda _, s: s / F.col("n_docs")))
    refs = cut(refs, "references")

    # fewer than LANGS of ``common`` words: broadcast; null joins nothing
    large = F.col("lang").isin(langs)
    judged = rows.where(F.col("lang").isNull() | large).join(F.broadcast(refs.where(large)), "lang", "left")
    if rare is not None:
        judged = judged.unionByName(rows.where(~large).join(refs.where(~large), "lang", "left"))
    rows = judged
    char = sum((_js_term(share[k], F.col(f"q_{k}")) for k in share), F.lit(0.0))
    rows = rows.withColumn("known", F.filter(F.transform("hist", lambda e: F.struct((e["c"] / F.col("n_words")).alias("p"), F.element_at(F.col("m"), e["w"]).alias("q"))), lambda e: e["q"].isNotNull()))
    total = lambda a, f: F.aggregate(a, F.lit(0.0), lambda t, e: t + f(e))
    rows = rows.withColumn("p_known", total("known", lambda e: e["p"])).withColumn("q_known", total("known", lambda e: e["q"])).withColumn("q_all", total(F.map_values("m"), lambda q: q))
    one = F.lit(1.0)
    word = total("known", lambda e: _js_term(e["p"], e["q"])) + (F.col("q_all") - F.col("q_known")) / 2 + _js_term(
        F.greatest(F.lit(0.0), one - F.col("p_known")), F.greatest(F.lit(0.0), one - F.col("q_all"))
    )
    rows = rows.withColumn("char_js", F.when(long_enough & F.col("m").isNotNull(), _distance(char))).withColumn("word_js", F.when(long_enough & F.col("m").isNotNull(), _distance(word)))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    away = (F.coalesce("char_js", F.lit(0.0)) > max_char) | (F.coalesce("word_js", F.lit(0.0)) > max_word + WORD_ROOM / F.sqrt(F.greatest(F.col("n_words"), F.lit(1))))
    away = away & (F.coalesce("n_docs", F.lit(0)) >= LEAST_DOCS)
    return rows.select(
        F.col("id").alias(id_col), "n_words", "word_chars", F.col("symbol").alias("n_symbols"), "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~away).alias("kept"), "char_js", "word_js", "text_hash",
    )


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that the rules reject; all columns stay."""
    kept = divergence(docs, id_col, text_col, **options).where("kept").select(F.col(id_col).alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.join(kept, F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__hash")), "left_semi")
