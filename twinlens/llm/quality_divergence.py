"""Quality rules by distribution divergence (operator 5), DataFrame functions only.

Every document is compared with its language's reference by Jensen-Shannon
distance (base 2, between 0 and 1) of two histograms: character classes and
the language's commonest words. The references are totals over all documents
of the language. Two scans: one counts words for the references, one derives
each document's counts; what is shuffled are word counts summed per task and
one narrow row per document.

With ``whole``, as in the registered query and the pipeline's stage, a second
word check is added: the share of a language's ``LISTED_WORDS`` commonest
words of any length among a text's runs of letters. Its cut is a share of the
distance that a text without any of them has from the same reference, so such
texts and those of another language are rejected however little of the
reference the list holds.

Defined cases: a null text counts as empty and fails the base rules; documents
with a null ``lang`` form a language of their own; equal rows are judged alike,
one result row each; an empty table gives an empty result; other columns are
ignored by ``judge``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinlens.llm.common import let, whole_text, words
from twinlens.session import materialize

#: Fixed values of the base rules.
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
#: Parameters of the divergence rules.
COMMON_WORDS = 16
SHORT_CHARS = 3
MIN_CHARS_FOR_CLASSES = 100
MIN_WORDS_FOR_COMMON = 50
MAX_CLASS_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.40
#: Parameters of the check against the longer list: words, buckets of their hashes, the part of the
#: reachable distance that rejects, and how many listed words the reference must lead one to expect.
LISTED_WORDS = 300
BUCKETS = 512
MAX_OF_REACH = 0.5
MIN_EXPECTED = 20
CLASSES = ["lower", "upper", "digit", "space", "mark", "symbol", "other"]


def word_references(docs: DataFrame, k: int = COMMON_WORDS) -> DataFrame:
    """``(ref_lang, common)``: hashes of the k commonest short words of each language.

    Short words carry a language's grammar; their counts stay small however
    large the corpus. One row per language with at most k hashes; ties go to
    the word that sorts first.
    """
    counted = (docs.select(F.col("lang").alias("ref_lang"),
                           F.filter(words(whole_text("text")), lambda x: F.char_length(x) <= SHORT_CHARS).alias("w"))
               .select("ref_lang", F.explode("w").alias("w"))
               .groupBy("ref_lang", "w").agg(F.count(F.lit(1)).alias("n")))
    rank = F.row_number().over(Window.partitionBy("ref_lang").orderBy(F.desc("n"), "w"))
    return (counted.withColumn("r", rank).where(F.col("r") <= k)
            .groupBy("ref_lang").agg(F.sort_array(F.collect_list(F.struct("r", F.xxhash64("w").alias("h")))).alias("c"))
            .select("ref_lang", F.col("c.h").alias("common")))


def letter_words(text: Column) -> Column:
    """Maximal runs of letters, lower-cased: punctuation, case and table rules don't hide a word."""
    return F.array_remove(F.split(F.lower(text), r"\P{L}+"), "")


def word_lists(docs: DataFrame, k: int = LISTED_WORDS) -> DataFrame:
    """``(ref_lang, listed)``: the hashes of the k words that most documents of a language have, in ``BUCKETS`` by hash.

    Documents are counted, not uses: a few texts labelled with a wrong language
    can't bring their own words into its list. Only k words of a language leave each task for the ranking; ties go to the
    word that sorts first.
    """
    counted = (docs.select(F.col("lang").alias("ref_lang"),
                       F.explode(F.array_distinct(letter_words(whole_text("text")))).alias("w"))
               .groupBy("ref_lang", "w").agg(F.count(F.lit(1)).alias("n")))
    rank = F.row_number().over(Window.partitionBy("ref_lang").orderBy(F.desc("n"), "w"))
    lists = (counted.withColumn("r", rank).where(F.col("r") <= k)
             .groupBy("ref_lang").agg(F.collect_set(F.xxhash64("w")).alias("c")))
    return lists.select("ref_lang", F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda b: F.filter(
        "c", lambda h: F.pmod(h, F.lit(BUCKETS)) == b)).alias("listed"))


def repeated_words(hashes: Column) -> Column:
    """How many words lie in windows found twice or more, from the words' hashes.

    Window hashes are packed with their position into one long each (the low
    bits hold the position, as many as the text needs), so that one sort of
    longs puts equal windows side by side. Neighbours are compared by their
    whole hash. Texts without a repeated window stop before the sort.
    """
    def spots(wins: Column, bits: Column) -> Column:
        low = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1

        def at(x: Column) -> Column:
            return F.get(wins, x.bitwiseAND(low).cast("int"))

        def found(packed: Column) -> Column:
            def near(x: Column, other: Column) -> Column:
                high = F.call_function("shiftright", x, bits) == F.call_function("shiftright", other, bits)
                return F.coalesce(high & (at(x) == at(other)), F.lit(False))

            hit = F.filter(packed, lambda x, i: F.when(i > 0, near(x, F.get(packed, i - 1))).otherwise(False)
                           | near(x, F.get(packed, i + 1)))
            return F.sort_array(F.transform(hit, lambda x: x.bitwiseAND(low)))

        keys = F.transform(wins, lambda h, i: F.call_function(
            "shiftleft", F.call_function("shiftright", h, bits), bits).bitwiseOR(i.cast("long")))
        return let(F.sort_array(keys), found)

    def covered(p: Column) -> Column:
        steps = F.aggregate(F.sequence(F.lit(1), F.size(p) - 1), F.lit(0).cast("long"), lambda s, i: s + F.least(
            F.lit(WINDOW).cast("long"), F.get(p, i) - F.get(p, i - 1)))
        return F.when(F.size(p) > 1, steps + WINDOW).otherwise(0)

    def count(wins: Column) -> Column:
        bits = F.length(F.bin(F.size(wins)))
        return F.when(F.size(F.array_distinct(wins)) == F.size(wins), 0).otherwise(
            let(bits, lambda b: let(spots(wins, b), covered)))

    wins = F.transform(F.sequence(F.lit(0), F.size(hashes) - WINDOW), lambda i: F.xxhash64(
        *[F.get(hashes, i + j) for j in range(WINDOW)]))
    return F.when(F.size(hashes) <= WINDOW, 0).otherwise(let(wins, count)).cast("long")


def measure(docs: DataFrame, refs: DataFrame, keep: list[str]) -> DataFrame:
    """Counts per document: the base columns, character classes, common words.

    ``refs`` is ``word_references``; where it has ``listed`` of ``word_lists``,
    letter words and listed ones are counted too. Columns named in ``keep`` are carried along
    in the struct ``row``, where their names can't clash.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    df = docs.select(row, F.col("lang").alias("_lang"), whole_text("text").alias("t"))
    df = df.join(refs, F.col("_lang").eqNullSafe(F.col("ref_lang")), "left").drop("ref_lang")
    df = df.withColumn("w", words(F.col("t")))

    def from_common(hs: Column) -> Column:
        return F.struct(*[F.when(F.size("common") > k, F.size(hs) - F.size(F.array_remove(hs, F.get("common", F.lit(k)))))
                          .otherwise(0).cast("long").alias(f"w{k}") for k in range(COMMON_WORDS)])

    def from_hashes(hs: Column) -> Column:
        # one walk leaves the common words, the counts of each need only those
        common = F.filter(hs, lambda h: F.array_contains("common", h))
        return F.struct(repeated_words(hs).alias("n_repeat_words"), let(common, from_common).alias("hits"))

    def from_letter_words(ws: Column) -> Column:
        hit = F.filter(F.transform(ws, lambda x: F.xxhash64(x)), lambda h: F.array_contains(
            F.get("listed", F.pmod(h, F.lit(BUCKETS)).cast("int")), h))
        return F.struct(F.size(ws).cast("long").alias("n_letter_words"), F.size(hit).cast("long").alias("n_listed"))

    more = [let(letter_words(F.col("t")), from_letter_words).alias("l")] if "listed" in refs.columns else []
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.select(
        "row", "_lang", F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.char_length("t").cast("long").alias("n_chars"),
        # what is neither a lower-case letter nor a separator is short in prose
        F.regexp_replace("t", r"[a-z\x20\x09-\x0D\p{Ll}]+", "").alias("rest"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        let(F.transform("w", lambda x: F.xxhash64(x)), from_hashes).alias("h"), *more)

    def count(cls: str) -> Column:
        return (F.char_length("rest") - F.char_length(F.regexp_replace("rest", cls, ""))).cast("long")

    df = df.select("*", F.char_length("rest").cast("long").alias("n_rest"), count(SYMBOLS + "+").alias("n_symbols"),
                   count(r"\p{Lu}+").alias("upper"), count(r"\p{Nd}+").alias("digit"),
                   count(r"[.,;:!?'\"()\-]+").alias("mark"))
    return df.select(
        "row", "_lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "h.n_repeat_words", "h.hits.*",
        (F.col("word_chars") - F.col("n_rest")).alias("lower"), "upper", "digit",
        (F.col("n_chars") - F.col("word_chars")).alias("space"), "mark", F.col("n_symbols").alias("symbol"),
        *["l.*" for _ in more],
        (F.col("n_rest") - F.col("upper") - F.col("digit") - F.col("mark") - F.col("n_symbols")).alias("other"))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two arrays of shares."""
    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    terms = F.zip_with(p, q, lambda x, y: part(x, (x + y) / 2) + part(y, (x + y) / 2))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2, F.lit(0.0)))


def judge(docs: DataFrame, keep: list[str], max_class: float = MAX_CLASS_DISTANCE,
          max_word: float = MAX_WORD_DISTANCE, whole: bool = False) -> DataFrame:
    """Per document the base counts, both distances, ``base_failed`` and ``kept``.

    ``docs`` has ``text`` and ``lang``; the columns named in
    ``keep`` are returned in the struct ``row``.
    A distance is null (and rejects nothing) below its minimum length.
    With ``whole``, ``kept`` also asks for the language's listed words, and
    ``listed_distance`` and ``listed_reach`` (that of a text without any) are added.
    """
    # references are written out: their size is known then, and texts need not be shuffled to meet a small table
    refs = materialize(word_references(docs), "word-references")
    if whole:
        lists = materialize(word_lists(docs), "word-lists").withColumnRenamed("ref_lang", "list_lang")
        refs = materialize(lists.join(refs, F.col("list_lang").eqNullSafe(F.col("ref_lang")), "full").select(
            F.coalesce("list_lang", "ref_lang").alias("ref_lang"), "common", "listed"), "word-references")
    m = materialize(measure(docs, refs, keep), "divergence")
    common = [f"w{k}" for k in range(COMMON_WORDS)]
    ref = m.groupBy(F.col("_lang").alias("ref_lang")).agg(
        *[F.sum(c).alias(f"r_{c}") for c in [*CLASSES, *common, "n_words", *(["n_letter_words", "n_listed"] if whole else [])]])
    ref = materialize(ref, "class-references")
    df = m.join(ref, F.col("_lang").eqNullSafe(F.col("ref_lang")), "left")
    chars = reduce(lambda a, b: a + b, [F.col(c) for c in CLASSES])
    ref_chars = reduce(lambda a, b: a + b, [F.col(f"r_{c}") for c in CLASSES])
    d_class = js_distance(F.array(*[F.col(c) / chars for c in CLASSES]),
                          F.array(*[F.col(f"r_{c}") / ref_chars for c in CLASSES]))

    def shares(pre: str) -> Column:
        n = F.col(f"{pre}n_words")
        rest = n - reduce(lambda a, b: a + b, [F.col(pre + c) for c in common])
        return F.array(*[F.col(pre + c) / n for c in common], rest / n)

    df = (df.withColumn("class_distance", F.when(chars >= MIN_CHARS_FOR_CLASSES, d_class))
          .withColumn("word_distance", F.when(F.col("n_words") >= MIN_WORDS_FOR_COMMON,
                                              js_distance(shares(""), shares("r_")))))
    failed = ((F.col("n_words") < MIN_WORDS)
              | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    far = (F.coalesce(F.col("class_distance"), F.lit(0.0)) > max_class) | (
        F.coalesce(F.col("word_distance"), F.lit(0.0)) > max_word)
    more = []
    if whole:
        own = F.try_divide("n_listed", "n_letter_words")
        usual = F.try_divide("r_n_listed", "r_n_letter_words")
        enough = (F.col("n_letter_words") >= MIN_WORDS_FOR_COMMON) & (F.col("n_letter_words") * usual >= MIN_EXPECTED)
        more = ["listed_distance", "listed_reach"]
        df = (df.withColumn("listed_distance", F.when(enough, js_distance(
                  F.array(own, 1 - own), F.array(usual, 1 - usual))))
              .withColumn("listed_reach", F.when(enough, js_distance(
                  F.array(F.lit(0.0), F.lit(1.0)), F.array(usual, 1 - usual)))))
        far = far | F.coalesce((own < usual) & (F.col("listed_distance") > MAX_OF_REACH * F.col("listed_reach")),
                               F.lit(False))
    return df.select("row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                     failed.alias("base_failed"), (~failed & ~far).alias("kept"),
                     "class_distance", "word_distance", *more)
