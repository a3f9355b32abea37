"""Benchmark decontamination by a distributed positional inverted index.

Test texts are cut into windows of `size` words. A window can only occur where
its rarest words do, so the index stores postings (term, document, position) of
the two rarest terms of each window, with the words around a position. The
list of the rarest term, moved back by the term's offset, gives candidate
starts; it is intersected with the moved list of the second rarest; what is
left is compared word by word. Very frequent words are therefore neither
stored nor joined unless a window has nothing rarer.

The text is read twice: for term counts and for postings. Every document adds
one end mark to the postings, which gives its length without a third reading.

Defined cases: null or wordless texts have no words and no hits; a test item
without words is ignored, one without id marks words but is not listed; a
document without id is counted but never hit, as postings need an id. Postings
name a document by id and text, so rows that share an id only have hits of their
own, and rows that repeat both are treated alike. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rillmark.llm.common import bounded_broadcast, lower_ascii, saved

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
END = ""  # the term of a document's end mark; no word is empty
BROADCAST_ROWS = 500_000


def words_and_end(text: Column) -> Column:
    """Words in order, then END; a text that starts between words has one more END in front."""
    return F.split(F.concat(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(" ")), NOT_WORD)


def words(text: Column) -> Column:
    return F.filter(words_and_end(text), lambda w: w != END)


def windows(items: DataFrame, size: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item, phrase (its words): every window of each item; a shorter item is one window."""
    cut = items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("all"))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("all") - (size - 1)))
    return (
        cut.where(F.size("all") > 0)
        .select("item", "all", F.explode(starts).alias("at"))
        .select("item", F.slice("all", F.col("at"), size).alias("phrase"))
        .distinct()
    )


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc (id and a digest of the text; null without id), text."""
    text = F.col(text_col)
    digest = F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))
    named = F.struct(F.col(id_col).alias("id"), digest.alias("sum"))
    return docs.select(F.when(F.col(id_col).isNotNull(), named).alias("doc"), text.alias("text"))


def term_counts(docs: DataFrame, terms: DataFrame, n_terms: int, text_col: str = "text") -> DataFrame:
    """term, n: occurrences of each wanted term in all documents."""
    tokens = docs.select(F.explode(words_and_end(F.col(text_col))).alias("term"))
    if n_terms <= BROADCAST_ROWS:
        return tokens.join(F.broadcast(terms), "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return tokens.groupBy("term").agg(F.count(F.lit(1)).alias("n")).join(terms, "term")


def rarest(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """phrase with its rarest (a) and second rarest (b) term and their offsets; only phrases all of whose terms occur."""
    each = phrases.select("phrase", F.posexplode("phrase").alias("off", "term")).join(counts, "term")
    lists = each.groupBy("phrase").agg(F.sort_array(F.collect_list(F.struct("n", "off", "term"))).alias("by_n"))
    a, b = F.col("by_n")[0], F.get("by_n", F.lit(1))
    return lists.where(F.size("by_n") == F.size("phrase")).select(
        "phrase", a["term"].alias("a"), a["off"].alias("a_off"), b["term"].alias("b"), b["off"].alias("b_off"),
    )


def postings(
    docs: DataFrame, terms: DataFrame, n_terms: int, reach: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """term, doc, pos, around (words from pos - reach to pos + reach), from: where `around` starts; and END marks."""
    cut = docs.select(F.col(id_col).alias("doc"), words_and_end(F.col(text_col)).alias("ws"))
    lead = F.when((F.size("ws") > 1) & (F.col("ws")[0] == END), 1).otherwise(0)
    tokens = cut.select("doc", "ws", lead.alias("lead"), F.posexplode("ws").alias("at", "term"))
    left = F.greatest(F.col("lead"), F.col("at") - reach)
    columns = [
        "term", "doc", (F.col("at") - F.col("lead")).alias("pos"), (left - F.col("lead")).alias("from"),
        F.when(F.col("term") != END, F.slice("ws", left + 1, F.col("at") + reach + 1 - left)).alias("around"),
    ]
    marks = (F.col("term") != END) | (F.col("at") == F.size("ws") - 1)
    if n_terms <= BROADCAST_ROWS:
        return tokens.join(F.broadcast(terms), "term", "left_semi").where(marks).select(*columns)
    # Cut to the words around before the shuffle, so that no whole text is copied per word.
    return tokens.where(marks).select(*columns).join(terms, "term", "left_semi")


def phrase_matches(index: DataFrame, probes: DataFrame, n_probes: int) -> DataFrame:
    """phrase, doc, start: every exact occurrence, from the rarest term's list on."""
    probes = bounded_broadcast(probes, n_probes, BROADCAST_ROWS)
    first = index.join(probes, F.col("term") == F.col("a")).select(
        "phrase", "doc", "b", "b_off", "around", "from", (F.col("pos") - F.col("a_off")).alias("start")
    )
    second = index.select(F.col("term").alias("b"), "doc", F.col("pos").alias("b_pos"))
    both = first.where("b IS NOT NULL").withColumn("b_pos", F.col("start") + F.col("b_off")).join(
        second, ["b", "doc", "b_pos"], "left_semi"
    )
    found = both.select("phrase", "doc", "start", "around", "from").unionByName(
        first.where("b IS NULL").select("phrase", "doc", "start", "around", "from")
    )
    here = F.slice("around", F.col("start") - F.col("from") + 1, F.size("phrase"))
    return found.where(F.col("start") >= F.col("from")).where(here == F.col("phrase")).select("phrase", "doc", "start")


def proximity_matches(index: DataFrame, phrases: DataFrame, span: int) -> DataFrame:
    """phrase, doc, first, last: blocks of 2 x span words that hold all terms of a phrase, in any order.

    Blocks start at multiples of span, so terms within span words of each other
    always share one. `index` must hold the postings of all terms of `phrases`.
    Linear in the postings of those terms.
    """
    terms = phrases.select("phrase", F.explode(F.array_distinct("phrase")).alias("term"))
    block = F.floor(F.col("pos") / span)
    near = index.join(terms, "term").select(
        "phrase", "doc", "term", "pos", F.explode(F.array(block, block - 1)).alias("block")
    )
    return (
        near.groupBy("phrase", "doc", "block")
        .agg(F.count_distinct("term").alias("n"), F.min("pos").alias("first"), F.max("pos").alias("last"))
        .where(F.col("n") == F.size(F.array_distinct("phrase")))
        .select("phrase", "doc", "first", "last").distinct()
    )


def covered(matches: DataFrame) -> DataFrame:
    """doc, n_hit: words inside any match; overlaps count once."""
    spans = matches.select("doc", "start", (F.col("start") + F.size("phrase")).alias("end")).distinct()
    before = Window.partitionBy("doc").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    new_from = F.greatest(F.col("start"), F.coalesce(F.max("end").over(before), F.lit(0)))
    fresh = spans.withColumn("new", F.greatest(F.lit(0), F.col("end") - new_from))
    return fresh.groupBy("doc").agg(F.sum("new").cast("long").alias("n_hit"))


def decontaminate(
    docs: DataFrame, items: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items_sha256, contaminated."""
    spark = docs.sparkSession
    docs = keyed(docs, id_col, text_col)
    owned = saved(windows(items, size), "test-windows")
    phrases = owned.select("phrase").distinct()
    terms = saved(phrases.select(F.explode("phrase").alias("term")).distinct(), "test-terms")
    counts = saved(term_counts(docs, terms, terms.count()), "term-counts")
    probes = saved(rarest(phrases, counts), "probes")
    wanted = probes.select(F.explode(F.array("a", "b")).alias("term")).where("term IS NOT NULL").distinct()
    wanted = saved(wanted.unionByName(spark.range(1).select(F.lit(END).alias("term"))), "probe-terms")
    index = saved(postings(docs, wanted, wanted.count(), size - 1, "doc"), "postings")
    matches = saved(phrase_matches(index.where(F.col("term") != END), probes, probes.count()), "matches")
    named = matches.select("phrase", "doc").distinct().join(owned.where("item IS NOT NULL"), "phrase")
    listed = named.groupBy("doc").agg(F.sort_array(F.collect_set("item")).alias("items"))
    hits = covered(matches).join(listed, "doc", "left")
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    return index.where(F.col("term") == END).select("doc", "pos").join(hits, "doc", "left").select(
        F.col("doc.id").alias(id_col),
        F.col("pos").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items_of).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_of, ",").cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
