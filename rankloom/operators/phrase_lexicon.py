"""Multi-word lexicon terms in texts: search, entity lists and redaction.

Texts are cut into words and what lies between them. A phrase matches words that follow
each other with nothing but blanks, line ends or hyphens between them, in any case.

A position is kept only if its word starts a phrase, and is then compared once for every
length that phrases with this first word have. So one frequent first word with many
phrases does not multiply rows: a position meets a lexicon row by equality of the whole
phrase. Work is linear in the words of a text, whatever the size of the lexicon.

A null or empty text has no matches; a null or wordless phrase is left out, equal rows of
the lexicon count once. Keys of the documents are unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.operators.spread import lookup_join

PIECES = "[A-Za-z0-9_]+|[^A-Za-z0-9_]+"
WORD_START = "^[A-Za-z0-9_]"
SOFT_GAP = r"^[ \t\r\n-]+$"
HARD = "\u0001"
MARK = "[REDACTED]"


def pieces(text: Column) -> Column:
    """Words and gaps in turn; joined they give the text again."""
    return F.regexp_extract_all(text, F.lit(PIECES), F.lit(0))


def folded(cut: Column) -> Column:
    """Pieces in lower case, a blank for a gap that a phrase may span, a mark for any other."""
    return F.transform(cut, lambda p: F.when(p.rlike(WORD_START), F.lower(p)).when(p.rlike(SOFT_GAP), " ").otherwise(HARD))


def normal_phrase(phrase: Column) -> Column:
    """Lower-case words joined by single blanks."""
    return F.array_join(F.filter(folded(pieces(phrase)), lambda p: p.rlike(WORD_START)), " ")


def normal_lexicon(lexicon: DataFrame) -> DataFrame:
    """``phrase``, ``kind`` and ``n_words`` of every different term."""
    rows = lexicon.select(normal_phrase(F.col("phrase")).alias("phrase"), "kind").filter("phrase <> ''").distinct()
    return rows.withColumn("n_words", F.size(F.split("phrase", " ")))


def phrase_spans(docs: DataFrame, key: str, text: Column, lexicon: DataFrame) -> DataFrame:
    """Every occurrence of a term: ``key``, ``start`` and ``end`` (places among the pieces,
    end exclusive), ``phrase``, ``kind``. Overlapping occurrences are all there."""
    terms = normal_lexicon(lexicon)
    longest = terms.agg(F.max("n_words")).first()[0] or 1
    firsts = terms.groupBy(F.substring_index("phrase", " ", 1).alias("_first")).agg(F.collect_set("n_words").alias("_lengths"))
    cut = docs.select(F.col(key), folded(pieces(text)).alias("_cut"))
    # A position carries the words it may need, and not the text.
    ahead = F.transform(
        "_cut",
        lambda p, i: F.struct(
            i.alias("start"),
            p.alias("first"),
            F.substring_index(F.array_join(F.slice("_cut", i + 1, 2 * longest - 1), ""), HARD, 1).alias("ahead"),
        ),
    )
    places = cut.select(key, F.explode(F.filter(ahead, lambda s: s["first"].rlike(WORD_START))).alias("_p"))
    places = places.select(key, F.col("_p.start").alias("start"), F.col("_p.first").alias("_first"), F.col("_p.ahead").alias("_ahead"))
    tried = lookup_join(places, firsts, ["_first"]).select(key, "start", "_ahead", F.explode("_lengths").alias("n_words"))
    # A rest that is too short stays whole, and has then fewer words than the term.
    tried = tried.select(key, "start", "n_words", F.expr("substring_index(_ahead, ' ', n_words)").alias("phrase"))
    found = lookup_join(tried, terms, ["phrase", "n_words"])
    return found.select(key, "start", (F.col("start") + 2 * F.col("n_words") - 1).alias("end"), "phrase", "kind")


def phrase_matches(docs: DataFrame, key: str, text: Column, lexicon: DataFrame, kinds: list[str] | None = None) -> DataFrame:
    """``docs`` with the sorted different terms of each text: an array per kind, or ``found``."""
    spans = phrase_spans(docs, key, text, lexicon).select(key, "phrase", "kind").distinct()
    wanted = {k.lower(): F.when(F.col("kind") == k, F.col("phrase")) for k in kinds} if kinds else {"found": F.col("phrase")}
    lists = spans.groupBy(key).agg(*[F.array_sort(F.collect_set(c)).alias(n) for n, c in wanted.items()])
    empty = F.array().cast("array<string>")
    kept = [c for c in docs.columns if c not in wanted]
    return docs.select(*kept).join(lists, key, "left").select(*kept, *[F.coalesce(F.col(n), empty).alias(n) for n in wanted])


def redact_phrases(docs: DataFrame, key: str, text: str, lexicon: DataFrame, kinds: list[str]) -> DataFrame:
    """``key``, ``redacted`` and the number of occurrences per kind.

    Overlapping occurrences become one mark that covers them all; each counts for its
    kind. Only occurrences are shuffled, never words; a null text stays null.
    """
    spans = phrase_spans(docs, key, F.col(text), lexicon.filter(F.col("kind").isin(*kinds)))
    order = Window.partitionBy(key).orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.withColumn("_opens", F.when(F.col("start") < reached, 0).otherwise(1))
    islands = opened.withColumn("_island", F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    marks = islands.groupBy(key, "_island").agg(
        F.struct(F.min("start").alias("start"), F.max("end").alias("end")).alias("_mark"),
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k.lower()}") for k in kinds],
    )
    counts = [f"n_{k.lower()}" for k in kinds]
    # One document's marks: no more than it has words.
    marks = marks.groupBy(key).agg(F.array_sort(F.collect_list("_mark")).alias("_marks"), *[F.sum(n).alias(n) for n in counts])
    both = docs.select(F.col(key), F.col(text).alias("_text")).join(marks, key, "left").withColumn("_cut", pieces(F.col("_text")))

    def kept(start: Column, end: Column) -> Column:
        return F.array_join(F.slice("_cut", start + 1, end - start), "")

    def before(m: Column, i: Column) -> Column:
        return F.concat(kept(F.coalesce(F.get("_marks", i - 1)["end"], F.lit(0)), m["start"]), F.lit(MARK))

    last = F.try_element_at("_marks", F.lit(-1))["end"]
    whole = F.concat(F.array_join(F.transform("_marks", before), ""), kept(last, F.size("_cut")))
    return both.select(
        key,
        F.when(F.col("_marks").isNull(), F.col("_text")).otherwise(whole).alias("redacted"),
        *[F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias(n) for n in counts],
    )
