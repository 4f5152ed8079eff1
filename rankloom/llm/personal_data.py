"""Personal data by bootstrapped contextual extraction, in DataFrame operations only.

Fixed formats (e-mail, IPv4, card number with Luhn digit, international phone number)
find the base spans; their texts are the seeds. Every seed and every other candidate,
a token with ``@`` or a group of digits, stands in a context: the word before, the word
after, and both. Contexts are patterns. Patterns and the distinct candidates seen in
them form a graph that is scored in rounds, until nothing new is found: a pattern is worth the share of its
candidates that are known for a kind, a candidate is worth the chance that at least
one of its trusted patterns is right. Patterns that are backed by enough known
candidates and worth enough find identifiers the formats miss. They only add spans:
the kind must fit the candidate's form, and the span must not touch a base span.

Offsets are code points, the end is exclusive. Null text is empty. A text may hold any
number of spans; starts are summed in blocks and candidates find the spans they touch by
halving, so a long text stays near linear. A neighbouring word is looked for among the
CONTEXT_CHARS characters beside a span. Equal worths go to the kind that sorts last. Repeated
rows are judged one by one and count once in the graph. An empty table gives no rows.
Further columns are not read.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.common import ROW, numbered, query, rows_with, table, without_ids
from rankloom.session import cut_lineage

KINDS = ["email", "ip", "card", "phone"]
#: Same matches as the plain formats: runs are taken whole (nothing that follows could use a part
#: of them) and start where a run starts or the last match ended, so long runs cost no second look.
FORMATS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold for a format to be worth looking for.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
CANDIDATE = r"(?<![^\s@])[^\s@]++@[^\s@]++|\(?[0-9](?:[ ().-]{0,2}[0-9])*+"

#: Up to so many spans of a kind in a text, a candidate is held against each of them.
FEW = 16
#: A pattern is trusted when so many known candidates back it …
SUPPORT = 3.0
#: … and it is worth at least this; a candidate is taken at the same worth.
WORTH = 0.7
CONTEXT_CHARS = 60
BLOCK = 64

_SPAN = "struct<start:bigint,end:bigint,text:string,before:string,after:string>"


def sums_before(steps: Column) -> Column:
    """For every element the sum of those before it."""
    nothing = F.array().cast("array<bigint>")

    def in_block(b: Column, base: Column) -> Column:
        return F.aggregate(
            F.slice(steps, b * BLOCK + 1, F.lit(BLOCK)),
            F.struct(base.alias("t"), nothing.alias("o")),
            lambda a, v: F.struct((a["t"] + v).alias("t"), F.concat(a["o"], F.array(a["t"])).alias("o")),
        )

    blocks = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / BLOCK).cast("int"))
    totals = F.transform(blocks, lambda b: F.aggregate(F.slice(steps, b * BLOCK + 1, F.lit(BLOCK)), F.lit(0).cast("bigint"), lambda a, v: a + v))
    # One base per block: few enough to append.
    bases = F.aggregate(
        totals,
        F.struct(F.lit(0).cast("bigint").alias("t"), nothing.alias("o")),
        lambda a, v: F.struct((a["t"] + v).alias("t"), F.concat(a["o"], F.array(a["t"])).alias("o")),
    )["o"]
    return F.flatten(F.transform(bases, lambda base, b: in_block(b, base)["o"]))


def _word(part: Column, side: str) -> Column:
    found = F.regexp_extract(part, r"(\S+)\s*$" if side == "before" else r"^\s*(\S+)", 1)
    return F.lower(F.regexp_replace(found, r"[^\p{L}\p{N}]", ""))


def with_spans(df: DataFrame, text: str, name: str, pattern: str, hint: str, shortest: int | None = None) -> DataFrame:
    """Add ``name``: the matches of a pattern with their places and neighbouring words, or,
    for matches of ``shortest`` characters at least, with the CONTEXT_CHARS characters of the
    text on either side, other matches among them."""
    found, gaps = F.col(f"_{name}_found"), F.col(f"_{name}_gaps")
    none = F.array().cast("array<string>")
    df = df.withColumn(f"_{name}_found", F.when(F.col(text).rlike(hint), F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn(f"_{name}_gaps", F.when(F.size(found) > 0, F.split(F.col(text), pattern, -1)).otherwise(none))
    # The start of match i is all gaps up to it and all matches before it.
    steps = F.transform(found, lambda m, i: (F.length(m) + F.length(F.get(gaps, i + 1))).cast("bigint"))
    df = df.withColumn(f"_{name}_at", F.when(F.size(found) > 0, sums_before(steps)).otherwise(F.array().cast("array<bigint>")))

    def around(i: Column) -> tuple[Column, Column]:
        # So many matches at most are among the characters; of each piece no more than those can count.
        reach = -(-CONTEXT_CHARS // shortest)
        near = F.sequence(F.lit(0), F.lit(2 * reach))

        def piece(n: Column, j: Column, cut) -> Column:
            return F.coalesce(F.when(j >= 0, cut(F.when(n % 2 == 0, F.get(gaps, j)).otherwise(F.get(found, j)), F.lit(CONTEXT_CHARS))), F.lit(""))

        # gap i - reach, match i - reach, ... gap i, and gap i + 1, match i + 1, ... gap i + 1 + reach.
        left = F.transform(near, lambda n: piece(n, i - reach + F.floor(n / 2).cast("int"), F.right))
        right = F.transform(near, lambda n: piece(n, i + 1 + F.floor(n / 2).cast("int"), F.left))
        return F.right(F.array_join(left, ""), F.lit(CONTEXT_CHARS)), F.left(F.array_join(right, ""), F.lit(CONTEXT_CHARS))

    def span(m: Column, i: Column) -> Column:
        start = F.get(F.col(f"_{name}_at"), i) + F.length(F.get(gaps, F.lit(0)))
        if shortest is None:
            before = _word(F.right(F.get(gaps, i), F.lit(CONTEXT_CHARS)), "before")
            after = _word(F.left(F.get(gaps, i + 1), F.lit(CONTEXT_CHARS)), "after")
        else:
            before, after = around(i)
        return F.struct(start.alias("start"), (start + F.length(m)).alias("end"), m.alias("text"), before.alias("before"), after.alias("after"))

    df = df.withColumn(name, F.transform(found, span).cast(f"array<{_SPAN}>"))
    return df.drop(f"_{name}_found", f"_{name}_gaps", f"_{name}_at")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _valid(kind: str):
    """Test of a match of the kind's format."""
    if kind == "ip":
        return lambda s: s["text"].rlike(r"^0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]?)(?:\.0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]?)){3}$")
    if kind == "card":
        return lambda s: F.length(_digits(s["text"])).between(13, 19) & F.call_function("luhn_check", _digits(s["text"]))
    if kind == "phone":
        return lambda s: F.length(_digits(s["text"])).between(9, 15)
    return lambda s: F.lit(True)


def _fits(kind: Column, text: Column) -> Column:
    """Whether a candidate has a form that its kind may take."""
    n = F.length(_digits(text))
    at = text.contains("@")
    return (
        ((kind == "email") & at)
        | ((kind == "ip") & text.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"))
        | ((kind == "card") & ~at & n.between(12, 19))
        | ((kind == "phone") & ~at & n.between(7, 15) & ~text.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"))
    )


def touches(spans: str, c: Column) -> Column:
    """Whether one of some spans, in order and apart from each other, shares a place with ``c``.

    Few spans are tried in turn. Of many, halving finds the last that starts before the
    end of ``c``, the one with the greatest end among those.
    """
    a = F.col(spans)
    starts_before = lambda i: F.get(a, i)["start"] < c["end"]
    middle = lambda s: F.shiftright(s["lo"] + s["hi"], 1)
    halved = F.aggregate(
        F.sequence(F.lit(0), F.ceil(F.log2(F.size(a) + F.lit(1.0))).cast("int")),
        F.struct(F.lit(0).alias("lo"), F.size(a).alias("hi")),
        lambda s, _: F.when(s["lo"] >= s["hi"], s)
        .when(starts_before(middle(s)), F.struct((middle(s) + 1).alias("lo"), s["hi"].alias("hi")))
        .otherwise(F.struct(s["lo"].alias("lo"), middle(s).alias("hi"))),
        lambda s: F.when(s["lo"] > 0, F.get(a, s["lo"] - 1)["end"] > c["start"]).otherwise(F.lit(False)),
    )
    each = F.exists(a, lambda s: (s["start"] < c["end"]) & (c["start"] < s["end"]))
    return F.when(F.size(a) <= FEW, each).otherwise(halved)


def base_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written table: row number, id, hash of the text, spans by kind, other candidates."""
    df = docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    for kind in KINDS:
        df = with_spans(df, "_text", f"_{kind}", FORMATS[kind], HINTS[kind])
    df = with_spans(df, "_text", "_other", CANDIDATE, "[0-9@]")
    for kind in KINDS:
        df = df.withColumn(f"_{kind}", F.filter(f"_{kind}", _valid(kind)))
    clear = F.filter("_other", lambda c: ~reduce(or_, [touches(f"_{k}", c) for k in KINDS]))
    df = numbered(df.select(id_col, F.xxhash64("_text").alias("_text_hash"), *[F.col(f"_{k}").alias(k) for k in KINDS], clear.alias("other")))
    return cut_lineage(df)


def _contexts(kind: Column, s: Column) -> Column:
    both = F.when((s["before"] != "") & (s["after"] != ""), F.concat_ws(" ", F.lit("b"), s["before"], s["after"]))
    patterns = F.array(F.when(s["before"] != "", F.concat(F.lit("l "), s["before"])), F.when(s["after"] != "", F.concat(F.lit("r "), s["after"])), both)
    return F.struct(kind.alias("kind"), F.lower(s["text"]).alias("item"), F.array_compact(patterns).alias("patterns"))


def discovered(found: DataFrame, support: float = SUPPORT, worth: float = WORTH) -> DataFrame:
    """(item, kind) of candidates that trusted patterns reveal, as a written table.

    Only patterns with at least ``support`` distinct candidates can ever be trusted,
    so the graph is cut to them before the first round. Rounds go on until one takes no
    candidate that was not known; a candidate once taken stays, with its kind and its
    highest worth, so that they come to an end.
    """
    def in_context(kind: str | None):
        return lambda s: _contexts(F.lit(kind).cast("string"), s)

    seen = F.concat(*[F.transform(k, in_context(k)) for k in KINDS], F.transform("other", in_context(None)))
    met = found.select(F.explode(seen).alias("m")).select("m.kind", "m.item", "m.patterns").distinct()
    met = cut_lineage(met)
    seeds = cut_lineage(met.filter("kind is not null").select("item", "kind").distinct())
    edges = met.select(F.explode("patterns").alias("pattern"), "item").distinct()
    wide = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= support)
    edges = cut_lineage(edges.join(wide, "pattern"))
    known = seeds.withColumn("score", F.lit(1.0))
    new, taken = known.limit(0), 0
    while True:
        backing = edges.join(known, "item").groupBy("pattern", "kind").agg(F.sum("score").alias("backed"), F.first("n").alias("n"))
        trusted = backing.withColumn("worth", F.col("backed") / (F.col("n") + 1)).filter((F.col("backed") >= support) & (F.col("worth") >= worth))
        trusted = cut_lineage(trusted.select("pattern", "kind", "worth"))
        doubt = F.exp(F.sum(F.log(1 - F.col("worth"))))
        reached = edges.join(trusted, "pattern").filter(_fits(F.col("kind"), F.col("item"))).groupBy("item", "kind").agg((1 - doubt).alias("score"))
        # A candidate is of one kind: the one it was taken for, else the one it is worth most for.
        told = reached.join(seeds.select("item").distinct(), "item", "left_anti").filter(F.col("score") >= worth).withColumn("old", F.lit(False))
        every = told.unionByName(new.withColumn("old", F.lit(True)))
        kind = F.coalesce(F.max(F.when(F.col("old"), F.col("kind"))), F.max_by("kind", F.struct("score", "kind")))
        chosen = every.groupBy("item").agg(kind.alias("kind"), F.collect_set(F.struct("kind", "score")).alias("all"))
        score = F.array_max(F.transform(F.filter("all", lambda s: s["kind"] == F.col("kind")), lambda s: s["score"]))
        new = cut_lineage(chosen.select("item", "kind", score.alias("score")))
        before, taken = taken, new.count()
        if taken == before:
            return new.select("item", "kind")
        known = seeds.withColumn("score", F.lit(1.0)).unionByName(new)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: ``base`` and ``spans``, arrays of (kind, start, end, text)
    in the order of KINDS and starts, and ``_text_hash``."""
    found = base_spans(docs, id_col, text_col)
    others = found.select(ROW, F.explode("other").alias("s")).withColumn("item", F.lower("s.text"))
    extra = others.join(discovered(found), "item").select(ROW, F.struct("kind", "s.start", "s.end", "s.text").alias("s"))
    extra = extra.groupBy(ROW).agg(F.collect_list("s").alias("extra"))

    def plain(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["text"].alias("text")))

    def of(kind: str):
        return lambda s: s["kind"] == kind

    base = F.concat(*[plain(k) for k in KINDS])
    more = F.coalesce(F.col("extra"), F.array().cast("array<struct<kind:string,start:bigint,end:bigint,text:string>>"))
    by_start = lambda a: F.array_sort(a, lambda x, y: F.when(x["start"] < y["start"], -1).when(x["start"] > y["start"], 1).otherwise(0))
    all_ = F.concat(*[by_start(F.concat(plain(k), F.filter(more, of(k)))) for k in KINDS])
    return found.join(extra, ROW, "left").select(id_col, "_text_hash", base.alias("base"), all_.alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """Documents with every span replaced by its kind in brackets; ``n_chars`` follows."""
    found = personal_data(docs).filter(F.size("spans") > 0).select("doc_id", "_text_hash", "spans")
    found = cut_lineage(found.groupBy("doc_id", "_text_hash").agg(F.first("spans").alias("spans")))
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    text = F.col("_row.text")
    joined = F.aggregate(
        ordered,
        F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out")),
        lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(s["start"] < a["at"], a["out"])
            .otherwise(F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit("["), F.upper(s["kind"]), F.lit("]")))
            .alias("out"),
        ),
        lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))),
    )
    mine = found.select(F.col("doc_id").alias("_id"), F.col("_text_hash").alias("_hash"), "spans")
    # Rows are packed, so that no column of theirs meets one of the join.
    dirty = rows_with(docs, found).select(F.struct("*").alias("_row"), F.col("doc_id").alias("_doc"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_own"))
    dirty = dirty.join(mine, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_hash")), "left")
    changed = {"text": F.when(F.col("spans").isNull(), text).otherwise(joined)}
    dirty = dirty.withColumn("_clean", changed["text"])
    changed["text"] = F.col("_clean")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("spans").isNull(), F.col("_row.n_chars")).otherwise(F.length("_clean").cast(kind))
    return without_ids(docs, found).unionByName(dirty.select(*[changed.get(c, F.col("_row")[c]).alias(c) for c in docs.columns]))


def digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query("op1_personal_data")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(digest(F.col("base")), 256).alias("base_sha256"),
        digest(F.col("spans")).alias("spans"),
    )
