"""Text expressions: cleaning, tokens, n-grams, readability, redaction.

Everything here is a Column expression, so the whole chain stays inside one
projection next to the scan. Patterns keep to the syntax that Java and RE2
read alike.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions import wordlists as W

# Fixed patterns of the cleaning chain, in order: (pattern, replacement).
CLEAN_STEPS = [
    (r"http\S+\s*", " "),
    (r"RT|cc", " "),
    (r"#\S+", ""),
    (r"@\S+", "  "),
    (r"[!-/:-@\[-`{-~]", " "),
    (r"[^\x00-\x7f]", " "),
    (r"\s+", " "),
]
# Contractions that the tokeniser cuts in two.
TOKEN_SPLITS = {"cannot": "can not", "gonna": "gon na", "gotta": "got ta", "wanna": "wan na", "gimme": "gim me", "lemme": "lem me"}

# Everything Python's str.split() treats as white space.
WHITE_SET = r"\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WHITE = f"[{WHITE_SET}]+"
# The same set under Unicode classes, which Java matches several times faster.
NOT_WHITE = r"(?U)[^\s\x1C-\x1F]+"
WORD2 = r"[a-z0-9_]{2,}"
SENTENCE_END = r"[.!?]+"
VOWELS = r"[aeiouy]+"
# Letters of any script versus everything else, for whole-word replacement.
LETTER_RUN = r"[A-Za-z\x{C0}-\x{24F}]+|[^A-Za-z\x{C0}-\x{24F}]+"

# Fixed redaction patterns, applied in this order.
PII_PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("profile", r"(https?://)?(www\.)?(linkedin\.com|github\.com)/[A-Za-z0-9_/.-]+"),
    ("url", r"(https?://|www\.)[^\s<>]+"),
    ("phone", r"\+?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-][0-9]{4}"),
]


def scrub(text: Column) -> Column:
    """The regex part of cleaning, ending in lower case."""
    chained = reduce(lambda c, step: F.regexp_replace(c, step[0], step[1]), CLEAN_STEPS, text)
    return F.lower(chained)


def scrubbed_tokens(text: Column) -> Column:
    """Lower-case tokens of scrubbed text, contractions cut."""
    cut = F.create_map(*[F.lit(x) for kv in TOKEN_SPLITS.items() for x in kv])
    raw = F.filter(F.split(scrub(text), " "), lambda t: t != "")
    return F.flatten(F.transform(raw, lambda t: F.split(F.coalesce(F.try_element_at(cut, t), t), " ")))


def drop_stop_words(tokens: Column, words=W.STOP_WORDS) -> Column:
    return F.filter(tokens, lambda t: ~t.isin(*words))


def lemma(token: Column, irregular=W.IRREGULAR_LEMMAS) -> Column:
    """Noun lemma by table, then by the first matching suffix rule."""
    table = F.create_map(*[F.lit(x) for kv in irregular.items() for x in kv])
    rules = F.when(F.length(token) <= 3, token)
    for ending, repl in W.LEMMA_SUFFIXES:
        rules = rules.when(
            token.endswith(ending), F.concat(F.left(token, F.length(token) - len(ending)), F.lit(repl))
        )
    keep = reduce(lambda a, b: a | b, [token.endswith(e) for e in W.LEMMA_KEEP])
    rules = rules.when(token.endswith("s") & ~keep, F.left(token, F.length(token) - 1)).otherwise(token)
    return F.coalesce(F.try_element_at(table, token), rules)


def clean_text(text: Column, lemmatise: bool = True, stop_words=W.STOP_WORDS) -> Column:
    """Scrub, tokenise, drop stop words, optionally lemmatise, join with blanks."""
    tokens = drop_stop_words(scrubbed_tokens(text), stop_words)
    if lemmatise:
        tokens = F.transform(tokens, lambda t: lemma(t))
    return F.array_join(tokens, " ")


def split_words(text: Column) -> Column:
    """White-space tokens, no empty ones."""
    return F.filter(F.split(text, WHITE), lambda t: t != "")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(NOT_WHITE)).cast("bigint")


def word_tokens(text: Column, stop_words=()) -> Column:
    """Lower-case runs of two or more word characters, stop words removed."""
    tokens = F.regexp_extract_all(F.lower(text), F.lit(WORD2), F.lit(0))
    return drop_stop_words(tokens, stop_words) if stop_words else tokens


def ngrams(tokens: Column, lo: int, hi: int) -> Column:
    """All n-grams for n in lo..hi as blank-joined strings, repeats kept."""
    parts = []
    for n in range(lo, hi + 1):
        if n == 1:
            parts.append(tokens)
            continue
        width = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
        grams = F.slice(tokens, F.lit(1), width)
        for k in range(1, n):
            tail = F.slice(tokens, F.lit(k + 1), width)
            grams = F.zip_with(grams, tail, lambda a, b: F.concat(a, F.lit(" "), b))
        parts.append(grams)
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def reading_ease(text: Column) -> Column:
    """Flesch reading ease on counted sentence ends and vowel groups; 0 for no words."""
    words = word_count(text)
    sentences = F.greatest(F.regexp_count(text, F.lit(SENTENCE_END)), F.lit(1))
    syllables = F.regexp_count(F.lower(text), F.lit(VOWELS))
    score = F.lit(206.835) - F.lit(1.015) * (words / sentences) - F.lit(84.6) * F.try_divide(syllables, words)
    return F.coalesce(score, F.lit(0.0))


def redact(text: Column) -> Column:
    """Replace e-mail, profile links, other links and phone numbers."""
    return reduce(lambda c, kp: F.regexp_replace(c, kp[1], "\\[REDACTED\\]"), PII_PATTERNS, text)


def redaction_counts(text: Column) -> dict[str, Column]:
    """How many of each kind :func:`redact` replaces, counted in its order."""
    out, rest = {}, text
    for kind, pattern in PII_PATTERNS:
        out[f"n_{kind}"] = F.regexp_count(rest, F.lit(pattern)).cast("bigint")
        rest = F.regexp_replace(rest, pattern, "\\[REDACTED\\]")
    return out


def pronoun_table() -> dict[str, str]:
    table = {}
    for old, new in W.NEUTRAL_PRONOUNS.items():
        table[old], table[old.capitalize()], table[old.upper()] = new, new.capitalize(), new.upper()
    return table


def neutral_pronouns(text: Column) -> Column:
    """Swap gendered pronouns for neutral ones, whole words only, case kept."""
    table = pronoun_table()
    swap = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    pieces = F.regexp_extract_all(text, F.lit(LETTER_RUN), F.lit(0))
    return F.array_join(F.transform(pieces, lambda t: F.coalesce(F.try_element_at(swap, t), t)), "")


def html_text(html: Column) -> Column:
    """Readable text of a page: scripts, styles, comments and tags removed,
    the five basic entities decoded, white space collapsed."""
    steps = [
        (r"(?is)<script[^>]*>.*?</script>", " "),
        (r"(?is)<style[^>]*>.*?</style>", " "),
        (r"(?s)<!--.*?-->", " "),
        (r"<[^>]+>", " "),
        ("&nbsp;", " "),
        ("&lt;", "<"),
        ("&gt;", ">"),
        ("&quot;", '"'),
        ("&#39;", "'"),
        ("&amp;", "&"),
        (r"\s+", " "),
    ]
    return F.trim(reduce(lambda c, s: F.regexp_replace(c, s[0], s[1]), steps, html))


def title_case_name(filename: Column, fallback: Column) -> Column:
    """Candidate name from a file name: extension off, ``_`` and ``-`` to blanks,
    every word capitalised; the fallback where nothing is left."""
    stem = F.regexp_replace(filename, r"\.[^.]*$", "")
    name = F.initcap(F.trim(F.regexp_replace(stem, "[_-]", " ")))
    return F.coalesce(F.nullif(name, F.lit("")), fallback.cast("string"))


def month_of(text: Column, default: str) -> Column:
    """ISO date text to ``yyyy-MM``; the default where it is not an ISO date."""
    iso = text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?(Z|[+-][0-9]{2}:[0-9]{2})?)?$")
    # The offset never moves the printed month, so only the date part is read.
    day = F.when(iso, F.left(text, F.lit(10)).try_cast("date"))
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit(default))


def split_sections(df: DataFrame, text: str, headings=W.SECTION_HEADINGS) -> DataFrame:
    """Add one column per CV section, cut at heading lines.

    Heading lines become markers, the text is split at the markers once, and
    each section joins its own pieces: linear in the text, no shuffle and no
    window. Text before the first heading counts as ``misc``.
    """
    # Doubling the newlines gives every line its own pair of delimiters.
    lines = F.replace(F.replace(F.col(text), F.lit("\r"), F.lit("")), F.lit("\n"), F.lit("\n\n"))
    lines = F.concat(F.lit("\n"), lines, F.lit("\n"))
    for name, words in headings.items():
        lines = F.regexp_replace(lines, rf"(?i)\n[ \t]*({words})[ \t]*:?[ \t]*\n", f"\u0001{name}\u0002")
    chunks = F.split(F.concat(F.lit("misc\u0002"), lines), "\u0001")

    def body(name: str) -> Column:
        own = F.filter("_chunks", lambda c: c.startswith(f"{name}\u0002"))
        texts = F.transform(own, lambda c: F.replace(F.substring_index(c, "\u0002", -1), F.lit("\n\n"), F.lit("\n")))
        # White space at the edges of a piece belongs to the cut, not to the text.
        texts = F.transform(texts, lambda c: F.regexp_replace(c, r"^\s+|\s+$", ""))
        return F.array_join(F.filter(texts, lambda c: c != ""), "\n").alias(name)

    return df.withColumn("_chunks", chunks).select(*df.columns, *[body(n) for n in headings])


def with_tokens(df: DataFrame, text: str, out: str = "tokens", stop_words=(), clean: bool = True, lemmatise: bool = True) -> DataFrame:
    """Add the word tokens of a text as a column of its own: an expression used more
    than once inside lambdas would be computed each time."""
    source = clean_text(F.col(text), lemmatise) if clean else F.col(text)
    return df.withColumn(out, word_tokens(source, stop_words))
