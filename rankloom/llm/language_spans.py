"""Language identification of mixed-language text.

Words are runs of letters in lower case. A language is learned as the frequency of
hashed letter groups of one to three letters, word edges included, and as the
scripts its words use. The script of a word narrows the languages that may claim it;
among those a word scores the log probability of its letter groups. Viterbi over the
words of a text, with a penalty for every change of language, labels spans. The
language of a text is the one with the most words; the score is its share of words.

Text that is null or has no letter, and any text when no language was learned, is
``und`` with score 0; digits and signs of any script are no letters. Ties go to the language that sorts first. Rows are judged one
by one, so repeated rows and ids do no harm; further columns are not read. An empty
table gives no rows. Texts are taken in parts of bounded size; a very long one is a part
of its own. The model's size is bounded by languages times hash slots.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.common import crc32_of, in_parts, list_column, mix, query, table

SLOTS = 1 << 15
SWITCH = 12.0
#: A language may claim words of a script that at least this share of its words uses.
SCRIPT_SHARE = 0.005
#: Least share of a text's words in its language for the filter.
LEAST_SHARE = 0.5
UNKNOWN = "und"
#: Words times languages that Viterbi holds at once, distinct words taken apart at once.
CELLS = 3_000_000
SLICE_WORDS = 20_000
#: Texts handled at once.
SLICE_TEXTS = 1_000

#: First code points of script ranges; a letter belongs to the last range that starts at or before it.
SCRIPTS = [
    (0x0000, "latin"),
    (0x0370, "greek"),
    (0x0400, "cyrillic"),
    (0x0530, "armenian"),
    (0x0590, "hebrew"),
    (0x0600, "arabic"),
    (0x0700, "other"),
    (0x0900, "devanagari"),
    (0x0980, "bengali"),
    (0x0A00, "other"),
    (0x0B80, "tamil"),
    (0x0C00, "other"),
    (0x0E00, "thai"),
    (0x0E80, "other"),
    (0x10A0, "georgian"),
    (0x1100, "hangul"),
    (0x1200, "other"),
    (0x1E00, "latin"),
    (0x1F00, "greek"),
    (0x2000, "other"),
    (0x2C60, "latin"),
    (0x2C80, "other"),
    (0x3040, "kana"),
    (0x3100, "other"),
    (0x3400, "han"),
    (0xA000, "other"),
    (0xA720, "latin"),
    (0xA800, "other"),
    (0xAC00, "hangul"),
    (0xD7B0, "other"),
    (0xF900, "han"),
    (0xFB00, "latin"),
    (0xFB13, "other"),
    (0x20000, "han"),
]
SCRIPT_STARTS = np.array([s for s, _ in SCRIPTS])
SCRIPT_NAMES = sorted({n for _, n in SCRIPTS})
SCRIPT_OF_RANGE = np.array([SCRIPT_NAMES.index(n) for _, n in SCRIPTS])

_WORD = regex.compile(r"\p{L}+")


def words_in(text: str) -> list[str]:
    """Words in lower case, as many as the text has before it is lowered."""
    lowered = text.lower()
    return _WORD.findall(lowered) if len(lowered) == len(text) else [w.lower() for w in _WORD.findall(text)]


def letter_groups(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slot of every letter group, number of groups of each word, script of each word)."""
    codes = np.frombuffer("".join([f"\n{w}\n" for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    edge = codes == 10
    opens = np.flatnonzero(edge)[::2]
    lengths = np.flatnonzero(edge)[1::2] - opens + 1
    letter = np.flatnonzero(~edge)
    groups = [(letter, mix(codes[letter] + np.uint64(1 << 40)))]
    pair = np.flatnonzero(~(edge[:-1] & edge[1:]))
    groups.append((pair, mix(mix(codes[pair] + np.uint64(2 << 40)) + codes[pair + 1])))
    three = np.flatnonzero(~(edge[:-2] & edge[1:-1]) & ~(edge[1:-1] & edge[2:]) & ~edge[1:-1])
    groups.append((three, mix(mix(mix(codes[three] + np.uint64(3 << 40)) + codes[three + 1]) + codes[three + 2])))
    at = np.concatenate([g[0] for g in groups])
    slot = (np.concatenate([g[1] for g in groups]) % np.uint64(SLOTS)).astype(np.int64)
    owner = np.searchsorted(opens, at, side="right") - 1
    order = np.argsort(owner, kind="stable")
    script = SCRIPT_OF_RANGE[np.searchsorted(SCRIPT_STARTS, codes[opens + 1].astype(np.int64), side="right") - 1]
    assert len(opens) == len(lengths)
    return slot[order], np.bincount(owner, minlength=len(words)), script


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(language, slot, times); scripts follow the slots."""
    size = SLOTS + len(SCRIPT_NAMES)
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        by: dict[str, Counter] = {}
        for at, to in in_parts(batch.column(0), SLICE_TEXTS):
            part = batch.slice(at, to - at)
            for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                by.setdefault(lang, Counter()).update(words_in(text))
        for lang, counter in by.items():
            words = list(counter)
            if not words:
                continue
            all_times = np.fromiter(counter.values(), np.int64, len(words))
            sums = totals.setdefault(lang, np.zeros(size, np.int64))
            for at in range(0, len(words), SLICE_WORDS):
                times = all_times[at : at + SLICE_WORDS]
                slot, sizes, script = letter_groups(words[at : at + SLICE_WORDS])
                sums[:SLOTS] += np.bincount(slot, weights=np.repeat(times, sizes), minlength=SLOTS).astype(np.int64)
                sums[SLOTS:] += np.bincount(script, weights=times, minlength=len(SCRIPT_NAMES)).astype(np.int64)
    for lang, sums in totals.items():
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(sums[at])], ["lang", "slot", "times"])


@dataclass
class Languages:
    names: list[str]
    log_p: np.ndarray  # slot x language
    allowed: np.ndarray  # script x language


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Languages:
    """Learn every language named in ``lang_col`` from all rows that have it and a text."""
    labelled = docs.select(F.col(text_col).cast("string"), F.col(lang_col).cast("string")).dropna()
    counted = labelled.mapInArrow(_count, "lang string, slot int, times bigint").groupBy("lang", "slot").agg(F.sum("times").alias("times"))
    rows = counted.toPandas()  # languages times slots at most
    names = sorted(rows["lang"].unique())
    counts = np.zeros((SLOTS + len(SCRIPT_NAMES), len(names)))
    counts[rows["slot"].to_numpy(np.int64), np.searchsorted(names, rows["lang"].to_numpy()) if names else np.zeros(0, np.int64)] = rows["times"].to_numpy()
    groups, scripts = counts[:SLOTS], counts[SLOTS:]
    log_p = np.log((groups + 0.5) / (groups.sum(axis=0) + 0.5 * SLOTS))
    allowed = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    allowed[~allowed.any(axis=1)] = True
    return Languages(names, log_p, allowed)


def word_scores(words: list[str], model: Languages) -> np.ndarray:
    """Word x language; the mean over the group lengths keeps a word's weight at its number of letters."""
    out = []
    for at in range(0, len(words), SLICE_WORDS):
        slot, sizes, script = letter_groups(words[at : at + SLICE_WORDS])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        scores = np.add.reduceat(model.log_p[slot], starts, axis=0) / 3
        scores = scores - scores.max(axis=1, keepdims=True)
        out.append(np.where(model.allowed[script], scores, -1e4).astype(np.float32))
    return np.concatenate(out)


def viterbi(ids: list[np.ndarray], scores: np.ndarray, switch: float = SWITCH) -> list[np.ndarray]:
    """Best language of every word; ``ids`` are the rows of ``scores`` of each text.

    Texts are taken longest first, so those that still have a word at a step are the
    first ones, and a step handles all of them at once.
    """
    langs = scores.shape[1]
    order = sorted(range(len(ids)), key=lambda i: -len(ids[i]))
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(ids)
    at = 0
    while at < len(order) and len(ids[order[at]]):
        longest = len(ids[order[at]])
        group = order[at : at + max(1, CELLS // (longest * langs))]
        at += len(group)
        lengths = np.array([len(ids[i]) for i in group])
        group, lengths = [g for g, n in zip(group, lengths) if n], lengths[lengths > 0]
        words = np.zeros((longest, len(group)), np.int64)
        for j, i in enumerate(group):
            words[: lengths[j], j] = ids[i]
        active = np.searchsorted(-lengths, -np.arange(longest), side="left")
        best = scores[words[0]].copy()
        moved = np.zeros((longest, len(group), langs), bool)
        source = np.zeros((longest, len(group)), np.int64)
        for t in range(1, longest):
            k = active[t]
            top = best[:k].argmax(axis=1)
            changed = best[np.arange(k), top][:, None] - switch
            moved[t, :k] = changed > best[:k]
            source[t, :k] = top
            best[:k] = np.maximum(best[:k], changed) + scores[words[t, :k]]
            if t % 64 == 0:  # only differences count
                best[:k] -= best[:k].max(axis=1, keepdims=True)
        labels = np.zeros((longest, len(group)), np.int64)
        now = best.argmax(axis=1)
        for t in range(longest - 1, -1, -1):
            k = active[t]
            labels[t, :k] = now[:k]
            if t:
                back = moved[t, np.arange(k), now[:k]]
                now[:k] = np.where(back, source[t, :k], now[:k])
        for j, i in enumerate(group):
            out[i] = labels[: lengths[j], j]
    return out


def _label(texts: list[str | None], model: Languages) -> list[tuple[str, float, np.ndarray]]:
    """(language, share of words, labels of the words) of each text."""
    known: dict[str, int] = {}
    ids = []
    for text in texts:
        found = words_in(text) if text and model.names else []
        ids.append(np.fromiter((known.setdefault(w, len(known)) for w in found), np.int64, len(found)))
    if not known:
        return [(UNKNOWN, 0.0, i) for i in ids]
    out = []
    for labels in viterbi(ids, word_scores(list(known), model)):
        if len(labels):
            counts = np.bincount(labels)
            out.append((model.names[int(counts.argmax())], float(counts.max() / len(labels)), labels))
        else:
            out.append((UNKNOWN, 0.0, labels))
    return out


def _spans(text: str, labels: np.ndarray, names: list[str]) -> list[dict]:
    """Character spans of one language; a span ends where the next begins."""
    turns = np.flatnonzero(np.diff(labels)) + 1
    if len(turns):
        lowered = text.lower()
        at = [m.start() for m in _WORD.finditer(lowered if len(lowered) == len(text) else text)]  # as words_in finds them
        cuts = [0, *[at[t] if t < len(at) else len(text) for t in turns], len(text)]
    else:
        cuts = [0, len(text)]
    firsts = [0, *turns]
    return [{"lang": names[labels[f]], "start": a, "end": b} for f, a, b in zip(firsts, cuts, cuts[1:])]


def predictions(docs: DataFrame, model: Languages, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` with lang_pred, score and the labelled spans of the text."""
    keys = docs.select(F.struct(*keep).alias("key"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            for at, to in in_parts(batch.column(1), SLICE_TEXTS):
                part = batch.slice(at, to - at)
                texts = part.column(1).to_pylist()
                found = _label(texts, model)
                spans = [_spans(t, labels, model.names) if len(labels) else [] for t, (_, _, labels) in zip(texts, found)]
                flat = pa.array([s for row in spans for s in row], kind)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([f[0] for f in found]), pa.array([f[1] for f in found]), list_column(flat, np.array([len(s) for s in spans]))],
                    ["key", "lang_pred", "score", "spans"],
                )

    key_type = keys.schema["key"].dataType.simpleString()
    out = keys.mapInArrow(run, f"key {key_type}, lang_pred string, score double, spans array<struct<lang:string,start:bigint,end:bigint>>")
    return out.select("key.*", "lang_pred", "score", "spans")


def accepted(docs: DataFrame, model: Languages, least: float = LEAST_SHARE) -> DataFrame:
    """Documents with a language that at least ``least`` of their words speak."""

    @F.arrow_udf("boolean")
    def speaks(texts: pa.Array) -> pa.Array:
        out = []
        for at, to in in_parts(texts, SLICE_TEXTS):
            out += [lang != UNKNOWN and score >= least for lang, score, _ in _label(texts.slice(at, to - at).to_pylist(), model)]
        return pa.array(out, pa.bool_())

    # Only the text goes to Python; the other columns stay where they are.
    return docs.filter(speaks(F.col("text").cast("string")))


def trained(docs: DataFrame) -> Languages:
    """Learned from documents outside the held-out fifth."""
    return learn(docs.filter(crc32_of(F.col("doc_id")) % 5 != 0))


@query("op6_language_spans")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predictions(docs.select("doc_id", "text"), trained(docs), ["doc_id"])
    return found.select("doc_id", (crc32_of(F.col("doc_id")) % 5 == 0).alias("held_out"), "lang_pred", "score", "spans")
