"""Katz backoff scores: Good-Turing discounted bigrams that back off to unigrams.

``p(w | h)`` is ``d_r * r / (c(h) + 1)`` for a bigram seen ``r`` times in training, with
Good-Turing discounts ``d_r`` up to ``r = TURING``, and ``backoff(h) * p(w)`` otherwise.
``backoff(h)`` divides what the seen words leave by the unigram mass of the words not seen
after ``h``, so every distribution adds up to one. The one in ``c(h) + 1`` stands for an
event still to come: some mass is always left. A history never seen hands over to the
unigrams whole; unigrams are discounted alike and give what is left to one unknown word.

Counting and scoring share one shuffle. Each task sends what it read as blocks of
(history, word, document), sorted, one block for each part of the bigrams; a part knows
the count of every bigram in it, and sums for each document what its tokens need. Parts
are chosen by history, for frequent histories by the bigram, so a word that a third of
all tokens share fills no part alone. Discounts need corpus totals, so documents get
their tokens by count class, and scores are put together once the totals are known.
Only unseen bigrams of held-out documents go on as rows: they join the backoff weight
of their history and, for words outside a table of the ``FREQUENT`` most frequent ones,
the unigram table. That table is all that is broadcast.

The crc32 of the id decides what is held out; a null id counts as the empty text. Null
text is empty: its only token is the end. Repeated rows count as often as they occur
and keep a row each; an empty table gives no rows. Further columns are not read. Words are
known by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.common import ROW, crc32_of, hash_words, mix, numbered, query, table, text_bytes
from rankloom.session import cut_lineage

TURING = 5
#: Words whose counts every task knows: 16 bytes each, whatever the corpus.
FREQUENT = 1 << 17
#: Tokens a task holds before it sends them on.
CHUNK_TOKENS = 1_500_000
#: Bytes of blocks in one Arrow batch.
BATCH_BYTES = 4 << 20
#: Training tokens for one part of the bigrams.
PART_TOKENS = 1_500_000
BEGIN, END = np.uint64(1), np.uint64(2)

_LOWER = bytes(range(256)).lower()


def tokens_of(text: bytes) -> np.ndarray:
    """Hashes of the words between ASCII white space, A-Z lowered, and the end."""
    words = hash_words(text.translate(_LOWER).split())
    return np.append(words, END)


def _chunks(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    """(rows without their text, token arrays) of about CHUNK_TOKENS tokens."""
    rows, tokens, held = [], [], 0
    for batch in batches:
        others = zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns) if i != text_at]) if batch.num_columns > 1 else ((),) * batch.num_rows
        for other, text in zip(others, text_bytes(batch.column(text_at))):
            rows.append(other)
            tokens.append(tokens_of(text))
            held += len(tokens[-1])
            if held >= CHUNK_TOKENS:
                yield rows, tokens
                rows, tokens, held = [], [], 0
    if rows:
        yield rows, tokens


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, tokens in _chunks(batches, 0):
        word, n = np.unique(np.concatenate(tokens), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"])


def discounts(counts: list[int]) -> np.ndarray:
    """Good-Turing discounts d_0 … d_TURING from the numbers of events seen 1 … TURING + 1 times."""
    n = [0, *map(float, counts)]
    d = np.ones(TURING + 1)
    over = (TURING + 1) * n[TURING + 1] / n[1] if n[1] else 1.0
    for r in range(1, TURING + 1):
        if n[r] and over < 1:
            value = ((r + 1) * n[r + 1] / (r * n[r]) - over) / (1 - over)
            d[r] = value if 0 < value <= 1 else 1.0
    return d


class Unigrams:
    """Totals of the training tokens and the unigram distribution."""

    def __init__(self, counts: DataFrame):
        classes = [F.count(F.when(F.col("c") == r, 1)).alias(f"n{r}") for r in range(1, TURING + 2)]
        small = [F.coalesce(F.sum(F.when(F.col("c") > TURING, F.col("c"))), F.lit(0)).alias("big")]
        got = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("types"), *small, *classes).first()
        self.tokens, self.types = got["tokens"], got["types"]
        self.d = discounts([got[f"n{r}"] for r in range(1, TURING + 2)])
        kept = got["big"] + sum(self.d[r] * r * got[f"n{r}"] for r in range(1, TURING + 1))
        left = 1 - kept / self.tokens if self.tokens else 1.0
        self.unknown = max(left, 1 / (self.tokens + 1))
        self.scale = (1 - self.unknown) / kept if kept else 0.0

    def p(self, c: np.ndarray) -> np.ndarray:
        c = np.asarray(c, np.int64)
        return np.where(c > 0, self.scale * c * np.where(c <= TURING, self.d[np.clip(c, 0, TURING)], 1.0), self.unknown)

    def column(self, c: Column) -> Column:
        kept = F.lit(1.0)
        for r in range(1, TURING + 1):
            kept = F.when(c == r, F.lit(float(self.d[r]))).otherwise(kept)
        return F.when(c > 0, F.lit(float(self.scale)) * c * kept).otherwise(F.lit(float(self.unknown)))


def most_frequent(counts: DataFrame, most: int | None = None) -> DataFrame:
    """The words of the highest count classes that hold FREQUENT words at most together."""
    level = F.floor(F.log2("c") * 8)
    room, cut = FREQUENT if most is None else most, None
    for r in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):  # 8 levels for each doubling
        room -= r["count"]
        if room < 0:
            break
        cut = r["level"]
    return counts.limit(0) if cut is None else counts.filter(level >= cut)


def _part_of(h: np.ndarray, w: np.ndarray, hot: np.ndarray, parts: int) -> np.ndarray:
    at = np.searchsorted(hot, h)
    is_hot = np.zeros(len(h), bool) if not len(hot) else hot[np.minimum(at, len(hot) - 1)] == h
    return (mix(np.where(is_hot, h + mix(w), h)) % np.uint64(parts)).astype(np.int64)


def _blocks_map(hot: np.ndarray, parts: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, tokens in _chunks(batches, 3):
            sizes = np.array([len(t) for t in tokens])
            w = np.concatenate(tokens)
            tokens.clear()
            h = np.empty_like(w)
            h[1:] = w[:-1]
            h[np.concatenate([[0], np.cumsum(sizes)[:-1]])] = BEGIN
            part = _part_of(h, w, hot, parts)
            order = np.lexsort((w, h, part))
            h, w = h[order], w[order]
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            doc = np.repeat(np.arange(len(rows), dtype=np.uint32), sizes)[order]
            if len(rows) <= 1 << 16:
                doc = doc.astype("<u2")
            del part, order
            first = rows[0][0]
            flags = np.packbits(np.array([r[2] for r in rows], bool)).tobytes()
            some = [p for p in range(parts) if cuts[p + 1] > cuts[p]]
            step = max(1, int(BATCH_BYTES * len(some) / (18 * len(w))))
            for at in range(0, len(some), step):
                now = some[at : at + step]
                packed = [pa.array([a[cuts[p] : cuts[p + 1]].tobytes() for p in now], pa.binary()) for a in (h, w, doc)]
                n = len(now)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(now, pa.int32()), pa.array([first] * n, pa.int64()), *packed, pa.array([flags] * n, pa.binary()), pa.nulls(n, pa.list_(id_type)), pa.nulls(n, pa.binary())],
                    ["part", "first", "h", "w", "doc", "held", "ids", "sizes"],
                )
            # The documents themselves travel in one of the parts.
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(first) % parts], pa.int32()), pa.array([first], pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), pa.array([flags], pa.binary()), pa.array([[r[1] for r in rows]], pa.list_(id_type)), pa.array([sizes.astype("<u8").tobytes()], pa.binary())],
                ["part", "first", "h", "w", "doc", "held", "ids", "sizes"],
            )

    return run


def _rows(schema: pa.Schema, size: int, /, **columns) -> pa.Table:
    return pa.table([columns.get(f.name, pa.nulls(size, f.type)) if not isinstance(columns.get(f.name), np.ndarray) else pa.array(columns[f.name]).cast(f.type) for f in schema], schema=schema)


def _table_of_lists(values: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), values.shape[1]).cast(pa.list_(pa.from_numpy_dtype(values.dtype)))


def _part_reduce(frequent: tuple[np.ndarray, np.ndarray], hot: np.ndarray, unigrams: Unigrams, id_type: pa.DataType):
    """Work of one part: counts of its bigrams, sums for documents, what unseen bigrams need."""
    schema = pa.schema([("kind", pa.int32()), ("row", pa.int64()), ("id", id_type), ("held", pa.bool_()), ("h", pa.int64()), ("words", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("x", pa.list_(pa.float64()))])
    words, counts = frequent

    def count_of(w: np.ndarray) -> np.ndarray:
        """Training count of frequent words, -1 for others."""
        if not len(words):
            return np.full(len(w), -1)
        at = np.minimum(np.searchsorted(words, w), len(words) - 1)
        return np.where(words[at] == w, counts[at], -1)

    def run(group: pa.Table) -> pa.Table:
        out, hs, ws, docs, held_all = [], [], [], [], []
        for r in group.to_pylist():
            held = np.unpackbits(np.frombuffer(r["held"], np.uint8)).astype(bool)
            if r["ids"] is not None:
                n = len(r["ids"])
                sizes = np.frombuffer(r["sizes"], "<u8").astype(np.int64).reshape(-1, 1)
                out.append(_rows(schema, n, kind=np.zeros(n, np.int32), row=r["first"] + np.arange(n), id=pa.array(r["ids"], id_type), held=pa.array(held[:n]), n=_table_of_lists(sizes)))
                continue
            h = np.frombuffer(r["h"], "<u8")
            doc = np.frombuffer(r["doc"], "<u2" if len(r["doc"]) == 2 * len(h) else "<u4").astype(np.int64)
            hs.append(h)
            ws.append(np.frombuffer(r["w"], "<u8"))
            docs.append(doc + r["first"])
            held_all.append(held[doc])
        if not hs:
            return pa.concat_tables(out)
        h, w, row, held = (np.concatenate(a) for a in (hs, ws, docs, held_all))
        del hs, ws, docs, held_all
        order = np.lexsort((w, h))
        h, w, row, held = h[order], w[order], row[order], held[order]
        new_h = np.append(True, h[1:] != h[:-1])
        new = new_h | np.append(True, w[1:] != w[:-1])
        gram, hist = np.cumsum(new) - 1, np.cumsum(new_h) - 1
        r_gram = np.bincount(gram, weights=~held).astype(np.int64)
        gram_h, gram_w = hist[new], w[new]
        h_word = h[new_h]
        c_hist = np.bincount(hist, weights=~held).astype(np.int64)
        at = np.minimum(np.searchsorted(hot, h_word), max(len(hot) - 1, 0))
        is_hot = hot[at] == h_word if len(hot) else np.zeros(len(h_word), bool)
        c_hist = np.where(is_hot, count_of(np.where(h_word == BEGIN, END, h_word)), c_hist)
        r_tok, c_tok = r_gram[gram], c_hist[hist]

        # Sums by document: base over histories that are words, tokens by count class.
        rows, place = np.unique(row, return_inverse=True)
        is_word = h != BEGIN
        seen = r_tok > 0

        def total(values):
            return np.bincount(place, weights=values, minlength=len(rows))

        classes = [total(is_word & (c_tok > 0))] + [total(r_tok == k) for k in range(1, TURING + 1)]
        big = total(np.where(r_tok > TURING, np.log10(np.maximum(r_tok, 1)), 0.0))
        past = total(np.where(seen, np.log10(c_tok + 1.0), 0.0))
        base = total(np.where(is_word, np.log10(c_tok + 1.0), 0.0))
        out.append(_rows(schema, len(rows), kind=np.full(len(rows), 1), row=rows, n=_table_of_lists(np.stack(classes, 1).astype(np.int64)), x=_table_of_lists(np.stack([base, big, past], 1))))

        # How many bigrams were seen 1 … TURING + 1 times.
        per = np.bincount(np.minimum(r_gram, TURING + 2), minlength=TURING + 3)[1 : TURING + 2]
        out.append(_rows(schema, 1, kind=np.full(1, 2), n=_table_of_lists(per.reshape(1, -1).astype(np.int64))))

        # Unseen bigrams; only documents held out can have them.
        miss = np.flatnonzero(~seen)
        if len(miss):
            c_w = count_of(w[miss])
            known = c_w >= 0
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(~known)]).astype(np.int32)), pa.array(w[miss][~known].view(np.int64)))
            lp = np.where(known, np.log10(unigrams.p(np.maximum(c_w, 0))), 0.0)
            out.append(_rows(schema, len(miss), kind=np.full(len(miss), 3), row=row[miss], h=h[miss].view(np.int64), words=lists, x=_table_of_lists(lp.reshape(-1, 1))))
        # Their histories: counts by class and the unigram mass of what was seen after them. A hot
        # history has several parts, and a part may see it without a miss of its own.
        needed = is_hot | (np.bincount(hist[miss], minlength=len(h_word)) > 0) if len(miss) else is_hot.copy()
        needed &= c_hist > 0
        if needed.any():
            of = (r_gram > 0) & needed[gram_h]
            gh, gw, gr = gram_h[of], gram_w[of], r_gram[of]
            c_w = count_of(gw)
            known = c_w >= 0
            size = len(h_word)
            mass = np.bincount(gh[known], weights=unigrams.p(c_w[known]), minlength=size)
            cls = [np.bincount(gh, weights=gr == k, minlength=size) for k in range(1, TURING + 1)]
            more = np.bincount(gh, weights=np.where(gr > TURING, gr, 0), minlength=size)
            rare = np.bincount(gh[~known], minlength=size)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(rare[needed])]).astype(np.int32)), pa.array(gw[~known].view(np.int64)))
            n = int(needed.sum())
            whole = np.stack([c_hist, *cls, more], 1)[needed].astype(np.int64)
            out.append(_rows(schema, n, kind=np.full(n, 4), h=h_word[needed].view(np.int64), words=lists, n=_table_of_lists(whole), x=_table_of_lists(mass[needed].reshape(-1, 1))))
        return pa.concat_tables(out)

    return run


def scored(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """Base and model score of every row; rows that are not ``held_out`` are learned from."""
    id_field = docs.select(F.col(id_col).alias("id")).schema["id"]
    id_sql = id_field.dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(id_field.dataType)
    named = docs.select(F.col(id_col).alias("id"), held_out.alias("held"), F.col(text_col).cast("string").alias("text"))
    counted = named.filter(~F.col("held")).select("text").mapInArrow(_count_words, "word bigint, n bigint")
    counts = cut_lineage(counted.groupBy("word").agg(F.sum("n").alias("c")))
    unigrams = Unigrams(counts)
    top = most_frequent(counts).toPandas()  # FREQUENT rows at most
    end_count = int(counts.filter(F.col("word") == int(END)).select(F.coalesce(F.max("c"), F.lit(0))).first()[0])
    pairs = {int(w) % (1 << 64): int(c) for w, c in zip(top["word"], top["c"])}
    pairs[int(END)] = end_count
    words = np.array(sorted(pairs), np.uint64)
    frequent = (words, np.array([pairs[int(w)] for w in words], np.int64))

    parts = parts or 8 + unigrams.tokens // PART_TOKENS
    often = frequent[1] * 8 * parts > max(unigrams.tokens, 1)  # 8 words for each part at most
    hot = np.unique(np.append(words[often], BEGIN))

    keyed = numbered(named).select(ROW, "id", "held", "text")
    blocks = keyed.mapInArrow(_blocks_map(hot, parts, id_type), f"part int, first bigint, h binary, w binary, doc binary, held binary, ids array<{id_sql}>, sizes binary")
    wide = f"kind int, row bigint, id {id_sql}, held boolean, h bigint, words array<bigint>, n array<bigint>, x array<double>"
    told = cut_lineage(blocks.groupBy("part").applyInArrow(_part_reduce(frequent, hot, unigrams, id_type), wide))

    seen = told.filter("kind = 2").agg(*[F.coalesce(F.sum(F.get("n", F.lit(r))), F.lit(0)) for r in range(TURING + 1)]).first()
    d = discounts(list(seen))

    rare = told.filter("kind >= 3").select("kind", "row", "h", F.explode("words").alias("word")).join(counts, "word", "left")
    rare_p = unigrams.column(F.coalesce("c", F.lit(0)))
    histories = told.filter("kind = 4").select("h", F.get("n", F.lit(0)).alias("c"), *[F.get("n", F.lit(r)).alias(f"m{r}") for r in range(1, TURING + 2)], F.get("x", F.lit(0)).alias("mass"))
    more_mass = rare.filter("kind = 4").select("h", F.lit(None).cast("bigint").alias("c"), *[F.lit(0).cast("bigint").alias(f"m{r}") for r in range(1, TURING + 2)], rare_p.alias("mass"))
    sums = histories.unionByName(more_mass).groupBy("h").agg(F.max("c").alias("c"), *[F.sum(f"m{r}").alias(f"m{r}") for r in range(1, TURING + 2)], F.sum("mass").alias("mass"))
    kept = sum((F.col(f"m{r}") * F.lit(float(d[r] * r)) for r in range(1, TURING + 1)), F.col(f"m{TURING + 1}"))
    backoff = cut_lineage(sums.select("h", F.log10((1 - kept / (F.col("c") + 1)) / (1 - F.col("mass"))).alias("backoff")))

    misses = told.filter("kind = 3")
    turned = misses.select("row", "h", F.get("x", F.lit(0)).alias("lp")).join(backoff, "h", "left").groupBy("row").agg(F.sum(F.col("lp") + F.coalesce("backoff", F.lit(0.0))).alias("y"))
    looked = rare.filter("kind = 3").groupBy("row").agg(F.sum(F.log10(rare_p)).alias("y"))
    sums_by_doc = told.filter("kind = 1").select(
        "row",
        F.get("n", F.lit(0)).alias("known"),
        F.get("x", F.lit(0)).alias("base"),
        sum((F.get("n", F.lit(r)) * F.lit(float(np.log10(d[r] * r))) for r in range(1, TURING + 1)), F.get("x", F.lit(1)) - F.get("x", F.lit(2))).alias("y"),
    )
    extra = turned.unionByName(looked).select("row", F.lit(0).cast("bigint").alias("known"), F.lit(0.0).alias("base"), "y")
    by_doc = sums_by_doc.unionByName(extra).groupBy("row").agg(F.sum("known").alias("known"), F.sum("base").alias("base"), F.sum("y").alias("score"))
    n_tokens = F.get("n", F.lit(0))
    all_docs = told.filter("kind = 0").select("row", "id", "held", n_tokens.alias("n_tokens"))
    per_token = float(np.log10(unigrams.tokens + unigrams.types + 1))
    return all_docs.join(by_doc, "row").select(
        F.col("id").alias(id_col),
        F.col("held").alias("held_out"),
        "n_tokens",
        (F.col("known") + F.lit(int(end_count > 0))).alias("n_known"),
        F.lit(unigrams.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.lit(float(np.log10(end_count + 1))) - F.col("n_tokens") * F.lit(per_token)).alias("base_score"),
        "score",
    )


@query("op2_katz_backoff")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), crc32_of(F.col("doc_id")) % 7 == 2)
