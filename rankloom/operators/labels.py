"""Labels, feedback, status filters and training-data assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions import wordlists as W
from rankloom.functions.portable import hash32, truthy
from rankloom.operators.spread import keep_first, keep_last, running_totals, top_k

PAIR_COLUMNS = ["resume_text", "job_description_text", "label"]


def require_columns(df: DataFrame, needed: list[str]) -> DataFrame:
    """Fail, naming what is missing, before any job runs."""
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def drop_incomplete(df: DataFrame, subset: list[str]) -> DataFrame:
    return df.na.drop(subset=subset)


def encode_labels(df: DataFrame, label: str = "label") -> DataFrame:
    """Drop "Potential Fit"; Good Fit 1, No Fit 0, anything else null."""
    c = F.col(label)
    return df.filter(c.isNull() | (c != "Potential Fit")).withColumn(
        label, F.when(c == "Good Fit", 1).when(c == "No Fit", 0)
    )


def is_valid_label(label: Column) -> Column:
    """A number among 0, 1, -1 or one of the four label texts, any case."""
    number = label.try_cast("double")
    return F.coalesce(
        F.when(number.isNotNull(), number.isin(0.0, 1.0, -1.0)).otherwise(
            F.lower(label).isin("good fit", "no fit", "potential fit", "neutral")
        ),
        F.lit(False),
    )


def is_binary_label(label: Column) -> Column:
    number = label.try_cast("double")
    return F.coalesce(
        F.when(number.isNotNull(), number.isin(1.0, -1.0)).otherwise(F.lower(label).isin("good fit", "no fit")),
        F.lit(False),
    )


def numeric_target(label: Column) -> Column:
    """Target of a binary label; -1 counts as no fit."""
    number = label.try_cast("double")
    return (
        F.when(F.lower(label) == "good fit", 1)
        .when(F.lower(label) == "no fit", 0)
        .when(number == -1, 0)
        .otherwise(number.try_cast("int"))
    )


def status_of_prediction(prediction: Column) -> Column:
    return F.when(prediction == 0, W.STATUS_UNFIT).when(prediction == 1, W.STATUS_FIT)


def feedback_label(value: Column) -> Column:
    return F.when(value == 1, "Good Fit").when(value == -1, "No Fit")


def latest_feedback(feedback: DataFrame, key: str = "resume_id") -> DataFrame:
    """The last feedback per resume, by time and then id."""
    return keep_last(feedback, [key], ["ts", "event_id"])


def upsert(base: DataFrame, updates: DataFrame, key: str, seq: list[str], columns: list[str]) -> DataFrame:
    """Keyed upsert of some columns: in each the last write wins, a null writes
    nothing, unknown keys become new rows."""
    order = F.struct(*seq)
    last = updates.groupBy(F.col(key).alias("_key")).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(f"_new_{c}") for c in columns])
    joined = base.join(last, base[key] == last["_key"], "full_outer")
    out = []
    for c in base.columns:
        if c == key:
            out.append(F.coalesce(F.col(c), F.col("_key")).alias(c))
        elif c in columns:
            out.append(F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)


def new_resume_rows(df: DataFrame) -> DataFrame:
    """Uploaded rows with the defaults of the store and their key."""
    return df.withColumns(
        {
            "status": F.lit(W.STATUS_UPLOADED),
            "fit_probability": F.lit(0.0),
            "feedback_label": F.lit(0),
        }
    )


def path_parts(path: Column) -> dict[str, Column]:
    """Job id, parent folder, blob name and original file name of ``resumes/<job>/<id>_<file>``."""
    blob = F.substring_index(path, "/", -1)
    return {
        "job_id": F.split_part(path, F.lit("/"), F.lit(2)),
        "parent_dir": F.element_at(F.split(path, "/"), -2),
        "blob_name": blob,
        "original_name": F.regexp_replace(blob, "^[^_]*_", ""),
    }


def job_text_or_description(description: Column, text: Column) -> Column:
    return truthy(description, text)


def assemble_training(base: DataFrame, extra: DataFrame, key: str = "row_id") -> DataFrame:
    """Base rows plus feedback rows: complete, valid, one per text pair, base first.

    The pair key is a digest of both texts, so the shuffle sorts 32 bytes and not
    two documents; copies collapse before it.
    """
    both = base.withColumn("_src", F.lit(0)).unionByName(extra.withColumn("_src", F.lit(1)), allowMissingColumns=True)
    good = drop_incomplete(both, PAIR_COLUMNS).filter(is_valid_label(F.col("label")))
    return keep_first(good, pair_key(), ["_src", key]).drop("_src")


def pair_key() -> list[Column]:
    return [F.sha2(F.col("job_description_text"), 256), F.sha2(F.col("resume_text"), 256)]


def exact_split(df: DataFrame, key: str, share_percent: int = 20, seed: str = "42") -> DataFrame:
    """Exactly ``ceil(share · n)`` rows to ``test``, the rest to ``train``.

    Rows are ordered by portable hash; cells of the hash range keep every sort
    small, so no task sees the whole table.
    """
    h = hash32(seed, key)
    ranked = running_totals(
        df.withColumn("_h", h),
        [],
        [F.col("_h"), F.col(key)],
        [F.floor(F.col("_h") / (1 << 22)).cast("bigint"), F.floor(F.col("_h") / (1 << 10)).cast("bigint")],
        {"_rank": F.lit(1)},
        {"_n": "_rank"},
    )
    cut = F.floor((F.col("_n") * share_percent + 99) / 100)
    return ranked.withColumn("split", F.when(F.col("_rank") <= cut, "test").otherwise("train")).drop("_h", "_rank", "_n")


def stratified_sample(df: DataFrame, group: list[str], key: str, k: int = 3, seed: str = "sample") -> DataFrame:
    """Up to k rows per stratum, chosen by portable hash."""
    return top_k(df.withColumn("_h", hash32(seed, key)), group, [F.col("_h"), F.col(key)], k, "draw").drop("_h")


def assign_folds(df: DataFrame, label: str, key: str, folds: int = 3, seed: str = "fold") -> DataFrame:
    """Stratified folds: the hash order inside a class dealt out in turn."""
    ranked = running_totals(
        df.withColumn("_h", hash32(seed, key)),
        [label],
        [F.col("_h"), F.col(key)],
        [F.floor(F.col("_h") / (1 << 22)).cast("bigint"), F.floor(F.col("_h") / (1 << 10)).cast("bigint")],
        {"_rank": F.lit(1)},
    )
    return ranked.withColumn("fold", ((F.col("_rank") - 1) % folds).cast("int")).drop("_h", "_rank")


def batch_numbers(df: DataFrame, queue: list[str], key: str, size: int) -> DataFrame:
    """Batch number of every row: consecutive runs of ``size`` rows per queue."""
    ranked = running_totals(df, queue, [F.col(key)], [key], {"_rank": F.lit(1)})
    return ranked.withColumn("batch", F.floor((F.col("_rank") - 1) / size).cast("bigint")).drop("_rank")
