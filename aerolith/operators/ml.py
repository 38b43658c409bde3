"""ML data work (2.9): features, exact splits, lag sequences, scaling, metrics, models.

Per-entity ordered operations (splits, forward fill, lag windows) are written
as two-level scans so that no task ever holds a whole entity: rows are cut into
ordered segments (range partitions of (city, time, id), so a hot city with a
third of all rows spans about a third of the partitions); a small per-segment
summary table carries state across segment borders, and the row-level window
runs within a segment only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.constants import FEATURES_24, SEQ_FEATURES  # noqa: F401
from aerolith.sources.layers import fresh_path

LABEL = "is_extreme_weather"


def feature_matrix(gold: DataFrame, features=FEATURES_24, label: str = LABEL) -> DataFrame:
    """The feature columns that exist, nulls -> -1; string features label-encoded."""
    present = [c for c in features if c in gold.columns]
    strings = [c for c in present if gold.schema[c].dataType.typeName() == "string"]
    out = gold.select("reading_id", *present, F.col(label).alias("label"))
    out = out.fillna(-1, subset=[c for c in present if c not in strings])
    if strings:
        from pyspark.ml.feature import StringIndexer
        idx = StringIndexer(inputCols=strings, outputCols=[f"{c}_idx" for c in strings],
                            handleInvalid="keep", stringOrderType="alphabetAsc").fit(out)
        out = idx.transform(out.fillna("-1", subset=strings))
        for c in strings:
            out = out.drop(c).withColumnRenamed(f"{c}_idx", c)
    return out


# --- exact ordered splits --------------------------------------------------------

def ordered_split(df: DataFrame, part_cols: list[str], order_cols: list[Column], bucket: Column,
                  fraction: float, out: str = "is_train") -> DataFrame:
    """Mark the first ``floor(fraction * n)`` rows of each partition (in ``order_cols``) as train.

    ``bucket`` must be non-decreasing along ``order_cols``. A histogram of rows
    per (partition, bucket) gives every bucket's starting rank; whole buckets on
    either side of the cut are decided from the histogram alone, and only rows of
    the one bucket containing the cut are ranked individually.

    The histogram (one row per partition and bucket) is written once, so the
    planner sizes it from its files: under the broadcast threshold the rows are
    joined to it map-side and only the cut buckets are shuffled.
    """
    d = df.withColumn("_b", bucket)
    hist = d.groupBy(*part_cols, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*part_cols).orderBy("_b")
    hist = (hist.withColumn("_before", F.coalesce(F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                                                  F.lit(0)))
                .withColumn("_cut", F.floor(F.sum("_cnt").over(Window.partitionBy(*part_cols)) * fraction)))
    spark = df.sparkSession
    path = fresh_path(spark, "splits/histogram")
    hist.write.parquet(path)
    j = d.join(spark.read.parquet(path), [*part_cols, "_b"])
    whole_train = F.col("_before") + F.col("_cnt") <= F.col("_cut")
    whole_test = F.col("_before") >= F.col("_cut")
    decided = j.filter(whole_train | whole_test).withColumn(out, whole_train)
    edge = j.filter(~(whole_train | whole_test))
    rk = F.row_number().over(Window.partitionBy(*part_cols, "_b").orderBy(*order_cols))
    edge = edge.withColumn(out, F.col("_before") + rk <= F.col("_cut"))
    return decided.unionByName(edge).drop("_b", "_cnt", "_before", "_cut")


def stratified_split(df: DataFrame, label: str = LABEL, id_col: str = "reading_id",
                     fraction: float = 0.8) -> DataFrame:
    """Per class, the first 80% in md5(id) order are train: a reproducible stratified shuffle."""
    h = F.md5(F.col(id_col).cast("string"))
    return ordered_split(df, [label], [h, F.col(id_col)], F.conv(F.substring(h, 1, 4), 16, 10).cast("int"),
                         fraction)


def chronological_split(df: DataFrame, key: str = "city", ts: str = "timestamp", id_col: str = "reading_id",
                        fraction: float = 0.8, parts: int | None = None) -> DataFrame:
    """Per city, the first 80% of readings in time order are train (no shuffling of time).

    The histogram buckets are the city's ordered segments, so the one bucket
    ranked row by row is bounded by a partition, not by the city.
    """
    order = [F.col(ts), F.col(id_col)]
    seg = segmented(df, key, order, parts)
    return ordered_split(seg, [key], order, F.col("_seg"), fraction).drop("_seg")


def class_weights(train: DataFrame, label: str = "label") -> DataFrame:
    return (train.agg(F.count(F.when(F.col(label) == 0, 1)).alias("n_normal"),
                      F.count(F.when(F.col(label) == 1, 1)).alias("n_extreme"))
                 .withColumn("pos_weight", F.col("n_normal") / F.greatest(F.col("n_extreme"), F.lit(1))))


def with_weights(train: DataFrame, label: str = "label") -> DataFrame:
    """Weight column: pos_weight for positives, 1 for negatives (one-row aggregate attached by key)."""
    w = class_weights(train, label).select("pos_weight").withColumn("_k", F.lit(1))
    return (train.withColumn("_k", F.lit(1)).join(F.broadcast(w), "_k")
                 .withColumn("weight", F.when(F.col(label) == 1, F.col("pos_weight")).otherwise(F.lit(1.0)))
                 .drop("_k", "pos_weight"))


# --- per-entity sequences ----------------------------------------------------------

def ordered_segments(df: DataFrame, key: str, order: list[Column], parts: int | None = None) -> DataFrame:
    """Add ``_seg``, a segment id that never decreases along ``order`` within a key.

    Rows are range-partitioned on (key, *order) and the partition id is the
    segment. Range bounds are drawn from a sample of the whole sort key, so a
    key holding a third of all rows is spread over about a third of the
    partitions: a segment is bounded by the partition size, never by one key.

    Range bounds come from a seeded sample that differs between two shuffles of
    the same rows, so the segmented rows are written once (under the shared
    checkpoint folder) and read back: every branch of the caller's plan, and a
    recomputed task, sees the same segments. The write also cuts the lineage.

    Without ``parts`` the shuffle width is the session's, and AQE merges
    adjacent ranges toward its advisory size (merged partitions stay in range
    order, so segment ids remain monotone): a small input gets a few segments,
    a large one segments of about the advisory size. ``parts`` fixes the count.
    """
    spark = df.sparkSession
    cols = [F.col(key), *order]
    ranged = df.repartitionByRange(parts, *cols) if parts else df.repartitionByRange(*cols)
    path = fresh_path(spark, "segments/ordered")
    ranged.withColumn("_seg", F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(path)


def segmented(df: DataFrame, key: str, order: list[Column], parts: int | None = None) -> DataFrame:
    """``df`` as it is where it has its segments already (steps in a row share one cut), else cut into segments."""
    return df if "_seg" in df.columns else ordered_segments(df, key, order, parts)


def forward_fill(df: DataFrame, cols: list[str], key: str = "city", ts: str = "timestamp",
                 id_col: str = "reading_id", parts: int | None = None) -> DataFrame:
    """Carry the last non-null value forward within each city; leading nulls -> 0. Segments that ``df`` has are kept."""
    d = segmented(df, key, [F.col(ts), F.col(id_col)], parts)
    order = F.struct(F.col(ts), F.col(id_col))
    seg_last = d.groupBy(key, "_seg").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(f"_l_{c}") for c in cols])
    w_seg = Window.partitionBy(key).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    carry = seg_last.select(key, "_seg", *[F.last(f"_l_{c}", ignorenulls=True).over(w_seg).alias(f"_c_{c}")
                                           for c in cols])
    w_in = Window.partitionBy(key, "_seg").orderBy(ts, id_col).rowsBetween(Window.unboundedPreceding, 0)
    j = d.join(carry, [key, "_seg"], "left")
    filled = [F.coalesce(F.last(c, ignorenulls=True).over(w_in), F.col(f"_c_{c}"), F.lit(0.0)).alias(c)
              for c in cols]
    others = [c for c in df.columns if c not in cols]
    return j.select(*others, *filled)


def sequence_windows(df: DataFrame, features=SEQ_FEATURES, length: int = 7, key: str = "city",
                     ts: str = "timestamp", id_col: str = "reading_id", target: str = "temperature_fahrenheit",
                     parts: int | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Each reading with the ``length`` previous readings of its city (oldest first) as lag columns.

    The first ``length`` readings of a city have no full history and yield no sample.
    Lag columns are named ``{feature}_lag{i}`` with i = 1 for the immediately
    preceding reading. ``keep`` passes columns of the reading through (time and segment, for a
    chronological split of the samples without joining back to the input).
    """
    L = length
    item = F.struct(F.col(ts).alias("t"), F.col(id_col).alias("i"), *[F.col(c) for c in features])
    cols = list(dict.fromkeys([key, ts, id_col, target, *features, *keep, *(["_seg"] if "_seg" in df.columns else [])]))
    d = segmented(df.select(*cols), key, [F.col(ts), F.col(id_col)], parts).withColumn("_it", item)
    # tail of every segment: its last L readings (partial top-L before the shuffle)
    w_desc = Window.partitionBy(key, "_seg").orderBy(F.col(ts).desc(), F.col(id_col).desc())
    tails = (d.withColumn("_rd", F.row_number().over(w_desc)).filter(F.col("_rd") <= L)
              .groupBy(key, "_seg").agg(F.array_sort(F.collect_list("_it")).alias("_tail")))
    # carry-in of a segment: last L readings of the previous (up to L) segments of the city
    w_prev = Window.partitionBy(key).orderBy("_seg").rowsBetween(-L, -1)
    carry = tails.select(key, "_seg", F.flatten(F.collect_list("_tail").over(w_prev)).alias("_all"))
    carry = carry.select(key, "_seg", F.slice("_all", F.greatest(F.size("_all") - L + 1, F.lit(1)), L)
                         .alias("_carry"))
    w_in = Window.partitionBy(key, "_seg").orderBy(ts, id_col).rowsBetween(-L, -1)
    j = d.join(carry, [key, "_seg"], "left").withColumn("_w", F.collect_list("_it").over(w_in))
    need = F.lit(L) - F.size("_w")
    empty = F.filter(F.col("_w"), lambda x: F.lit(False))  # an empty array of the item type
    c = F.coalesce(F.col("_carry"), empty)
    head = F.when(need > 0, F.slice(c, F.greatest(F.size(c) - need + 1, F.lit(1)), need)).otherwise(empty)
    j = j.withColumn("_lags", F.concat(head, F.col("_w"))).filter(F.size("_lags") == L)
    lag_cols = [F.col("_lags")[L - i][f].alias(f"{f}_lag{i}") for i in range(1, L + 1) for f in features]
    return j.select(id_col, key, *keep, F.col(target).alias("target"), *lag_cols)


def minmax_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    """(x - min) / (max - min) over all rows; a constant column scales to 0."""
    stats = df.agg(*[F.min(c).alias(f"_mn_{c}") for c in cols], *[F.max(c).alias(f"_mx_{c}") for c in cols])
    j = df.withColumn("_k", F.lit(1)).join(F.broadcast(stats.withColumn("_k", F.lit(1))), "_k")
    scaled = [F.when(F.col(f"_mx_{c}") == F.col(f"_mn_{c}"), F.lit(0.0))
               .otherwise((F.col(c) - F.col(f"_mn_{c}")) / (F.col(f"_mx_{c}") - F.col(f"_mn_{c}"))).alias(c)
              for c in cols]
    return j.select(*[c for c in df.columns if c not in cols], *scaled)


# --- metrics ---------------------------------------------------------------------------

def binary_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """accuracy, precision, recall, F1 in one pass; a zero denominator gives 0."""
    y, p = F.col(label), F.col(prediction)
    c = pred.agg(F.count(F.when((y == 1) & (p == 1), 1)).alias("tp"),
                 F.count(F.when((y == 0) & (p == 1), 1)).alias("fp"),
                 F.count(F.when((y == 1) & (p == 0), 1)).alias("fn"),
                 F.count(F.lit(1)).alias("n"),
                 F.count(F.when(y == p, 1)).alias("correct"))
    div = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    prec = div(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = div(F.col("tp"), F.col("tp") + F.col("fn"))
    return c.select(F.round(div(F.col("correct"), F.col("n")), 6).alias("accuracy"),
                    F.round(prec, 6).alias("precision"), F.round(rec, 6).alias("recall"),
                    F.round(div(2 * prec * rec, prec + rec), 6).alias("f1"))


def confusion_matrix(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return pred.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def regression_metrics(pred: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    e = F.col(actual) - F.col(predicted)
    return pred.agg(F.round(F.avg(F.abs(e)), 6).alias("mae"), F.round(F.sqrt(F.avg(e * e)), 6).alias("rmse"))
