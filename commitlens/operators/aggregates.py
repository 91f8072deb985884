"""Grouped aggregates, lists in bounded cells among them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commitlens.functions.text import truncate_message
from commitlens.operators.ranking import top_n_per_key


def weighted_mean(value: str, weight: str, skip_null: bool = False) -> Column:
    """``sum(value * weight) / sum(weight)``; null for no weight.

    A null value drops out of the numerator only, unless ``skip_null``.
    """
    w = F.when(F.col(value).isNotNull(), F.col(weight)) if skip_null else F.col(weight)
    return F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(w))


def any_value_by(value: str, *order: str) -> Column:
    """The value of the first row by ``order``, nulls last: any value, but the same one on every run."""
    return F.min_by(value, F.struct(*[x for c in order for x in (F.col(c).isNull(), F.col(c))]))


def distinct_list(df: DataFrame, keys: list[str], list_column: str) -> DataFrame:
    """Per key the sorted set of all items of a list column.

    Items are made distinct across the cluster first, so a hot key's rows are merged in many tasks
    and only its distinct items meet in one cell. Keys with empty lists get an empty list.
    """
    items = df.select(*keys, F.explode_outer(list_column).alias("_item")).distinct()
    return items.groupBy(*keys).agg(F.array_sort(F.collect_list("_item")).alias(list_column))


def ordered_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``df`` with ``position``, a number that rises along each key's rows in ``order``.

    Reading a key's rows by position gives them in order. Rows are range partitioned by key and
    order, in one shuffle, so one key spreads over as many tasks as its size calls for and no task or cell ever has to
    hold a whole key. Copies of a row, which ``order`` does not tell apart, are told apart by where
    they were read, so they spread as well.
    """
    return (
        df.withColumn("_copy", F.monotonically_increasing_id())
        .repartitionByRange(*[F.col(c) for c in [*keys, *order, "_copy"]])
        .sortWithinPartitions(*keys, *order, "_copy")
        # Partition number in the high bits, row number in the low ones: rises along the order.
        .withColumn("position", F.monotonically_increasing_id())
        .drop("_copy")
    )


def concat_text(text: str, *order: str) -> Column:
    """Texts of a group one after the other without a delimiter, nulls skipped."""
    rows = F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("_text"))))
    return F.array_join(F.transform(rows, lambda r: r["_text"]), "")


def history_digest(
    df: DataFrame,
    keys: list[str],
    text: str,
    order: list[str],
    lines: int = 500,
    words: int = 10_000,
) -> DataFrame:
    """Per key the first lines and words of all its texts put together in ``order``.

    Equal to concatenating everything and truncating, but of a key only the rows are brought together that
    reach into the result: those with fewer than ``lines`` line ends and fewer than ``words`` ends of words
    before them. Where these rows end is found from counts alone, first for the parts of a key that lie in
    one place, spread over many tasks, and then for what is left of them. Every text is cut to as
    many lines and words itself, so a cell holds about ``lines`` lines or ``words`` words, however texts are
    made. (One word may be of any size: texts without any white space run together into a single one.)
    """
    salts = max(32, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    gap, rest = r"[\s\x1c-\x1f]", r"[^\s\x1c-\x1f]"
    whole_words = rf"(?U)\A{gap}*+(?:{rest}++{gap}++){{0,{words}}}+{rest}*+"
    rows = df.where(F.length(text) > 0).select(*keys, *order, F.substring_index(text, "\n", lines + 1).alias("_text"))
    counts = rows.select(
        *keys,
        *order,
        (F.length("_text") - F.length(F.replace("_text", F.lit("\n"), F.lit("")))).alias("_lines"),
        F.regexp_count("_text", F.lit(f"(?U){rest}{gap}")).alias("_words"),
        (F.spark_partition_id() % salts).alias("_salt"),
    )

    def reaching(part: DataFrame, *by: str) -> DataFrame:
        before = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        summed = [F.coalesce(F.sum(c).over(before), F.lit(0)) for c in ("_lines", "_words")]
        return part.withColumns({"_b": summed[0], "_w": summed[1]}).where((F.col("_b") < lines) & (F.col("_w") < words)).drop("_b", "_w")

    needed = reaching(reaching(counts, "_salt", *keys), *keys)
    ends = needed.groupBy(*[F.col(k).alias(f"_of_{k}") for k in keys]).agg(F.max(F.struct(*order)).alias("_end"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    kept = rows.join(ends, same & (F.struct(*order) <= F.col("_end"))).select(
        *keys, *order, F.regexp_extract("_text", whole_words, 0).alias("_text")
    )
    whole = kept.groupBy(*keys).agg(concat_text("_text", *order).alias("_text"))
    return whole.select(*keys, truncate_message(F.col("_text"), lines, words).alias(text))


def first_items(df: DataFrame, keys: list[str], items: str, n: int = 100) -> DataFrame:
    """Per key the first ``n`` distinct items, in sorted order, of a list column."""
    distinct = df.select(*keys, F.explode(items).alias("_item")).where("_item IS NOT NULL").distinct()
    first = top_n_per_key(distinct, keys, [F.col("_item")], n)
    return first.groupBy(*keys).agg(F.array_sort(F.collect_list("_item")).alias(items))
