"""Shared by the corpus operators: words, shingles, stored frames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martworks.session import scratch

#: White space between words, as a class of the pattern language.
BLANK = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SHINGLE = 5


def text_of(name: str = "text") -> Column:
    """The text, a null one being empty."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANK), "")


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row. A plain projection may be merged into the filters and lambdas that
    use it, which would then split a text again for every window; a generator of one row is not."""
    return df.select("*", F.inline(F.array(F.struct(*[made.alias(name) for name, made in columns.items()]))))


def shingle_hashes(words: Column, size: int = SHINGLE) -> Column:
    """One hash per window of ``size`` words, in order; a shorter text has one, of all its words, or none.

    ``words`` has to be a column of the frame, not an expression: it is read once per window.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - size), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))
    return (F.when(F.size(words) >= size, windows)
            .when(F.size(words) > 0, F.array(F.xxhash64(words)))
            .otherwise(F.array().cast("array<bigint>")))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the rows below the shared folder and read them again: later steps do not compute them twice, and a
    lost executor costs nothing."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prefix_sums(parts: DataFrame, keys: list[str], order: str, **sums: str) -> DataFrame:
    """Per part the sums over the parts before it in its key; ``sums`` names the new columns and their sources.

    One row per key and part comes in, so the window is small whatever the number of rows behind the parts.
    """
    from pyspark.sql import Window

    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumns({new: F.coalesce(F.sum(old).over(before), F.lit(0)) for new, old in sums.items()})


def bounded(df: DataFrame, max_bytes: int = 32 << 20) -> DataFrame:
    """Hint a broadcast of a stored frame if its values together are measured to stay below ``max_bytes``; above,
    the join is left to the planner."""
    return F.broadcast(df) if measured_bytes(df) <= max_bytes else df


def measured_bytes(df: DataFrame) -> int:
    """About the bytes of all values of a stored frame (strings and arrays of longs by their lengths)."""
    sizes = {"string": lambda c: F.octet_length(c), "array": lambda c: F.size(c) * 8}
    parts = [F.coalesce(sizes[f.dataType.typeName()](f.name), F.lit(0)) for f in df.schema.fields if f.dataType.typeName() in sizes]
    return df.agg(F.sum(sum(parts, F.lit(16 * len(df.columns))).cast("long"))).first()[0] or 0


def shielded(docs: DataFrame, *needed: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The rows with every column but the needed ones under a name that no operator uses, and a function that gives the
    input's columns back: whatever they are called, they neither meet nor replace what is computed on the way."""
    names = {c: c if c in needed else f"column {i} of the input" for i, c in enumerate(docs.columns)}
    hidden = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return hidden, lambda rows: rows.select(*[F.col(f"`{n}`").alias(c) for c, n in names.items()])


def text_digest(text: Column) -> Column:
    """A digest that different texts do not share."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def text_key(text: Column, part: int = 0) -> Column:
    """Sixty bits of the text's digest, the first or (``part`` 1) the next ones: equal texts have equal keys. Among 10^10
    different texts some tens of pairs are expected to share one part, and none to share both."""
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1 + 15 * part, 15), 16, 10).cast("long")
