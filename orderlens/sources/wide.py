"""Wide delimited text source: one customer per line, aligned ';'-lists.

Line format (tab separated, no quoting, first non-blank line of each
file is a header, blank lines skipped, each line stripped)::

    0 Name  1 Address  2 City  3 Country  4 Region
    5 ProductName  6 ProductCategory  7 ProductCategoryDescription
    8 ProductUnitPrice  9 QuantityOrdered  10 OrderDate      (5-10: ';'-lists)

Line order matters (first-wins rules, OrderID), so every line carries an
order key ``(file_idx, block_start, line_seq)``: the file's rank among
the input paths, the split inside the file, and
``monotonically_increasing_id`` which increases along a split.  Sorting
by the key restores file order without one global sort at read time,
and the key is three numbers, so it is cheap to carry on every entry.

The text is scanned once: the parsed lines (eleven text fields) are
written as Parquet in the shared scratch folder (``stage_lines``) and the
six lists are split and exploded once into an entries table
(``stage_entries``); the table builders then read only the columns they
need instead of re-scanning and re-splitting the text.

A line may hold a third of all entries.  Only the scan sees it as one text: its lists
are cut into chunks of ``CHUNK`` aligned entries, which are dealt to all tasks and split
there, so no row ever holds more than one chunk's entries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions import text
from orderlens.operators.keys import dense_ids
from orderlens.session import Scratch

N_FIELDS = 11
SCALAR_FIELDS = ("Name", "Address", "City", "Country", "Region")
LIST_FIELDS = ("ProductName", "ProductCategory", "ProductCategoryDescription",
               "ProductUnitPrice", "QuantityOrdered", "OrderDate")
ORDER_KEY = ("file_idx", "block_start", "line_seq")

#: Entries of a list that one row may hold; longer lists are cut into chunks of so many.
CHUNK = 256

# Fixed layout of the packed order key (bits per part, most significant
# first): file rank, split start offset, row inside the split, list
# position.  25 + 40 + 33 + 28 = 126 bits, inside decimal(38,0).
FILE_BITS, BLOCK_BITS, ROW_BITS, POS_BITS = 25, 40, 33, 28


def _checked(c: Column, bits: int, what: str) -> Column:
    return F.when(c < F.lit(1 << bits), c).otherwise(
        F.raise_error(F.lit(f"order key overflow: {what} needs more than {bits} bits")))


def _dec(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def packed_place() -> Column:
    """``(block_start, line_seq)`` order inside a file as one decimal(38,0)."""
    row = F.col("line_seq").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    b = _dec(_checked(F.col("block_start"), BLOCK_BITS, "split offset"))
    return b * _dec(F.lit(1 << ROW_BITS)) + _dec(row)


def packed_line_order() -> Column:
    """``(file_idx, block_start, line_seq)`` order as one decimal(38,0).

    Within one split every line comes from the same task, so the task
    part of ``line_seq`` (``monotonically_increasing_id``: task << 33 |
    row) is constant there and only its low 33 bits (the row) matter
    once the file and split are in front.  A single decimal lets ``min``
    run as a hash aggregate (a struct ``min`` needs a sort aggregate).
    """
    f = _dec(_checked(F.col("file_idx").cast("bigint"), FILE_BITS, "file rank"))
    return f * _dec(F.lit(1 << BLOCK_BITS)) * _dec(F.lit(1 << ROW_BITS)) + packed_place()


def packed_entry_order() -> Column:
    """``(file_idx, block_start, line_seq, pos)`` order as one decimal(38,0)."""
    pos = _dec(_checked(F.col("pos").cast("bigint"), POS_BITS, "list position"))
    return packed_line_order() * _dec(F.lit(1 << POS_BITS)) + pos


def read_raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank, stripped lines with ``(file_path, block_start, line_seq)``
    (headers still included; ``stage_lines`` removes them)."""
    raw = spark.read.text(path).select(
        F.col("value"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
    ).withColumn("line_seq", F.monotonically_increasing_id())
    return (raw.filter(~text.is_blank(F.col("value")))
            .select("file_path", "block_start", "line_seq",
                    text.strip_line(F.col("value")).alias("line")))


def parse_lines(lines: DataFrame, sep: str = "\t") -> DataFrame:
    """Split lines into the eleven named text fields.  The six list fields
    stay unsplit here (they are split once, in ``explode_entries``); ``n_entries``
    is the length of the longest and ``n_triples`` that of the shortest of the
    name, category and price lists (the product zip stops there).

    ``n_fields`` keeps the real field count; fields behind the eleventh are
    ignored, and shorter lines are flagged ``ok = false`` and go to the
    reject table.
    """
    f = text.split_fields(F.col("line"), sep)
    names = SCALAR_FIELDS + LIST_FIELDS
    cols = [F.get(F.col("__f"), i).alias(name) for i, name in enumerate(names)]
    entries = {c: text.list_size(F.get(F.col("__f"), names.index(c))) for c in LIST_FIELDS}
    return (lines.withColumn("__f", f)
            .select("file_path", "block_start", "line_seq", F.size("__f").alias("n_fields"),
                    (F.size("__f") >= N_FIELDS).alias("ok"), *cols,
                    F.greatest(*entries.values()).alias("n_entries"),
                    F.least(*[entries[c] for c in ("ProductName", "ProductCategory", "ProductUnitPrice")])
                    .alias("n_triples")))


def read_wide(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Scan + parse (lazy; headers still included)."""
    return parse_lines(read_raw_lines(spark, path), sep)


def stage_lines(parsed: DataFrame, scratch: Scratch) -> DataFrame:
    """Write the parsed lines once, then drop each file's header (its first
    non-blank line) and replace the path by the file's rank ``file_idx``.

    The header positions are one row per input file, ranked by path and joined."""
    staged = scratch.pin(parsed, "wide_lines")
    firsts = staged.groupBy("file_path").agg(F.min(packed_place()).alias("__hdr"))
    ranked = (dense_ids(firsts, ["file_path"], "file_idx", scratch)
              .withColumn("file_idx", F.col("file_idx").cast("int")))
    return (staged.join(ranked, "file_path")
            .filter(packed_place() != F.col("__hdr"))
            .drop("__hdr", "file_path")
            .select(*ORDER_KEY, *[c for c in staged.columns if c not in ORDER_KEY
                                  and c != "file_path"]))


def list_chunks(lines: DataFrame, keep: Sequence[str] = ("n_triples",), lists: Sequence[str] = LIST_FIELDS) -> DataFrame:
    """The lists of lines in chunks of ``CHUNK`` aligned entries: a row per chunk with its number
    ``chunk`` and its piece of each list, NULL behind a list's end.  The chunks are dealt by line
    and number, so one line's are spread over the tasks."""
    pieces = F.arrays_zip(*[text.list_chunks(F.col(c), CHUNK).alias(c) for c in lists])
    return (lines.select(*ORDER_KEY, *keep, F.posexplode(pieces).alias("chunk", "e"))
            .select(*ORDER_KEY, *keep, "chunk", *[F.col("e." + c).alias(c) for c in lists])
            .repartition(*ORDER_KEY, "chunk"))


def list_parts(lines: DataFrame, keep: Sequence[str] = ("n_triples",), lists: Sequence[str] = LIST_FIELDS) -> DataFrame:
    """The lists of the ``ok`` lines, whole or in chunks: no row holds more than ``CHUNK`` entries."""
    ok = lines.filter(F.col("ok"))
    whole = ok.filter(F.col("n_entries") <= CHUNK).select(*ORDER_KEY, *keep, F.lit(0).alias("chunk"), *lists)
    return whole.unionByName(list_chunks(ok.filter(F.col("n_entries") > CHUNK), keep, lists))


def explode_parts(parts: DataFrame, keep: Sequence[str] = ("n_triples",), lists: Sequence[str] = LIST_FIELDS) -> DataFrame:
    """One row per list position of such parts, with the position in the whole line."""
    none = F.array().cast("array<string>")
    z = F.arrays_zip(*[F.coalesce(text.split_list(F.col(c)), none).alias(c) for c in lists])
    return (parts
            .select(*ORDER_KEY, *keep, "chunk", F.posexplode(z).alias("place", "e"))
            .select(*ORDER_KEY, (F.col("chunk") * CHUNK + F.col("place")).alias("pos"), *keep,
                    *[F.col("e." + c).alias(c) for c in lists]))


def explode_entries(lines: DataFrame) -> DataFrame:
    """One row per list position of every ``ok`` line: the six list values
    at that position (NULL where a list is shorter), the position, and
    ``n_triples``.  The lists are zipped before exploding, so a row carries only its
    own entry; lists of more than ``CHUNK`` entries are cut into chunks before that.
    """
    return explode_parts(list_parts(lines))


def stage_entries(lines: DataFrame, scratch: Scratch) -> DataFrame:
    """Explode once and write the entries (columnar) for the category,
    product and order builders."""
    return scratch.pin(explode_entries(lines), "wide_entries")


def rejected_lines(parsed: DataFrame) -> DataFrame:
    """Lines with a wrong field count, as reject rows."""
    return parsed.filter(~F.col("ok")).select(
        *ORDER_KEY, F.lit(-1).cast("int").alias("pos"),
        F.concat(F.lit("field count "), F.col("n_fields").cast("string")).alias("reason"))
