"""File order as a sortable column."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.runtime import written


def file_order() -> Column:
    """Position of a row: folder, number of a part file, file path, block, place within the block.

    Part files go by their number, as `part-100000` would stand before `part-99999` by its name; files
    with other names go before them by name. A block is read by one task, so the running id orders
    its rows. No extra pass and no global sort is needed. Only the order is stable, not the numbers,
    as they depend on how files are split: rows must be written out (`numbered`) before two uses of
    them are joined on this column.
    """
    file = F.col("_metadata.file_path")
    number = F.regexp_extract(file, r"/part-([0-9]{1,18})[^/]*$", 1)
    return F.struct(
        F.regexp_extract(file, r"^(.*/)[^/]*$", 1).alias("folder"),
        F.when(number != "", number.cast("long")).alias("part"),
        file.alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )


def numbered(rows: DataFrame) -> DataFrame:
    """Rows with their file order fixed, by writing them to the shared folder once; readers take what they need."""
    return written(rows, "numbered")
