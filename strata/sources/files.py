"""CSV sources with declared schemas (never inferred).

Fixed source schemas (DDL), as the reference declares them, except that
``products.is_active`` is read as text and mapped explicitly: the files
carry 1/0, which a BOOLEAN CSV column turns into NULL (H6).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PRODUCTS_SCHEMA = (
    "product_id INT, product_name STRING, category STRING, subcategory STRING, "
    "brand STRING, unit_cost DECIMAL(10,2), list_price DECIMAL(10,2), is_active STRING"
)
FX_SCHEMA = "rate_date DATE, base_currency STRING, quote_currency STRING, rate DECIMAL(12,6)"

TRUE_WORDS = ["1", "true", "t", "yes", "y"]
FALSE_WORDS = ["0", "false", "f", "no", "n"]


#: The text of a line with a value that its column's type cannot hold; NULL
#: where all could be read.  It goes with the row to bronze and quarantine.
MALFORMED_LINE = "_malformed_line"


def csv_scan(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """Declared-schema CSV read; malformed values become NULL (PERMISSIVE)
    and are caught by the silver checks rather than failing the job; the line
    they stood in is kept beside them.  An incremental read keeps rows whose
    watermark is NULL (``keep_unmarked``), so they get there on every run, not
    on the first alone."""
    return spark.read.csv(
        path, header=header, schema=f"{schema}, {MALFORMED_LINE} STRING", mode="PERMISSIVE", columnNameOfCorruptRecord=MALFORMED_LINE
    )


def parse_flag(col: str) -> F.Column:
    v = F.lower(F.trim(F.col(col)))
    return F.when(v.isin(TRUE_WORDS), F.lit(True)).when(v.isin(FALSE_WORDS), F.lit(False))


def products_csv(spark: SparkSession, path: str) -> DataFrame:
    """Products file; ``is_active`` 1/0/true/false -> boolean."""
    df = csv_scan(spark, path, PRODUCTS_SCHEMA)
    return df.withColumn("is_active", parse_flag("is_active"))


def exchange_rates_csv(spark: SparkSession, path: str) -> DataFrame:
    """The whole rates file; the watermark filter is applied by the
    extractor (``watermark.since``) and pushed into the CSV scan."""
    return csv_scan(spark, path, FX_SCHEMA)
