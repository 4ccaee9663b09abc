"""Orders laid out for deep pages: files that follow one another in (instant, id) order.

The table is range-partitioned and sorted by the page order, and a small table next to it says, for
each file, the first and the last (instant, id) that it holds and how many rows. A keyset page then needs
the file that holds its cursor and the next ones until it is full, however deep it lies: they are
chosen from the bounds, and the bound on the instant is pushed into their scan as well.

Layout: ``{path}/data`` and ``{path}/bounds``, the latter written last. A table is written once; a newer one
goes to another path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import INSTANT_PREFIX, instant_column
from ..operators.paging import SORT_FIELDS, decode_cursor, sort_columns
from ..functions.instants import parse_instant_py
from ..functions.text import normalize_py
from ..plans.catalog import ORDERS, normalize_filters, require_source, resolve_sort_key
from ..plans.spec import Plan, ReadSpec, as_flag, read_orders

#: Rows of a file.
FILE_ROWS = 1_000_000
#: Files that a page opens at first; twice as many each time they do not fill it.
FIRST_FILES = 2


def write_clustered(orders: DataFrame, path: str, sort_key: str = "UPDATED_AT", file_rows: int = FILE_ROWS, id_col: str = "id") -> None:
    """Write ``orders`` (an order table with ids that are not null) in the page order of ``sort_key``."""
    spark, base = orders.sparkSession, path.rstrip("/")
    shadow = INSTANT_PREFIX + SORT_FIELDS[sort_key]
    # the instant is stored typed, whatever the input had, so that its bound reaches the scan
    typed = orders.withColumn(shadow, instant_column(orders, SORT_FIELDS[sort_key]).cast("timestamp"))
    order = sort_columns(typed, sort_key, False, id_col)
    typed.repartitionByRange(*order).sortWithinPartitions(*order).write.option("maxRecordsPerFile", file_rows).parquet(f"{base}/data")
    place = F.when(F.col(shadow).isNotNull(), F.struct(F.col(shadow).alias("at"), F.col(id_col).alias("id")))
    spark.read.parquet(f"{base}/data").groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(place).alias("first"), F.max(place).alias("last"), F.count_if(F.col(shadow).isNull()).alias("missing"),
        F.count(F.lit(1)).alias("rows")).withColumn("sort_key", F.lit(sort_key)).write.parquet(f"{base}/bounds")


def _files(bounds: DataFrame, cursor: tuple | None, reverse: bool, most: int) -> list[str]:
    """The first ``most`` files, in page order, that can hold rows after the cursor. Rows without an instant
    come last in either order, so every file that has some is among them; behind a cursor that has none
    there are no others."""
    at = parse_instant_py(cursor[0]) if cursor is not None and cursor[0] is not None else None
    if cursor is not None:
        missing = F.col("missing") > 0
        if at is None:
            return [r["file"] for r in bounds.filter(missing).select("file").collect()]
        edge = F.struct(F.lit(at.isoformat(sep=" ") + "Z").cast("timestamp").alias("at"), F.lit(cursor[1]).alias("id"))
        bounds = bounds.filter(missing | (F.col("first") < edge if reverse else F.col("last") > edge))
    order = [F.col("last").desc_nulls_last(), F.col("file").desc()] if reverse else [F.col("first").asc_nulls_last(), F.col("file").asc()]
    return [r["file"] for r in bounds.orderBy(*order).limit(most).select("file").collect()]


def read_clustered_page(spark: SparkSession, path: str, spec: ReadSpec, line_items: DataFrame | None = None,
                        line_item_order=("position",)) -> Plan:
    """S3 over a table of :func:`write_clustered`: the page that :func:`read_orders` gives, from as many
    files as it takes. Filters other than the page order's may ask for further files; their number
    doubles until the page is full, so a page never reads more than twice what it has to. A page in
    another order than the table's reads the whole table."""
    base = path.rstrip("/")
    bounds = spark.read.parquet(f"{base}/bounds")
    source = require_source(spec.source_id or ORDERS, spec.api_version)
    key = resolve_sort_key(source, normalize_filters(source, spec.filters))
    stored = bounds.select("sort_key").first()
    after = normalize_py(spec.after)
    if stored is None or stored["sort_key"] != key:
        return read_orders(spark.read.parquet(f"{base}/data"), spec, line_items, line_item_order)
    cursor, reverse = decode_cursor(after) if after else None, as_flag(spec.reverse)
    whole = spark.read.parquet(f"{base}/data")
    instant = F.col(INSTANT_PREFIX + SORT_FIELDS[key])
    most = FIRST_FILES
    while True:
        files = _files(bounds, cursor, reverse, most)
        table = spark.read.schema(whole.schema).parquet(*files) if files else whole.limit(0)
        plan = read_orders(table, spec, line_items, line_item_order)
        # in descending order a row without an instant may stand behind rows of files not opened yet
        certain = plan.page.probe.filter(instant.isNotNull()) if reverse else plan.page.probe
        if len(files) != most or certain.count() > plan.page_size:
            return plan
        most *= 2
