"""Writers and readers over the given tables: what is written and read back must be the table."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from stayloom.driver.registry import query
from stayloom.driver.views import Views
from stayloom.session import shared_folder
from stayloom.sources import sinks
from stayloom.sources.folders import read_csv, require
from stayloom.sources.ingest import ingest_csv


def place(v: Views) -> str:
    return f"{shared_folder(v.spark)}/stored-{uuid.uuid4().hex}"


@query(
    "csv_gzip_source",
    """SELECT doc_id AS hadm_id, lpad(CAST(doc_id AS VARCHAR), 12, '0') AS code, lang, source, text,
              CAST(n_chars AS DOUBLE) / 7 AS valuenum FROM documents""",
)
def _(v: Views):
    """Texts with quotes and line breaks, codes with leading zeros and numbers from compressed CSV files."""
    path = f"{place(v)}.csv.gz"
    rows = v["documents"].select(
        F.col("doc_id").alias("hadm_id"), F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("code"), "lang", "source",
        "text", (F.col("n_chars").cast("double") / 7).alias("valuenum"),
    )
    rows.write.options(header=True, quote='"', escape='"', compression="gzip").csv(path)
    return read_csv(v.spark, path, multi_line=True)


@query("matrix_round_trip", "SELECT l_orderkey AS stay_id, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def _(v: Views):
    """Feature columns stored as one array per key, with their names beside."""
    path, names = place(v), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    sinks.write_matrix(v["lineitem"].withColumnRenamed("l_orderkey", "stay_id"), path, names)
    return sinks.read_matrix(v.spark, path)


@query("records_round_trip", "SELECT conv_id, turn, role, nullif(text, '') AS text, CASE WHEN turn % 2 = 0 THEN turn END AS even FROM conversations")
def _(v: Views):
    """One JSON object per line, missing values kept."""
    path, source = place(v), v["conversations"]
    text = F.when(F.col("text") != "", F.col("text")).alias("text")
    rows = source.select("conv_id", "turn", "role", text, F.when(F.col("turn") % 2 == 0, F.col("turn")).alias("even"))
    sinks.write_records(rows, path)
    return sinks.read_records(v.spark, path, rows.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "))


@query("finished_table_is_kept", "SELECT * FROM orders")
def _(v: Views):
    """A table that was written to the end is not written again; an unfinished folder is."""
    path, other = place(v), v["orders"].withColumn("o_orderstatus", F.lit("changed"))
    assert sinks.write_table(v["orders"], path) and not sinks.write_table(other, path)
    return v.spark.read.parquet(path)


@query(
    "stay_groups",
    """SELECT o_orderkey AS stay_id, CASE WHEN o_orderkey % 16 IN (3, 7) THEN 'revised' ELSE o_orderstatus END AS o_orderstatus,
              CAST(o_orderkey % 16 AS INTEGER) AS stay_group FROM orders""",
)
def _(v: Views):
    """Stored by stay group; writing the stays of two groups anew leaves the others as they are."""
    path, rows = place(v), v["orders"].select(F.col("o_orderkey").alias("stay_id"), "o_orderstatus")
    sinks.write_by_stay(rows, path, groups=16)
    some = rows.where((F.col("stay_id") % 16).isin(3, 7)).withColumn("o_orderstatus", F.lit("revised"))
    sinks.write_by_stay(some, path, groups=16)
    return v.spark.read.parquet(path).select("stay_id", "o_orderstatus", F.col("stay_group").cast("int").alias("stay_group"))


@query(
    "csv_ingest",
    """SELECT l_orderkey, l_linenumber, lpad(CAST(l_partkey AS VARCHAR), 9, '0') AS part_code, l_extendedprice,
              CASE WHEN l_linenumber <> 3 THEN l_shipdate END AS ship_time, l_returnflag,
              CASE WHEN l_orderkey % 1000 = 7 THEN 'n/a' ELSE CAST(l_suppkey AS VARCHAR) END AS mixed,
              CAST(l_orderkey AS BIGINT) AS hadm_id FROM lineitem""",
)
def _(v: Views):
    """A compressed CSV file read once; columns without a declared type get the one all their values have."""
    path, target = f"{place(v)}.csv.gz", place(v)
    rows = v["lineitem"].select(
        "l_orderkey", "l_linenumber", F.lpad(F.col("l_partkey").cast("string"), 9, "0").alias("part_code"), "l_extendedprice",
        F.when(F.col("l_linenumber") != 3, F.col("l_shipdate")).alias("ship_time"), "l_returnflag",
        F.when(F.col("l_orderkey") % 1000 == 7, "n/a").otherwise(F.col("l_suppkey").cast("string")).alias("mixed"),
        F.col("l_orderkey").alias("hadm_id"),
    )
    rows.write.options(header=True, quote='"', escape='"', compression="gzip", timestampNTZFormat="yyyy-MM-dd HH:mm:ss").csv(path)
    first, again = (ingest_csv(v.spark, path, target) for _ in range(2))
    assert first.wrote and not again.wrote
    data = again.data
    return data.withColumn("l_linenumber", F.col("l_linenumber").cast(v["lineitem"].schema["l_linenumber"].dataType))


@query("csv_round_trip", "SELECT doc_id, text, lang, n_chars FROM documents")
def _(v: Views):
    """A table written as CSV and read back: texts with quotes and line breaks."""
    path, rows = place(v), v["documents"].select("doc_id", "text", "lang", "n_chars")
    sinks.write_csv(rows, path)
    return sinks.read_written_csv(v.spark, path, "doc_id bigint, text string, lang string, n_chars bigint")


@query(
    "stay_groups_resume",
    """SELECT o_orderkey AS stay_id, o_totalprice, CASE WHEN o_orderkey % 16 < 8 THEN 'first' ELSE 'second' END AS run FROM orders""",
)
def _(v: Views):
    """A run that breaks off after two of four batches of stay groups; the next computes the others alone."""
    path, stays = place(v), v["orders"].select(F.col("o_orderkey").alias("stay_id"))
    prices = v["orders"].select(F.col("o_orderkey").alias("stay_id"), "o_totalprice")
    begun = []

    def make(run: str, breaks_at: int):
        def rows(some):
            begun.append(run)
            if len(begun) == breaks_at:
                raise InterruptedError(run)
            return prices.join(some, "stay_id", "left_semi").withColumn("run", F.lit(run))

        return rows

    try:
        sinks.write_missing_groups(stays, make("first", 3), path, groups=16, batch=4)
    except InterruptedError:
        pass
    assert sinks.write_missing_groups(stays, make("second", 0), path, groups=16, batch=4) == list(range(8, 16))
    return v.spark.read.parquet(path).select("stay_id", "o_totalprice", "run")


@query("required_tables", "SELECT o_orderkey, 'orders' AS found, 'expected tables not found: nowhere' AS said FROM orders")
def _(v: Views):
    """What a step needs of the one before: written tables are read, a missing one is named."""
    path = place(v)
    sinks.write_table(v["orders"], f"{path}/orders.parquet")
    try:
        require(v.spark, path, ["orders", "nowhere"])
        said = ""
    except FileNotFoundError as error:
        said = str(error).replace(f" in {path}", "")
    return require(v.spark, path, ["orders"])["orders"].select("o_orderkey", F.lit("orders").alias("found"), F.lit(said).alias("said"))


@query("export_descending", "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS out_of_order FROM orders")
def _(v: Views):
    """A table exported from the greatest key down: no row of its files, in name order, exceeds the one before."""
    path = place(v)
    sinks.write_table(v["orders"], path, sort_by=["o_totalprice", "o_orderkey"], ascending=False)
    key = F.struct("o_totalprice", "o_orderkey")
    rows = v.spark.read.parquet(path).select(
        key.alias("key"), F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("row")
    )
    before = F.lag("key").over(Window.partitionBy("file").orderBy("row"))
    inside = rows.select("file", "key", (before < F.col("key")).alias("wrong")).groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("wrong").alias("wrong"), F.max("key").alias("high"), F.min("key").alias("low")
    )
    # One row per file from here on.
    across = inside.withColumn("over", (F.lag("low").over(Window.orderBy("file")) < F.col("high")).cast("int"))
    return across.agg(F.sum("n").alias("n_rows"), (F.sum("wrong") + F.coalesce(F.sum("over"), F.lit(0))).alias("out_of_order"))
