"""The rental model laid over the TPC-H-like test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlane.operators import dims, scd2
from starlane.plans.fact import build_fact
from starlane.schemas import CAR_DIM, CUSTOMER_DIM, DATED_FACT
from starlane.session import fresh_path, shared_folder
from starlane.sinks.fact import replace_days
from starlane.sinks.tables import replace_table
from starlane.sources.rentals import write_rentals

ROWS_PER_ARRAY, PLAIN = 200_000, 16
CALENDAR = ("1996-01-01", "2001-12-31")
DAY_1, DAY_2 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"
# The rentals lie in 1995-2001, so the as-of lookups use batches of these days.
EARLY_1, EARLY_2 = "1998-01-01 00:00:00", "2000-01-01 00:00:00"

_paths: dict[tuple[str, str, str, str], str] = {}
_schemas: dict[tuple[str, str], T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its footer is read for the schema only the first time."""
    path = f"{sf_dir}/{name}.parquet"
    if (sf_dir, name) not in _schemas:
        _schemas[sf_dir, name] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[sf_dir, name]).parquet(path)


def once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """The path of a table that ``write`` fills once per session; later calls only read it."""
    slot = (spark.sparkContext.applicationId, shared_folder(spark), sf_dir, name)
    if slot not in _paths:
        path = fresh_path(spark, name)
        write(path)
        _paths[slot] = path
    return _paths[slot]


def _stored(
    spark: SparkSession, sf_dir: str, name: str, schema: T.StructType, build: Callable[[], DataFrame]
) -> DataFrame:
    """A dimension as a stored table, so that the planner knows its real size."""
    path = once(spark, sf_dir, name, lambda p: replace_table(build(), p, schema))
    return spark.read.schema(schema).parquet(path)


def _rental_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that are rentals, with what their fields are made of."""
    def read(name: str) -> DataFrame:
        return table(spark, sf_dir, name)

    pickup = read("nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("pickup_location")
    )
    dropoff = read("nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("dropoff_location")
    )
    # Customers go to orders before the lines: a line is shuffled once for its order and once
    # for its part, and only where those are large. Nations are joined last: their keys are narrower.
    customers = read("customer").select("c_custkey", "c_nationkey")
    orders = read("orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return (
        read("lineitem")
        .join(read("supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(read("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(pickup, "c_nationkey")
        .join(dropoff, "s_nationkey")
    )


def _rental_columns() -> list[Column]:
    start = F.col("o_orderdate").cast("date")
    days = ((F.col("l_orderkey") + 3 * F.col("l_linenumber")) % 15).cast("int")
    return [
        F.concat_ws(
            "-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")
        ).alias("rental_id"),
        F.when(F.col("l_orderkey") % 97 != 0, F.col("o_custkey").cast("string")).alias("customer_id"),
        F.struct(
            F.col("p_brand").alias("make"),
            F.col("p_type").alias("model"),
            F.col("p_size").alias("year"),
        ).alias("car"),
        F.struct(
            start.cast("string").alias("start_date"),
            F.date_add(start, days).cast("string").alias("end_date"),
        ).alias("rental_period"),
        F.struct("pickup_location", "dropoff_location").alias("rental_location"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.trunc(start, "year").alias("batch_date"),
    ]


def rentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested rentals with their ``batch_date``."""
    return _rental_lines(spark, sf_dir).select(*_rental_columns())


def stored_rentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rentals`` as a stored table, for queries that read them several times: they are joined once."""
    made = rentals(spark, sf_dir)
    path = once(spark, sf_dir, "rentals", lambda p: made.write.parquet(p))
    return spark.read.schema(made.schema).parquet(path)


def rental_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer of each rental, and its order, by the two tables they take."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.when(F.col("l_orderkey") % 97 != 0, F.col("o_custkey").cast("string")).alias("customer_id"),
        F.col("l_orderkey").alias("order"),
    )


def car_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build() -> DataFrame:
        parts = table(spark, sf_dir, "part").filter("p_size <= 45")
        return dims.cars_from(parts.select(
            F.col("p_brand").alias("make"), F.col("p_type").alias("model"), F.col("p_size").alias("year")
        ))

    return _stored(spark, sf_dir, "car_dim", CAR_DIM, build)


def location_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey").cast("long") + 1
    return table(spark, sf_dir, "nation").filter("n_nationkey % 10 <> 9").select(
        key.alias("location_key"),
        F.concat(F.lit("LOC"), F.lpad(key.cast("string"), 3, "0")).alias("location_id"),
        F.col("n_name").alias("location_name"),
    )


def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.calendar(spark, *CALENDAR)


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey"),
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("email"),
        F.col("c_nationkey").cast("string").alias("phone"),
    )


# The two customer files: each misses some customers of the other, so that there are
# new and absent ones; together they hold the whole table.


def batch_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    email = F.when(F.col("c_custkey") % 13 != 0, F.col("email"))
    return (
        _customers(spark, sf_dir).filter("c_custkey % 10 < 8")
        .withColumn("email", email).drop("c_custkey")
    )


def batch_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    email = F.when(F.col("c_custkey") % 7 == 0, F.lit("CHANGED")).otherwise(F.col("email"))
    phone = F.when(F.col("c_custkey") % 11 != 0, F.col("phone"))
    return (
        _customers(spark, sf_dir).filter("c_custkey % 10 >= 2")
        .withColumns({"email": email, "phone": phone}).drop("c_custkey")
    )


def customer_dim_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After the first batch."""
    return _stored(spark, sf_dir, "customer_dim_1", CUSTOMER_DIM, lambda: scd2.initial(batch_1(spark, sf_dir), DAY_1))


def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After both batches."""
    return _stored(spark, sf_dir, "customer_dim", CUSTOMER_DIM, lambda: scd2.apply(
        customer_dim_1(spark, sf_dir), batch_2(spark, sf_dir), DAY_2
    ))


def customer_dim_early(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After both batches, dated within the rentals' years."""
    return _stored(spark, sf_dir, "customer_dim_early", CUSTOMER_DIM, lambda: scd2.apply(
        scd2.initial(batch_1(spark, sf_dir), EARLY_1), batch_2(spark, sf_dir), EARLY_2
    ))


def customer_dim_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After both batches by the literal rule, which leaves several current versions."""
    return _stored(spark, sf_dir, "customer_dim_literal", CUSTOMER_DIM, lambda: scd2.apply_literal(
        customer_dim_1(spark, sf_dir), batch_2(spark, sf_dir), DAY_2
    ))


def dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "car_dim": car_dim(spark, sf_dir),
        "location_dim": location_dim(spark, sf_dir),
        "date_dim": date_dim(spark, sf_dir),
        "customer_dim": customer_dim(spark, sf_dir),
    }


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A monthly customer snapshot per order, so customers repeat within a month."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.lit("Customer").alias("name"),
        F.col("o_orderstatus").alias("email"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("phone"),
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("batch_date"),
        F.col("o_orderdate").alias("seen_at"),
        F.col("o_orderkey").alias("seen_key"),
    )


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored fact. Its days are few, so each task writes its rows of each: no shuffle by day."""
    path = once(spark, sf_dir, "rentals_fact", lambda p: replace_days(
        build_fact(rentals(spark, sf_dir), dimensions(spark, sf_dir)), p, together=False
    ))
    return spark.read.schema(DATED_FACT).parquet(path)


def rental_files(spark: SparkSession, sf_dir: str) -> str:
    """All rentals as JSON files in a folder per batch date."""
    return once(spark, sf_dir, "rental_files", lambda p: write_rentals(rentals(spark, sf_dir), p))


def backdate(spark: SparkSession, files: str, folder: str, days: int) -> None:
    """Give the files of a folder a time stamp so many days back, as a copy with kept times has."""
    there = spark._jvm.org.apache.hadoop.fs.Path(f"{files}/{folder}")
    system = there.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(there):
        for status in system.listStatus(there):
            old = status.getModificationTime() - days * 24 * 3600 * 1000
            system.setTimes(status.getPath(), old, -1)


def replace_files(spark: SparkSession, files: str, folder: str, other: str) -> None:
    """Give every file of a folder the content of the first file of another one, under its old name."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(files).getFileSystem(spark._jsc.hadoopConfiguration())
    utility, conf = spark._jvm.org.apache.hadoop.fs.FileUtil, spark._jsc.hadoopConfiguration()
    if not (system.exists(path(f"{files}/{folder}")) and system.exists(path(f"{files}/{other}"))):
        return
    first = system.listStatus(path(f"{files}/{other}"))[0].getPath()
    for status in system.listStatus(path(f"{files}/{folder}")):
        utility.copy(system, first, system, status.getPath(), False, True, conf)


def segments_of(customers: DataFrame, sf_dir: str) -> DataFrame:
    """customer_key -> market segment."""
    named = table(customers.sparkSession, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_mktsegment").alias("segment")
    )
    return customers.join(named, "customer_id").select("customer_key", "segment")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments_of(customer_dim(spark, sf_dir), sf_dir)


def array_files(spark: SparkSession, sf_dir: str) -> str:
    """All rentals as files that each hold one JSON array, in a single line.

    Names of fields make most of the text, so files are compressed, and then each is read by one task. One file
    in ``PLAIN`` is not, and tasks share it.
    """
    files = table(spark, sf_dir, "lineitem").count() // ROWS_PER_ARRAY + 1
    # The file hangs on columns of lines alone, so lines of other files are left out before they are joined.
    lines = _rental_lines(spark, sf_dir).withColumn(
        "file", F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"), F.lit(files))
    )
    by_file = W.partitionBy("file").orderBy("l_orderkey", "l_linenumber")

    def write_some(some: DataFrame, path: str, compression: str) -> None:
        # What fields are made of is shuffled, not their text. Rows come by file and place; no line break parts them.
        marked = some.select(
            "*", F.row_number().over(by_file).alias("place"), F.lead(F.lit(True)).over(by_file).alias("more")
        )
        made = marked.select(*_rental_columns(), "file", "place", "more")
        value = F.to_json(F.struct(*[c for c in made.columns if c not in ("batch_date", "file", "place", "more")]))
        line = F.concat(
            F.when(F.col("place") == 1, "[").otherwise(""), value, F.when(F.col("more"), ",").otherwise("]")
        )
        ordered = made.sortWithinPartitions("file", "place").select("file", line.alias("value"))
        ordered.write.mode("append").partitionBy("file").option("lineSep", " ").text(path, compression=compression)

    def write(path: str) -> None:
        plain = F.col("file") % PLAIN == 0
        write_some(lines.filter(plain), path, "none")
        if files > 1:
            write_some(lines.filter(~plain), path, "gzip")

    return once(spark, sf_dir, "array_files", write)
