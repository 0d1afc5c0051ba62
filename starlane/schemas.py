"""Table and file schemas, declared once; nothing is inferred at run time."""

from __future__ import annotations

from pyspark.sql import types as T

RENTAL = T.StructType([
    T.StructField("rental_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("car", T.StructType([
        T.StructField("make", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("year", T.IntegerType()),
    ])),
    T.StructField("rental_period", T.StructType([
        T.StructField("start_date", T.StringType()),
        T.StructField("end_date", T.StringType()),
    ])),
    T.StructField("rental_location", T.StructType([
        T.StructField("pickup_location", T.StringType()),
        T.StructField("dropoff_location", T.StringType()),
    ])),
    T.StructField("amount", T.DoubleType()),
    T.StructField("quantity", T.IntegerType()),
])

CUSTOMER_BATCH = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("phone", T.StringType()),
])

LOCATION_DIM = T.StructType([
    T.StructField("location_key", T.LongType(), False),
    T.StructField("location_id", T.StringType(), False),
    T.StructField("location_name", T.StringType()),
])

CAR_DIM = T.StructType([
    T.StructField("car_key", T.LongType(), False),
    T.StructField("car_id", T.StringType(), False),
    T.StructField("make", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("year", T.IntegerType()),
])

DATE_DIM = T.StructType([
    T.StructField("date_key", T.IntegerType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("quarter", T.IntegerType()),
])

CUSTOMER_DIM = T.StructType([
    T.StructField("customer_key", T.LongType(), False),
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("phone", T.StringType()),
    T.StructField("effective_date", T.TimestampNTZType()),
    T.StructField("end_date", T.TimestampNTZType()),
    T.StructField("is_current", T.BooleanType()),
])

RENTALS_FACT = T.StructType([
    T.StructField("rental_id", T.StringType(), False),
    T.StructField("customer_key", T.LongType()),
    T.StructField("car_key", T.LongType()),
    T.StructField("pickup_location_key", T.LongType()),
    T.StructField("dropoff_location_key", T.LongType()),
    T.StructField("start_date_key", T.IntegerType()),
    T.StructField("end_date_key", T.IntegerType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("rental_duration_days", T.IntegerType()),
    T.StructField("total_rental_amount", T.DoubleType()),
    T.StructField("average_daily_rental_amount", T.DoubleType()),
    T.StructField("is_long_rental", T.BooleanType()),
])

# The stored fact also carries the day that loaded it, as its partition.
DATED_FACT = T.StructType([*RENTALS_FACT.fields, T.StructField("batch_date", T.DateType())])

FACT_COLUMNS = RENTALS_FACT.fieldNames()
CUSTOMER_ATTRIBUTES = ("name", "email", "phone")

# Foreign keys of the fact: fact column -> (dimension, key column).
FACT_REFERENCES = {
    "customer_key": ("customer_dim", "customer_key"),
    "car_key": ("car_dim", "car_key"),
    "pickup_location_key": ("location_dim", "location_key"),
    "dropoff_location_key": ("location_dim", "location_key"),
    "start_date_key": ("date_dim", "date_key"),
    "end_date_key": ("date_dim", "date_key"),
}
