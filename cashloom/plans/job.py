"""Files in, events out: contracts, market data and analysis date to the declared event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cashloom.operators.schedule import OK, with_event_dates
from cashloom.operators.states import EVENT_TERMS, flat_events, number_of_events
from cashloom.plans.pam import evaluate
from cashloom.session import drop_folder, new_folder
from cashloom.sources.analysis_date import first_date
from cashloom.sources.contracts import KEEP_GOOD, parse_contracts
from cashloom.sources.lines import read_lines
from cashloom.sources.market import last_per_code, parse_market

# Columns of the event table, none of which is ever null.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("date", T.StringType(), False),
        T.StructField("type", T.StringType(), False),
        T.StructField("currency", T.StringType(), False),
        T.StructField("value", T.DoubleType(), False),
        T.StructField("nominal", T.DoubleType(), False),
        T.StructField("accrued", T.DoubleType(), False),
    ]
)


def declared(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """``rows`` with just the columns, types and nullability of ``schema``.

    A null in a column that has none ends the job, and a column that is missing the planning.
    """

    def column(field: T.StructField) -> F.Column:
        value = F.col(field.name).cast(field.dataType)
        if field.nullable:
            return value.alias(field.name)
        complaint = F.raise_error(f"{field.name} is null, and declared as never null").cast(field.dataType)
        never_used = F.lit("" if isinstance(field.dataType, T.StringType) else 0).cast(field.dataType)
        return F.coalesce(F.when(value.isNull(), complaint).otherwise(value), never_used).alias(field.name)

    return rows.select(*[column(f) for f in schema.fields]).to(schema)


def events_from_files(
    spark: SparkSession, contracts: str, market: str, date: str, events: str, statuses: str, on_error: str = KEEP_GOOD
) -> None:
    """Reads the three files and writes two tables.

    ``events`` has the events of all contracts without a fault, ``statuses`` a row for every contract
    line: ``id``, what is wrong with it, how its market data were found, and how many events its
    terms give.
    """
    terms = parse_contracts(read_lines(spark, contracts), on_error=on_error)
    objects = last_per_code(parse_market(read_lines(spark, market)))
    evaluated = evaluate(terms, first_date(read_lines(spark, date)), objects)
    # evaluated once, and stored a row a contract, which is a fraction of its events; those are written once
    kept = ["contract_status", "reset_status"]
    rows = evaluated.selectExpr(*kept, f"{number_of_events()} AS n_events", *EVENT_TERMS)
    staged = new_folder(spark, "evaluated")
    rows.write.parquet(staged)
    stored = spark.read.schema(rows.schema).parquet(staged)
    given = flat_events(with_event_dates(stored.where(F.col("contract_status") == OK))).withColumnRenamed("contract_id", "id")
    declared(given, EVENT_SCHEMA).write.parquet(events)
    stored.select(*kept, F.col("contract_id").alias("id"), "n_events").write.parquet(statuses)
    drop_folder(spark, staged)
