from datetime import datetime, timedelta

from pyspark.sql import functions as F

START = datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else START + timedelta(minutes=minutes)


def series(spark, rows, schema):
    """Rows whose `ts` fields are minutes from the start, as timestamp_ntz."""
    names = [part.split()[0] for part in schema.split(",")]
    stamped = [i for i, part in enumerate(schema.split(",")) if part.split()[1] == "ts"]
    fixed = [tuple(at(v) if i in stamped else v for i, v in enumerate(row)) for row in rows]
    ddl = ", ".join(f"{n} timestamp_ntz" if i in stamped else schema.split(",")[i] for i, n in enumerate(names))
    return spark.createDataFrame(fixed, ddl)


def table(df, *order):
    rows = df.orderBy(*order).collect() if order else df.collect()
    return [tuple(r) for r in rows]


def minutes(value):
    return None if value is None else (value - START).total_seconds() / 60


def same(a, b, digits=9):
    """Row lists equal up to float noise."""
    def norm(rows):
        return [tuple(round(v, digits) if isinstance(v, float) else v for v in r) for r in rows]
    assert norm(a) == norm(b)


def lit_rows(spark, n):
    return spark.range(n).withColumn("x", F.col("id").cast("double"))
