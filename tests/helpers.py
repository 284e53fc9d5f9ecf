"""Small hand-made frames."""

from datetime import datetime, timedelta

from airmart import schemas as S

START = datetime(2024, 1, 1)


def at(hour: float) -> datetime:
    return START + timedelta(hours=hour)


def table(spark, kind, rows, series=()):
    """Raw table from dicts; ``h`` is hours after START, other measures default to 1.0."""
    schema = S.table_schema(kind, series)
    data = []
    for row in rows:
        filled = []
        for field in schema.fields:
            if field.name == S.TIME:
                filled.append(None if row["h"] is None else at(row["h"]))
            elif field.name in row:
                value = row[field.name]
                filled.append(float(value) if isinstance(value, int) and field.name not in S.INTEGER_COLUMNS else value)
            else:
                filled.append(1 if field.name in S.INTEGER_COLUMNS else 1.0)
        data.append(tuple(filled))
    return spark.createDataFrame(data, schema)


def column(df, name, order="OBSERVATION_TIME"):
    return [r[name] for r in df.orderBy(order).collect()]
