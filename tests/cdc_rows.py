"""Hand-written change records."""

import datetime as dt
import json

from pyspark.sql import functions as F

from millrace.operators.cdc import parse_envelope
from millrace.schemas import CUSTOMERS, RECORD

AS_OF = dt.datetime(2024, 1, 31)
BORN = 1_700_000_000_000_000


def ms(text):
    moment = dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)
    return int(moment.timestamp() * 1000)


def image(id, email="a@x", country="EE", **more):
    return {
        "id": id, "name": f"n{id}", "email": email, "country": country, "created_at": BORN, **more
    }


def event(op, id, at, offset, after=None, lsn=None, topic=CUSTOMERS.topic, partition=0):
    payload = {
        "op": op,
        "ts_ms": at if isinstance(at, int) else ms(at),
        "source": {"lsn": offset if lsn is None else lsn},
        "before": {"id": id} if op == "d" else None,
        "after": None if op == "d" else (after or image(id)),
    }
    return (str(id), json.dumps({"payload": payload}), topic, partition, offset)


def tombstone(id, offset, topic=CUSTOMERS.topic):
    return (str(id), None, topic, 0, offset)


def records(spark, *events):
    df = spark.createDataFrame(
        list(events), "key string, value string, topic string, partition int, offset long"
    )
    stamp = F.lit(AS_OF).cast("timestamp").alias("timestamp")
    return df.select("*", stamp).select(*RECORD.names)


def log(spark, *events):
    return parse_envelope(records(spark, *events))
