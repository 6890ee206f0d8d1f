from __future__ import annotations

import csv
import io
import random

from pyspark.sql import types as T

from lakeops.sources.payload import explode_csv_payload
from lakeops.sources.schemas import struct_of

SCHEMA = struct_of(a=T.StringType(), b=T.StringType(), c=T.StringType())


def test_against_the_csv_module(spark):
    rng = random.Random(11)
    alphabet = ["x", "é", ",", '"', "\n", " ", "1", ""]

    def cell():
        return "".join(rng.choice(alphabet) for _ in range(rng.randrange(6)))

    payloads, expected = [], []
    for number in range(300):
        header = rng.sample(["a", "b", "c", "z"], 4)
        rows = [[cell() for _ in header] for _ in range(rng.randrange(4))]
        buffer = io.StringIO()
        writer = csv.writer(buffer, lineterminator=rng.choice(["\n", "\r\n"]))
        writer.writerow(header)
        writer.writerows(rows)
        payloads.append((number, bytearray(buffer.getvalue().encode())))
        for line, row in enumerate(rows, 1):
            named = dict(zip(header, row, strict=True))
            expected.append((number, line, named["a"], named["b"], named["c"]))
    frame = spark.createDataFrame(payloads, "id int, body binary")
    got = [tuple(r) for r in explode_csv_payload(frame, "body", SCHEMA).collect()]
    # csv.writer quotes a line of one empty cell only, so empty means NULL here.
    plain = [tuple(v or None if i > 1 else v for i, v in enumerate(row)) for row in expected]
    found = [tuple(v or None if i > 1 else v for i, v in enumerate(row)) for row in got]
    assert sorted(found, key=str) == sorted(plain, key=str)


def test_types_missing_columns_and_empty_payloads(spark):
    schema = struct_of(n=T.IntegerType(), d=T.DoubleType(), absent=T.StringType())
    bodies = [b"d,n\n1.5,7\nbad,8\n", b"d,n\n", b"", None]
    frame = spark.createDataFrame(
        [(i, None if b is None else bytearray(b)) for i, b in enumerate(bodies)],
        "id int, body binary",
    )
    rows = sorted(tuple(r) for r in explode_csv_payload(frame, "body", schema).collect())
    assert rows == [(0, 1, 7, 1.5, None), (0, 2, 8, None, None)]


def test_long_records(spark):
    wide = ",".join(f'"{n} ""q"" , v"' for n in range(3000))
    head = ",".join(f"c{n}" for n in range(3000))
    long_text = "y" * 500_000
    body = f'{head}\n{wide}\n'.encode()
    frame = spark.createDataFrame(
        [(0, bytearray(body)), (1, bytearray(f'c2999\n"{long_text}"\n'.encode()))],
        "id int, body binary",
    )
    schema = struct_of(c2999=T.StringType())
    rows = {r["id"]: r["c2999"] for r in explode_csv_payload(frame, "body", schema).collect()}
    assert rows[0] == '2999 "q" , v' and rows[1] == long_text
