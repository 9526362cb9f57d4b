"""Sheets and documents from files: header detection, records numbered as they lie, nested JSON."""

from __future__ import annotations

import csv
import io
import json
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The words that mark the header row; error values of spreadsheets; the batch documents and their modes.
HEADER_WORDS = ("shipowner", "shipbuilder")
CELL_ERRORS = ["#REF!", "#DIV/0!", "#VALUE!", "#NAME?", "#NULL!", "#N/A", "#NUM!"]
BATCH_DOCUMENTS = [("data_fill.json", "data_fill"), ("candidates.json", "discovery"), ("citations.json", "ref_fill")]

FILL = T.StructType([
    T.StructField("row_id", T.StringType()), T.StructField("field", T.StringType()), T.StructField("ref_field", T.StringType()), T.StructField("proposed_value", T.StringType()),
    T.StructField("new_urls", T.ArrayType(T.StringType())), T.StructField("confidence", T.StringType()), T.StructField("derivable", T.BooleanType()), T.StructField("prev_state", T.StringType()), T.StructField("note", T.StringType()),
])
PROPOSALS = T.StructType([T.StructField("fills", T.ArrayType(FILL)), T.StructField("candidate_findings", T.ArrayType(T.MapType(T.StringType(), T.StringType())))])
FLEET = T.StructType([
    T.StructField("edition_year", T.IntegerType()),
    T.StructField("vessels", T.ArrayType(T.StructType([
        T.StructField("built_year", T.IntegerType()), T.StructField("converted_year", T.IntegerType()), T.StructField("vessel_name", T.StringType()), T.StructField("ex_names", T.ArrayType(T.StringType())), T.StructField("storage_m3", T.LongType()),
        T.StructField("ccs", T.StringType()), T.StructField("sendout_mtpa", T.DoubleType()), T.StructField("vessel_owner", T.StringType()), T.StructField("builder", T.StringType()), T.StructField("location_raw", T.StringType()), T.StructField("location_status", T.StringType()),
    ]))),
])


def header_row(records: list[list[str]], most: int = 5) -> int:
    """Index of the first of the first ``most`` records that holds both header words; an error if none does."""
    for k, record in enumerate(records[:most]):
        joined = "\n".join(record).lower()
        if all(w in joined for w in HEADER_WORDS):
            return k
    raise ValueError("no header row found")


def column_map(header: list[str], expected: dict[str, str]) -> dict[str, str | None]:
    """canonical key -> header: the one equal to the expected text, else the first that contains it, case aside; else None."""
    low = [h.strip().lower() for h in header]
    out: dict[str, str | None] = {}
    for key, text in expected.items():
        want = text.lower()
        at = next((k for k, h in enumerate(low) if h == want), None)
        if at is None:
            at = next((k for k, h in enumerate(low) if want in h), None)
        out[key] = None if at is None else header[at]
    return out


def unique_headers(header: list[str]) -> list[str]:
    """Headers as column names: blank ones become _blank_1, ..., repeated ones get a number."""
    out, blank, seen = [], 0, {}
    for h in (x.strip() for x in header):
        if not h:
            blank += 1
            h = f"_blank_{blank}"
        seen[h] = seen.get(h, 0) + 1
        out.append(h if seen[h] == 1 else f"{h}_{seen[h]}")
    return out


def read_sheet(spark: SparkSession, path: str, least_bytes: int = 0) -> DataFrame:
    """A sheet exported as CSV: sheet_row (1-based record number in its file, blank records counted) and its columns as text, '' for nothing.

    Only the first records are looked at on the driver, for the header; each file is then parsed where it is read.
    Ragged rows are filled, surplus cells dropped. Files smaller than ``least_bytes`` in all are an error.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length", "content")
    size = files.agg(F.sum("length")).head()[0] or 0
    if size < least_bytes:
        raise ValueError(f"{path}: {size} bytes, {least_bytes} expected")
    first = files.orderBy("path").select(F.substring(F.decode("content", "UTF-8"), 1, 1 << 20).alias("t")).head()
    records = []
    for record in csv.reader(io.StringIO(first.t.removeprefix("﻿") if first else "", newline="")):
        records.append(record)
        if len(records) == 5:
            break
    at = header_row(records)
    names = unique_headers(records[at])
    schema = T.StructType([T.StructField("sheet_row", T.IntegerType()), *[T.StructField(n, T.StringType()) for n in names]])

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows = list(csv.reader(io.StringIO(bytes(content).decode("utf-8", "replace").removeprefix("﻿"), newline="")))
                body = [(k + 1, *(r[:len(names)] + [""] * (len(names) - len(r)))) for k, r in enumerate(rows) if k > at and r]
                yield pd.DataFrame(body, columns=["sheet_row", *names])

    return files.select("content").mapInPandas(parse, schema)


def batch_mode(directory: str) -> tuple[str, str]:
    """(mode, path) of the first batch document that a directory holds."""
    for name, mode in BATCH_DOCUMENTS:
        path = os.path.join(directory, name)
        if os.path.exists(path):
            return mode, path
    raise FileNotFoundError(f"no batch document in {directory}")


def load_colmap(csv_path: str) -> dict[str, str]:
    """The column map stored beside a sheet."""
    path = os.path.splitext(csv_path)[0] + ".colmap.json"
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def read_proposals(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(fills, findings) of proposal documents."""
    doc = spark.read.json(path, schema=PROPOSALS, multiLine=True)
    return doc.select(F.inline("fills")), doc.select(F.explode("candidate_findings").alias("values"), F.lit(None).cast("string").alias("text"))


def read_research(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Fills of named research documents, in the order of ``paths`` and of each file: src, pos and the fill."""
    schema = T.StructType([T.StructField("fills", T.ArrayType(FILL))])
    made = None
    for k, path in enumerate(paths):
        one = spark.read.json(path, schema=schema, multiLine=True).select(F.lit(k).alias("src"), F.posexplode("fills").alias("pos", "f")).select("src", "pos", "f.*")
        made = one if made is None else made.unionByName(one)
    if made is None:
        raise ValueError("no research documents")
    return made


def read_fleet(spark: SparkSession, path: str) -> DataFrame:
    """Roster records with idx, their place in the document."""
    doc = spark.read.json(path, schema=FLEET, multiLine=True)
    return doc.select("edition_year", F.posexplode("vessels").alias("idx", "v")).select(F.col("idx").cast("bigint").alias("idx"), "edition_year", "v.*")


def cell_errors(sheet: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, column_name, error): the first spreadsheet error value that a cell contains."""
    first = lambda c: F.get(F.filter(F.array(*[F.lit(t) for t in CELL_ERRORS]), lambda t: F.contains(F.coalesce(F.col(c), F.lit("")), t)), F.lit(0))
    made = [F.when(first(c).isNotNull(), F.struct(F.lit(c).alias("column_name"), first(c).alias("error"))) for c in columns]
    return sheet.select(key, F.inline(F.filter(F.array(*made), lambda x: x.isNotNull())))
