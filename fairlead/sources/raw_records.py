"""CSV records read as whole strings: tokenised by a finite-state machine, parted into sound rows and rejects.

The machine has six states and four byte classes. A batch of records is one byte buffer, cut into chunks of equal
length without regard to record or field ends. Every chunk first yields its transition function (start state -> end
state); the functions are composed by a prefix scan, which gives each chunk its true start state, and a second pass
writes the state before each byte. Long records thus cost no more per byte than short ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairlead.functions.text import strip
from fairlead.schema import SHEET_COLUMNS

START, PLAIN, QUOTED, CLOSED, STRAY_QUOTE, TRAILING_TEXT = range(6)
OTHER, COMMA, QUOTE, END = range(4)
STEP = np.array(
    [
        # START    PLAIN        QUOTED  CLOSED         STRAY_QUOTE  TRAILING_TEXT
        [PLAIN, PLAIN, QUOTED, TRAILING_TEXT, STRAY_QUOTE, TRAILING_TEXT],  # OTHER
        [START, START, QUOTED, START, STRAY_QUOTE, TRAILING_TEXT],  # COMMA
        [QUOTED, STRAY_QUOTE, CLOSED, QUOTED, STRAY_QUOTE, TRAILING_TEXT],  # QUOTE
        [START, START, START, START, START, START],  # END
    ],
    dtype=np.uint8,
)
CLASS = np.zeros(256, np.uint8)
CLASS[ord(",")] = COMMA
CLASS[ord('"')] = QUOTE


def states(classes: np.ndarray, chunk: int = 256) -> np.ndarray:
    """The machine's state before each byte and after the last, by composing the transition functions of chunks."""
    n = len(classes)
    rows = max(1, -(-n // chunk))
    grid = np.full(rows * chunk, END, np.uint8)
    grid[:n] = classes
    grid = np.ascontiguousarray(grid.reshape(rows, chunk).T)  # by step, then by chunk
    whole = np.tile(np.arange(6, dtype=np.uint8), (rows, 1))
    for byte in grid:
        whole = STEP[byte[:, None], whole]
    reach = 1
    while reach < rows:  # whole[i] becomes the composition of chunks 0..i
        whole = np.concatenate([whole[:reach], np.take_along_axis(whole[reach:], whole[:-reach].astype(np.intp), 1)])
        reach *= 2
    now = np.concatenate([[START], whole[:-1, START]]).astype(np.uint8)
    before = np.empty((chunk, rows), np.uint8)
    for k, byte in enumerate(grid):
        before[k] = now
        now = STEP[byte, now]
    return before.T.reshape(-1)[:n]


def tokenize(lines: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """For each record its fields (null if the quoting is broken), the fault and the fault's offset in characters."""
    lines = pc.fill_null(lines.cast(pa.large_string()), "")
    n = len(lines)
    edge = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset : lines.offset + n + 1]
    data = np.frombuffer(lines.buffers()[2] or b"", np.uint8)[edge[0] : edge[-1]]
    edge = edge - edge[0]
    ends = edge[1:] + np.arange(n)
    classes = np.empty(len(data) + n, np.uint8)
    is_end = np.zeros(len(classes), bool)
    is_end[ends] = True
    classes[~is_end] = CLASS[data]
    classes[is_end] = END
    before = states(classes)
    first = edge[:-1] + np.arange(n)  # where each record begins in classes

    fault = np.zeros(n, np.uint8)
    fault[before[ends] == QUOTED] = 1
    fault[before[ends] == STRAY_QUOTE] = 2
    fault[before[ends] == TRAILING_TEXT] = 3
    comma = (classes == COMMA) & (before != QUOTED) & (before < STRAY_QUOTE)
    after = STEP[classes, before]
    opens = (classes == QUOTE) & (before == START)
    breaks = (after >= STRAY_QUOTE) & (before < STRAY_QUOTE)
    at = np.full(n, -1, np.int64)
    for r in np.flatnonzero(fault):  # only faulty records are looked at one by one
        span = slice(first[r], ends[r])
        k = np.flatnonzero(opens[span])[-1] if fault[r] == 1 else np.flatnonzero(breaks[span])[0]
        at[r] = int(((data[edge[r] : edge[r] + k] & 0xC0) != 0x80).sum())

    # Commas between fields and record ends leave the buffer; what stays is the fields, end to end.
    cut = comma | is_end
    where = np.flatnonzero(cut)
    sizes = np.cumsum(~cut)[where]
    text = np.zeros(len(classes), np.uint8)
    text[~is_end] = data
    values = pa.LargeStringArray.from_buffers(
        len(where), pa.py_buffer(np.concatenate([[0], sizes]).astype(np.int64).tobytes()), pa.py_buffer(text[~cut].tobytes())
    )
    inner = pc.replace_substring(pc.utf8_slice_codeunits(values, 1, -1), '""', '"')
    values = pc.if_else(pc.starts_with(values, '"'), inner, values)
    per_record = np.cumsum(cut)[ends]
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], per_record]).astype(np.int32)), values.cast(pa.string()))
    sound = pa.array(fault == 0)
    names = pa.array(["never_closed", "stray_quote", "text_after_quote"])
    label = names.take(pa.array(np.maximum(fault, 1) - 1))
    return pc.if_else(sound, lists, pa.scalar(None, lists.type)), pc.if_else(sound, pa.scalar(None, pa.string()), label), pc.if_else(sound, pa.scalar(None, pa.int64()), pa.array(at))


def with_fields(df: DataFrame, line: str = "raw_line", most_bytes: int = 16 << 20) -> DataFrame:
    """df with _fields array<string>, _fault string and _fault_at bigint of the CSV record in ``line``.

    A null record counts as an empty one, which has one empty field. Batches are sliced to about ``most_bytes``.
    """
    schema = T.StructType(
        [f for f in df.schema.fields if f.name not in ("_fields", "_fault", "_fault_at")]
        + [T.StructField("_fields", T.ArrayType(T.StringType())), T.StructField("_fault", T.StringType()), T.StructField("_fault_at", T.LongType())]
    )
    keep = [f.name for f in schema.fields[:-3]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = max(1, int(batch.num_rows * most_bytes / max(most_bytes, batch.nbytes)))
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                new = tokenize(part.column(part.schema.get_field_index(line)))
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in keep), *new], names=[*keep, "_fields", "_fault", "_fault_at"])

    return df.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(run, schema)


MOST_TERMS = 100_000
# What the three checked fields may look like.
PLAIN_NUMBER = r"^(\d+|\d{1,3}(,\d{3})+)(\.\d+)?$"
PLAIN_DECIMAL = r"^[+-]?(\d+(\.\d+)?|\.\d+)$"
ADDRESS = r"(?i)https?://"


def checked(df: DataFrame, vocab: DataFrame, line: str = "raw_line") -> DataFrame:
    """with_fields(df) with _reasons, the array of everything that is wrong with the record (empty: sound).

    broken_quoting and column_count exclude all else; bad_capacity, bad_longitude and bad_operator may come together.
    Blank and 'unknown' are sound. ``vocab`` (column_name, term) is the sheet's controlled vocabulary, one row per term
    of a form that people pick from; its size is checked, because every task holds it.
    """
    rows = vocab.select(F.lower(strip(F.col("term"))).alias("t")).where("t <> ''").distinct().limit(MOST_TERMS + 1).collect()
    if len(rows) > MOST_TERMS:
        raise ValueError(f"vocabulary of more than {MOST_TERMS} terms")
    terms = sorted(r.t for r in rows)

    def field(name: str) -> Column:
        return strip(F.element_at("_fields", SHEET_COLUMNS.index(name) + 1))

    capacity, longitude, operator = field("capacity"), field("yard_location_longitude"), field("operator_charterer")
    given = lambda v: (v != "") & (F.lower(v) != "unknown")
    number = F.regexp_replace(capacity, ",", "").try_cast("double")
    degrees = longitude.try_cast("double")
    reasons = [
        (given(capacity) & ~(capacity.rlike(PLAIN_NUMBER) & (F.coalesce(number, F.lit(0.0)) > 0)), "bad_capacity"),
        (given(longitude) & ~(longitude.rlike(PLAIN_DECIMAL) & F.coalesce(degrees.between(-180, 180), F.lit(False))), "bad_longitude"),
        (given(operator) & (operator.rlike(ADDRESS) | (F.lower(operator).isin(terms) if terms else F.lit(False)) | ~operator.rlike(r"\p{L}")), "bad_operator"),
    ]
    found = F.filter(F.array(*[F.when(wrong, F.lit(name)) for wrong, name in reasons]), lambda r: r.isNotNull())
    return with_fields(df, line).withColumn("_reasons", F.when(F.col("_fault").isNotNull(), F.array(F.lit("broken_quoting"))).when(F.size("_fields") != len(SHEET_COLUMNS), F.array(F.lit("column_count"))).otherwise(found))


def sound_rows(parsed: DataFrame, *keep: str) -> DataFrame:
    """The typed rows of checked(): ``keep`` and the 46 columns as text, with capacity_number, longitude_degrees as doubles."""
    columns = [F.element_at("_fields", k + 1).alias(c) for k, c in enumerate(SHEET_COLUMNS)]
    number = F.regexp_replace(strip(F.element_at("_fields", SHEET_COLUMNS.index("capacity") + 1)), ",", "")
    degrees = strip(F.element_at("_fields", SHEET_COLUMNS.index("yard_location_longitude") + 1))
    typed = [F.when(v.rlike(r"^[+-]?[\d.]+$"), v.try_cast("double")).alias(n) for v, n in ((number, "capacity_number"), (degrees, "longitude_degrees"))]
    return parsed.where(F.size("_reasons") == 0).select(*keep, *columns, *typed)


def rejects(parsed: DataFrame, *keep: str) -> DataFrame:
    """(keep..., reason, fault_at) of the records that checked() found unsound, one row per reason."""
    return parsed.where(F.size("_reasons") > 0).select(*keep, F.explode("_reasons").alias("reason"), F.col("_fault_at").alias("fault_at"))
