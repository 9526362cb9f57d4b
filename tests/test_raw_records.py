import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fairlead.schema import SHEET_COLUMNS
from fairlead.sources.raw_records import checked, rejects, sound_rows, states, tokenize


def slow(line):
    """One record by the plain reading of the rules: (fields or None, fault, offset)."""
    fields, cur, mode, opened = [], "", "start", 0
    k = 0
    while k < len(line):
        ch = line[k]
        if mode == "start":
            if ch == '"':
                mode, opened = "quoted", k
            elif ch == ",":
                fields.append("")
            else:
                mode, cur = "plain", ch
        elif mode == "plain":
            if ch == '"':
                return None, "stray_quote", k
            if ch == ",":
                fields.append(cur)
                mode, cur = "start", ""
            else:
                cur += ch
        elif mode == "quoted":
            if ch == '"':
                mode = "closed"
            else:
                cur += ch
        elif ch == '"':
            mode, cur = "quoted", cur + '"'
        elif ch == ",":
            fields.append(cur)
            mode, cur = "start", ""
        else:
            return None, "text_after_quote", k
        k += 1
    if mode == "quoted":
        return None, "never_closed", opened
    return [*fields, cur], None, None


CASES = ["", ",", "a,b", '"a,b",c', '"a""b"', '"a', 'a"b', '"a"b', '"a" ,b', '"é\n"",",ü', 'é"', '"",""', '""""', "a,", '"x"\n']


def test_tokenizer_on_cases():
    fields, fault, at = tokenize(pa.array([*CASES, None]))
    for k, line in enumerate([*CASES, ""]):
        assert (fields[k].as_py(), fault[k].as_py(), at[k].as_py()) == slow(line), line


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet='a,"é\n ', max_size=40), max_size=12))
def test_tokenizer_equals_plain_reading(lines):
    fields, fault, at = tokenize(pa.array(lines, pa.string()))
    assert [(f, e, o) for f, e, o in zip(fields.to_pylist(), fault.to_pylist(), at.to_pylist())] == [slow(x) for x in lines]


def test_chunks_do_not_matter():
    import numpy as np

    classes = np.random.default_rng(1).integers(0, 4, 5000).astype(np.uint8)
    assert (states(classes, 7) == states(classes, 5000)).all() and (states(classes, 64) == states(classes, 1)).all()


def test_long_record_and_sliced_batch():
    long = '"' + "x,y\n" * 100_000 + '",b'
    batch = pa.array(["skip", "a,b", long, None]).slice(1)
    fields, fault, _ = tokenize(batch)
    assert fields[0].as_py() == ["a", "b"] and len(fields[1].as_py()) == 2 and fields[2].as_py() == [""]
    assert fault.to_pylist() == [None, None, None]


def line_of(**cells):
    return ",".join(cells.get(c, "") for c in SHEET_COLUMNS)


@pytest.fixture(scope="module")
def parsed(spark):
    lines = [
        line_of(row_id="7", capacity='"174,000"', yard_location_longitude=" -12.5 ", operator_charterer='"The ""Blue"" One"'),
        line_of(capacity="0", yard_location_longitude="181", operator_charterer="see http://x.example"),
        line_of(capacity="unknown", yard_location_longitude="UNKNOWN", operator_charterer="Unknown"),
        line_of(capacity='"17,40"', operator_charterer="On Order"), "a,b", 'x"y', None, line_of(operator_charterer="??"), line_of(yard_location_longitude="12e"), line_of(operator_charterer="Öl"),
    ]
    rows = spark.createDataFrame([(k, x, "extra") for k, x in enumerate(lines)], "raw_id long, raw_line string, _fields string")
    vocab = spark.createDataFrame([("status", "on order"), (None, None)], "column_name string, term string")
    return checked(rows, vocab)


def test_reasons(parsed):
    got = {}
    for r in rejects(parsed, "raw_id").collect():
        got.setdefault(r.raw_id, set()).add(r.reason)
    assert got == {1: {"bad_capacity", "bad_longitude", "bad_operator"}, 3: {"bad_capacity", "bad_operator"}, 4: {"column_count"}, 5: {"broken_quoting"}, 6: {"column_count"}, 7: {"bad_operator"}, 8: {"bad_longitude"}}


def test_sound_rows_are_typed(parsed):
    got = {r.raw_id: r for r in sound_rows(parsed, "raw_id").collect()}
    assert set(got) == {0, 2, 9}
    assert got[0].capacity == "174,000" and got[0].capacity_number == 174000.0 and got[0].longitude_degrees == -12.5 and got[0].operator_charterer == 'The "Blue" One'
    assert got[2].capacity_number is None


def test_empty_table(spark):
    rows = spark.createDataFrame([], "raw_id long, raw_line string")
    vocab = spark.createDataFrame([], "column_name string, term string")
    out = checked(rows, vocab)
    assert rejects(out, "raw_id").count() == 0 and sound_rows(out, "raw_id").count() == 0


def test_every_line_is_loaded_or_set_apart(spark, sf):
    raw = spark.read.parquet(f"{sf}/apply_rows_raw.parquet")
    out = checked(raw.select("raw_id", "raw_line"), spark.read.parquet(f"{sf}/vocab.parquet"))
    bad = rejects(out, "raw_id").select("raw_id").distinct()
    assert bad.count() + sound_rows(out, "raw_id").count() == raw.count()
    assert out.where(F.size("_reasons") == 0).join(bad, "raw_id").count() == 0
