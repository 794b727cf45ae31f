"""Schema changes at any depth and the types that only widen."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from flowtable.operators.nested import Change, schema_changes, schema_changes_frame, widened, widens

INT, LONG, TEXT = T.IntegerType(), T.LongType(), T.StringType()


def struct(**fields):
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


STORED = struct(
    id=INT, gone=TEXT, place=struct(lat=T.FloatType(), name=TEXT),
    stops=T.ArrayType(struct(at=T.DateType(), kind=TEXT)), tags=T.MapType(TEXT, struct(n=T.ShortType())))
INCOMING = struct(
    tags=T.MapType(TEXT, struct(n=T.DecimalType(9, 2), **{"odd name": INT})), id=LONG,
    place=struct(lat=T.DoubleType(), height=INT), stops=T.ArrayType(struct(kind=INT, at=T.TimestampNTZType())), fresh=T.BooleanType())


def test_changes_have_paths_and_kinds():
    assert schema_changes(STORED, INCOMING) == [
        Change("gone", "removed", "string", None),
        Change("tags{value}.n", "widened", "smallint", "decimal(9,2)"),
        Change("tags{value}.`odd name`", "added", None, "int"),
        Change("id", "widened", "int", "bigint"),
        Change("place.name", "removed", "string", None),
        Change("place.lat", "widened", "float", "double"),
        Change("place.height", "added", None, "int"),
        Change("stops[].kind", "type_changed", "string", "int"),
        Change("stops[].at", "widened", "date", "timestamp_ntz"),
        Change("fresh", "added", None, "boolean"),
    ]


def test_same_schemas_in_another_order_have_no_changes():
    again = T.StructType([T.StructField(f.name, f.dataType, False) for f in reversed(STORED.fields)])
    assert schema_changes(STORED, again) == [] and widened(STORED, again) == STORED


def test_a_frame_of_changes(spark):
    rows = schema_changes_frame(spark, STORED, INCOMING).where("change = 'widened'").collect()
    assert [r.path for r in rows] == ["tags{value}.n", "id", "place.lat", "stops[].at"]
    assert schema_changes_frame(spark, STORED, STORED).count() == 0


def test_widened_keeps_stored_order_and_refuses_the_rest():
    wider = struct(b=struct(x=LONG), a=T.DoubleType())
    assert widened(struct(a=T.FloatType(), b=struct(x=INT)), wider) == struct(a=T.DoubleType(), b=struct(x=LONG))
    assert widened(STORED, INCOMING) is None


INTEGRAL = {T.ByteType(): 8, T.ShortType(): 16, T.IntegerType(): 32, T.LongType(): 64}


@pytest.mark.parametrize("old", INTEGRAL)
def test_a_decimal_is_wider_if_it_holds_the_extremes(old):
    low = -(2 ** (INTEGRAL[old] - 1))
    for p in range(1, 39):
        for s in (0, 2):
            if s <= p:
                holds = len(str(-low)) <= p - s
                # one digit more than needed is asked of a long (its least value has 19 digits)
                assert widens(old, T.DecimalType(p, s)) == (holds and (old != LONG or p - s >= 20))


TYPES = st.sampled_from([T.ByteType(), T.ShortType(), INT, LONG, T.FloatType(), T.DoubleType(), T.DateType(), T.TimestampNTZType(), TEXT,
                         T.BooleanType(), T.NullType(), T.DecimalType(5, 2), T.DecimalType(20, 2), T.DecimalType(12, 4), T.DecimalType(38, 18)])


@settings(max_examples=300, deadline=None)
@given(TYPES, TYPES, TYPES)
def test_widening_is_an_order(a, b, c):
    assert not widens(a, a) and not (widens(a, b) and widens(b, a))
    if widens(a, b) and widens(b, c):
        assert widens(a, c)
