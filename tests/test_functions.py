import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.functions import buckets, hashing, records, text
from clickloom.operators import encoding


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize("number,shown", [
    ("2.5", "3"), ("-1.7", "-1"), ("-0.2", "0"), ("0", "0"), ("1499999999.4", "1499999999"), ("x", None),
])
def test_rounded_text(spark, number, shown):
    assert one(spark, text.rounded_text(F.lit(number))) == shown


def test_tag_lists(spark):
    tags = F.array(F.lit("a:0.5"), F.lit("b"), F.lit(":3"), F.lit("c:1:2"))
    assert one(spark, text.tag_list(tags)) == "a|b||c"
    assert one(spark, text.tag_list_from_commas(F.lit("a:1,,b"))) == "a||b"
    assert one(spark, text.tag_list_from_words(F.lit(" a:1 \t b\n"))) == "a|b"
    assert one(spark, text.tag_list_from_words(F.lit(None).cast("string"))) == ""


def test_numbers_from_text(spark):
    assert one(spark, text.to_double(F.lit("n/a"))) is None
    assert one(spark, text.to_whole(F.lit("0.0"))) == 0
    assert one(spark, text.to_whole(F.lit("-7.9"))) == -7


def test_keys_keep_underscores_of_the_device(spark):
    key = text.composite_key(F.lit("12"), F.lit("d_3_x"))
    assert one(spark, key) == "12_d_3_x"
    assert one(spark, text.key_content(key)) == "12"
    assert one(spark, text.key_device(key)) == "d_3_x"


def test_record_keeps_the_place_of_nulls(spark):
    assert one(spark, text.record(F.lit("a"), F.lit(None), F.lit(3))) == "a,None,3"
    assert one(spark, text.fixed_point(F.lit(1.5))) == "1.500000"


def test_newlines_are_stripped_at_the_ends_only(spark):
    assert one(spark, text.strip_newlines(F.lit("\n a\nb \n\n"))) == " a\nb "


def test_usable_id(spark):
    frame = spark.createDataFrame([("a",), ("",), ("0",), (None,)], "d string")
    assert [r.d for r in frame.where(text.usable_id("d")).collect()] == ["a"]


def test_hash_forms(spark):
    import hashlib

    expected = int(hashlib.md5(b"abc").hexdigest()[:8], 16)
    assert one(spark, hashing.hash32(F.lit("abc"))) == expected
    assert one(spark, F.expr(hashing.hash32_sql("'abc'"))) == expected
    fast = one(spark, F.expr(hashing.hash32_sql("'abc'", hashing.FAST)))
    assert 0 <= fast < 1 << 32
    with pytest.raises(ValueError):
        hashing.hash32_sql("'abc'", "other")


def test_split_share_is_near_a_fifth(spark):
    flags = spark.range(20000).select(hashing.split_flag(F.col("id"), F.lit("d")).alias("r"))
    test_share = 1 - flags.agg(F.avg("r")).first()[0]
    assert abs(test_share - 0.19) < 0.01


@pytest.mark.parametrize("lo,hi,n", [*encoding.EVEN_EDGES.values(), (0, 1, 11), (-3, 7, 4)])
def test_bucket_ids_agree_with_the_edges(spark, lo, hi, n):
    edges = one(spark, buckets.even_edges(lo, hi, n))
    assert len(edges) == n and edges[0] == lo and edges[-1] == hi
    assert np.allclose(edges, np.linspace(lo, hi, n), rtol=1e-12)
    picked = [edges[i] for i in {0, 1, n // 3, n // 2, n - 2, n - 1}]
    values = [v for e in picked for v in (e, np.nextafter(e, -np.inf), np.nextafter(e, np.inf))]
    values += [lo - 1.0, hi + 1.0, (lo + hi) / 2]
    frame = spark.createDataFrame([(float(v),) for v in values], "v double")
    guess = frame.selectExpr("v", f"{buckets.even_bucket_guess_sql('v', lo, hi, n)} as g")
    got = guess.selectExpr("v", f"{buckets.even_bucket_sql('g', 'v', lo, hi, n)} as b").collect()
    for r in got:
        assert r.b == int(np.searchsorted(edges, r.v, side="right")), r


def test_null_has_no_bucket(spark):
    frame = spark.createDataFrame([(None,)], "fea7 double")
    spec = encoding.EncoderSpec(edges={"fea7": (0, 50, 10)})
    assert encoding.add_bucket_ids(frame, spec).first().fea7_bucket is None


def test_uneven_buckets(spark):
    frame = spark.createDataFrame([(v,) for v in (0.5, 1.0, 9.9, 10.0, 50.0)], "v double")
    got = [r.b for r in encoding.bucketize(frame, "v", [1, 10], "b").collect()]
    assert got == [0, 1, 1, 2, 2]


def test_run_parameters_are_routed_by_type(spark):
    values = F.create_map(*[F.lit(x) for kv in {
        "s": "adam", "l": "12", "b": "True", "f": "0.5", "big": "99999999999999999999"}.items() for x in kv])
    got = {p.name: p for p in one(spark, records.run_parameters(values))}
    assert list(got) == sorted(got)
    assert got["s"].string_value == "adam" and got["l"].long_value == 12
    assert got["b"].bool_value == "True" and got["b"].string_value is None
    assert got["f"].float_value == 0.5 and got["f"].long_value is None
    assert got["big"].float_value == 1e20


def test_sorted_entries(spark):
    filled = records.sorted_entries(F.create_map(F.lit("b"), F.lit("2"), F.lit("a"), F.lit("1")))
    assert [tuple(e) for e in one(spark, filled)] == [("a", "1"), ("b", "2")]
    assert one(spark, records.sorted_entries(F.lit(None).cast("map<string,string>"))) == []


def test_time_texts(spark):
    ts = F.lit(dt.datetime(2018, 6, 25, 0, 8, 27, 516000)).cast("timestamp_ntz")
    assert one(spark, records.utc_text(ts)) == "2018-06-25T00:08:27.516000Z"
    ds, hh = records.hour_of(ts, back=1)
    assert (one(spark, ds), one(spark, hh)) == ("2018-06-24", "23")
