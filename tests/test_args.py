"""P9 / P10 args codec, fuzz seeds and a property test against a plain fold."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jobledger.functions import args as A


def decode_py(text):
    """The decoding rules written as plain Python (the oracle)."""
    try:
        v = json.loads(text)
    except ValueError:
        return None
    if not isinstance(v, list):
        return None
    if not v:
        return {}
    if isinstance(v[0], dict):
        return v[0]
    return {str(i): x for i, x in enumerate(v)}


def encode_py(m):
    if not m:
        return "[]"
    return "[" + json.dumps(m, sort_keys=True, separators=(",", ":")) + "]"


def run(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "args string")
    out = df.select(F.to_json(A.sorted_map(A.decode_args("args"))).alias("m"),
                    A.encode_args(A.decode_args("args")).alias("wire")).collect()
    return [(None if r.m is None else json.loads(r.m), r.wire) for r in out]


SEEDS = ['[{"to":"user@example.com"}]', "[1,2,3]", "null", "{}", '"not-an-array"', "[null]",
         '[1.5,"text",{"key":"val"},null,true]', "[]", '[{"a":1},2]', "[{}]", "{bad"]


def test_fuzz_seeds(spark):
    for text, (m, wire) in zip(SEEDS, run(spark, SEEDS)):
        want = decode_py(text)
        assert m == want, text
        assert json.loads(wire) == json.loads(encode_py(want)), text


def test_lossy_round_trip(spark):
    got = dict(zip(SEEDS, run(spark, SEEDS)))
    assert got['[1,2,3]'][1] == '[{"0":1,"1":2,"2":3}]'
    assert got['[{"a":1},2]'][1] == '[{"a":1}]'
    assert got["[{}]"][1] == "[]"
    assert got["[null]"][1] == '[{"0":null}]'
    assert got['"not-an-array"'][0] is None


scalars = st.one_of(st.none(), st.booleans(), st.integers(-10**6, 10**6), st.text(max_size=5))
values = st.recursive(scalars, lambda c: st.one_of(st.lists(c, max_size=3),
                                                   st.dictionaries(st.text(min_size=1, max_size=4), c, max_size=3)),
                      max_leaves=6)


@settings(max_examples=60, deadline=None)
@given(st.lists(values, max_size=4))
def test_decode_matches_python(spark, arr):
    text = json.dumps(arr)
    [(m, wire)] = run(spark, [text])
    assert m == decode_py(text)
    assert json.loads(wire) == json.loads(encode_py(decode_py(text)))
