"""Property tests: parsing and rounding helpers against Python Decimal models."""

from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

from hypothesis import given, settings
from hypothesis import strategies as st

from wattflow.functions import br_number, round_numeric, rounded_mean


def _model_br(text):
    if text is None:
        return None
    t = text.replace(",", ".").strip()
    try:
        if not t or t.lower() in {"nan", "inf", "-inf", "infinity", "-infinity"}:
            raise InvalidOperation
        if any(ch not in "0123456789.-+eE" for ch in t):
            raise InvalidOperation
        return float(Decimal(t))
    except (InvalidOperation, ValueError):
        return None


br_texts = st.one_of(
    st.none(),
    st.builds(lambda i, f: f"{i},{f:02d}", st.integers(-10**6, 10**6), st.integers(0, 99)),
    st.builds(lambda i, f: f"{i}.{i % 1000:03d},{f:02d}", st.integers(1, 10**5),
              st.integers(0, 99)),   # thousands dot: not a number by default
    st.text(alphabet="0123456789,.- ", max_size=8),
)


@settings(max_examples=60, deadline=None)
@given(st.lists(br_texts, min_size=1, max_size=40))
def test_br_number_matches_model(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(br_number("t")).collect()]
    assert got == [_model_br(t) for t in texts]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**12), st.integers(1, 10**6)), min_size=1,
                max_size=30))
def test_rounded_mean_matches_decimal(spark, pairs):
    df = spark.createDataFrame(pairs, "s long, n long")
    got = [r[0] for r in df.selectExpr("cast(s * 0.01BD as decimal(36,12)) as t", "n").select(rounded_mean("t", "n")).collect()]
    want = [float((Decimal(s) / Decimal(n) / 100).quantize(Decimal("0.01"), ROUND_HALF_UP))
            for s, n in pairs]
    assert got == want


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**7), st.integers(1, 10**7)), min_size=1,
                max_size=30))
def test_round_numeric_of_ratios(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, b long")
    got = [r[0] for r in df.select(round_numeric(df.a / df.b * 100, 2)).collect()]
    # model: the double fixed to 12 places, then half-up to 2
    want = [float(Decimal(repr(a / b * 100)).quantize(Decimal("1e-12"), ROUND_HALF_UP)
                  .quantize(Decimal("0.01"), ROUND_HALF_UP)) for a, b in pairs]
    assert got == want


rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d", "e"]),
                             st.one_of(st.none(), st.sampled_from(["1", "2"])),
                             st.one_of(st.none(), st.sampled_from(["x", "y"]))), max_size=12)


def _model_delta(prev, curr):
    from collections import Counter
    p = {}
    c = {}
    for k, *v in prev:
        p.setdefault(k, Counter())[tuple(v)] += 1
    for k, *v in curr:
        c.setdefault(k, Counter())[tuple(v)] += 1
    out = {}
    for k in set(p) | set(c):
        if k not in p:
            out[k] = "added"
        elif k not in c:
            out[k] = "removed"
        else:
            out[k] = "unchanged" if p[k] == c[k] else "changed"
    return out


@settings(max_examples=40, deadline=None)
@given(rows_st, rows_st)
def test_snapshot_delta_matches_multiset_model(spark, prev, curr):
    from wattflow.operators.snapshots import snapshot_delta
    schema = "id string, p string, q string"
    got = {r.id: r.status for r in snapshot_delta(
        spark.createDataFrame(prev, schema), spark.createDataFrame(curr, schema), "id").collect()}
    assert got == _model_delta(prev, curr)
